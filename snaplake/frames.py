"""Small driver-side rows as DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def local_frame(spark: SparkSession, rows: Iterable[Sequence[Any]], schema: str) -> DataFrame:
    """A DataFrame of catalog-sized rows the driver already holds.

    Handed over as Arrow they become a local relation: no Python worker runs and Catalyst sees their size.
    """
    fields = T.StructType.fromDDL(schema)
    columns = list(zip(*rows)) or [()] * len(fields)
    arrays = {f.name: pa.array(list(c)) for f, c in zip(fields, columns)}
    return spark.createDataFrame(pa.table(arrays), schema=fields)
