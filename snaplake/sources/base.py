"""What a load needs from a source."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any, Protocol, TypeVar

from pyspark.sql import DataFrame, Row, SparkSession

from snaplake.sources.dialects import Dialect

X = TypeVar("X")


@dataclass(frozen=True)
class Catalog:
    """Catalog frames of a source; the columns are listed in ``snaplake.plans.catalog``."""

    namespaces: DataFrame
    tables: DataFrame
    constraints: DataFrame
    key_usage: DataFrame
    columns: DataFrame
    relations: DataFrame
    column_stats: DataFrame
    stats_times: DataFrame


class Source(Protocol):
    spark: SparkSession
    dialect: Dialect
    database: str

    def catalog(self) -> Catalog:
        """Catalog frames, read lazily."""

    def profile(self, keys: Sequence[Row]) -> DataFrame:
        """Rows, key bounds and pages of the given tables."""

    def scan(self, ns: str, table: str) -> DataFrame:
        """The whole table."""

    def scan_where(self, ns: str, table: str, group: Mapping[str, Any], *, entry: Row | None = None) -> DataFrame:
        """The rows that pass a filter; in parallel where a plan entry is given and the source needs one."""

    def read(self, entry: Row) -> DataFrame:
        """The whole table, in parallel, the way its plan entry says."""

    def layout(self, entry: Row) -> str | None:
        """What else than the plan entry decides how the table is cut, as text; None if nothing does."""

    def waves(
        self, entry: Row, group: Mapping[str, Any] | None = None, first: int = 0, layout: str | None = None
    ) -> Iterator[DataFrame]:
        """The table, or its rows that pass a filter, in parts that the source bears one at a time, from part ``first``
        on. Each is made when it is taken. The same entry and layout give the same parts."""

    def step_entry(self, entry: Row) -> Row:
        """The plan entry of an incremental load: with as many slices as it is to have steps."""

    def pieces(self, entry: Row) -> Iterable[Row]:
        """Slices of the table in order, a few small rows each with its ``slice_no``."""

    def read_slice(self, entry: Row, piece: Row) -> DataFrame:
        """One slice of the table."""


def combine(frames: Sequence[X], pair: Callable[[X, X], X]) -> X:
    """Combine frames pairwise, so the plan's depth grows with the logarithm of their number."""
    if not frames:
        raise ValueError("nothing to combine")
    level = list(frames)
    while len(level) > 1:
        level = [pair(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]
