"""Proof that a table's slices are disjoint and cover it, counted over its rows in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from snaplake.functions.expressions import WIDE, hash_bucket
from snaplake.plans.catalog import TABLE_ID
from snaplake.plans.load_plan import BATCHED, plan_frame
from snaplake.plans.slices import plan_slices, slice_high, slice_low, slice_number
from snaplake.sources.base import Source


def slice_coverage(source: Source, entry: Row) -> DataFrame:
    """One row: slices, rows, rows that no slice takes and rows that two slices take.

    A row is tested against the slice its key points at and both neighbours, then rows are counted per slice
    before the slices are joined, so no row meets more than three slices and none is shuffled.
    """
    lo, hi, width, n = (F.lit(entry[c]).cast("bigint") for c in ("lo", "hi", "slice_width", "batches"))
    rows = source.scan(entry["ns"], entry["table"])
    if entry["strategy"] not in BATCHED:
        rows, number, claims = rows.select(), F.lit(0).cast("bigint"), F.lit(1)
    elif entry["strategy"] == "hash_batches":
        rows = rows.select(hash_bucket(F.col(f"`{entry['key_column']}`"), n).alias("k"))
        number, claims = F.col("k"), F.col("k").between(F.lit(0), n - F.lit(1)).cast("int")
    else:
        if entry["strategy"] == "page_batches":
            rows, lo, hi = source.paged(entry["ns"], entry["table"], "k").select("k"), F.lit(0).cast("bigint"), F.lit(entry["pages"] - 1).cast("bigint")
        else:
            rows = rows.select(F.col(f"`{entry['key_column']}`").cast("bigint").alias("k"))
        # Integers do unless the keys reach the edge of 64 bits.
        exact = "bigint" if max(abs(entry["lo"]), abs(entry["hi"])) < 2**61 else WIDE
        k, number = F.col("k"), slice_number(F.col("k"), lo, hi, width, exact)

        def takes(i: Column) -> Column:
            above = (i == 0) | (k >= slice_low(lo, width, i, exact))
            below = (i == n - 1) | (k <= slice_high(lo, hi, width, i, exact))
            return ((i >= 0) & (i < n) & above & below).cast("int")

        claims = takes(number - 1) + takes(number) + takes(number + 1)
    per_slice = (
        rows.select(number.alias("slice_no"), claims.alias("claims"))
        .groupBy("slice_no")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("claims") == 0).alias("n_none"),
            F.count_if(F.col("claims") > 1).alias("n_twice"),
        )
    )
    slices = plan_slices(plan_frame(source.spark, [entry])).select("slice_no", F.lit(1).alias("planned"))
    unplanned = F.when(F.col("planned").isNull(), F.col("n"))
    return (
        per_slice.join(slices, "slice_no", "full")
        .agg(
            F.count("planned").alias("slices"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.coalesce(unplanned, F.col("n_none"))), F.lit(0)).alias("rows_in_none"),
            F.coalesce(F.sum("n_twice"), F.lit(0)).alias("rows_in_two"),
        )
        .select(
            *[F.lit(entry[c]).alias(c) for c in (*TABLE_ID, "strategy")],
            "slices", "rows", "rows_in_none", "rows_in_two",
        )
    )
