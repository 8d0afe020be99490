"""Slices of the planned tables: disjoint, together covering the table.

A slice is an interval of keys (``lo`` to ``hi`` inclusive), of pages (``lo`` inclusive, ``hi`` exclusive) or a
hash bucket (number ``lo``). ``open_low`` and ``open_high`` mark the outer intervals of a table: they also
take rows beyond the profiled bounds, which may have moved since profiling.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from snaplake.functions.expressions import WIDE, ceil_div, hash_bucket, quoted
from snaplake.plans.catalog import SALT_SEPARATOR, TABLE_ID, salts_of
from snaplake.plans.load_plan import key_span
from snaplake.sources.dialects import Dialect

SLICE_COLUMNS = [
    *TABLE_ID, "key_column", "salt_column", "strategy", "unit", "slice_no", "slices", "lo", "hi",
    "open_low", "open_high", "parts",
]

_UNITS = {
    "single": "table", "key_partitioned": "key", "range_batches": "key",
    "hash_batches": "bucket", "page_parallel": "page", "page_batches": "page",
}


def _numbers(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), n - F.lit(1)))


# Key arithmetic is done in decimals, or in the integers of ``exact`` where the caller knows they suffice.


def slice_low(lo: Column, width: Column, number: Column, exact: str = WIDE) -> Column:
    """First key of slice ``number`` when slices of ``width`` keys start at ``lo``."""
    return (lo.cast(exact) + number.cast(exact) * width.cast(exact)).cast("bigint")


def slice_high(lo: Column, hi: Column, width: Column, number: Column, exact: str = WIDE) -> Column:
    """Last key of slice ``number``; never past ``hi``."""
    last = lo.cast(exact) + (number.cast(exact) + F.lit(1)) * width.cast(exact) - F.lit(1)
    return F.least(hi.cast(exact), last).cast("bigint")


def slice_number(key: Column, lo: Column, hi: Column, width: Column, exact: str = WIDE) -> Column:
    """The slice a key falls in; keys beyond the bounds belong to the outer slices."""
    inside = F.least(F.greatest(key, lo), hi)
    return F.call_function("div", inside.cast(exact) - lo.cast(exact), width.cast(exact))


def plan_slices(plan: DataFrame, start: int = 0, count: int | None = None) -> DataFrame:
    """Every slice of every planned table, one row each, or only ``count`` of them from ``start`` on. Tables read in one go
    have a single slice."""
    unit = F.lit(None).cast("string")
    for strategy, name in _UNITS.items():
        unit = F.when(F.col("strategy") == strategy, name).otherwise(unit)
    first, last = F.col("slice_no") == 0, F.col("slice_no") == F.col("batches") - 1
    lo, hi, width, n = (F.col(c) for c in ("lo", "hi", "slice_width", "slice_no"))
    is_range, is_hash = F.col("strategy") == "range_batches", F.col("strategy") == "hash_batches"
    by_page = F.col("strategy").isin("page_parallel", "page_batches")
    batch_low = n * F.coalesce(width, F.lit(0))
    batch_high = F.least(F.col("pages"), batch_low + F.coalesce(width, F.col("pages")))
    low = F.when(is_range, slice_low(lo, width, n)).when(is_hash, n).when(by_page, batch_low).otherwise(lo)
    high = (
        F.when(is_range, slice_high(lo, hi, width, n)).when(is_hash, n).when(by_page, batch_high).otherwise(hi)
    )
    span = F.when(by_page, F.greatest(high - low, F.lit(1))).otherwise(F.col("parts"))
    begin, past = F.lit(start).cast("bigint"), F.col("batches")
    if count is not None:
        past = F.least(past, F.lit(start + count).cast("bigint"))
    numbered = plan.filter(past > begin).withColumn("slice_no", F.explode(F.sequence(begin, past - F.lit(1))))
    return numbered.select(
        *TABLE_ID, "key_column", "salt_column", "strategy", unit.alias("unit"), "slice_no",
        F.col("batches").alias("slices"),
        low.alias("lo"), high.alias("hi"),
        (first & ~is_hash).alias("open_low"), (last & ~is_hash).alias("open_high"),
        F.least(F.col("parts"), span).alias("parts"),
    )


def reader_intervals(slices: DataFrame) -> DataFrame:
    """Slices split into the intervals their parallel readers take, one row per task.

    The known span of a slice is divided first and its open end added after, so the last reader of an
    open slice does not take nearly all of it.
    """
    splits = F.col("unit").isin("key", "page")
    size = F.when(F.col("unit") == "key", key_span(F.col("lo"), F.col("hi"))).otherwise(
        (F.col("hi") - F.col("lo")).cast(WIDE)
    )
    size = F.greatest(size, F.lit(1).cast(WIDE))
    width = F.when(splits, ceil_div(size, F.least(F.col("parts").cast(WIDE), size)))
    readers = F.when(splits, ceil_div(size, F.col("width").cast(WIDE))).otherwise(F.lit(1).cast("bigint"))
    first, last = F.col("part_no") == 0, F.col("part_no") == F.col("readers") - 1
    step = F.when(F.col("unit") == "page", F.col("width")).otherwise(F.col("width") - 1)
    low = slice_low(F.col("lo"), F.col("width"), F.col("part_no"))
    high = F.least(F.col("hi").cast(WIDE), low.cast(WIDE) + step.cast(WIDE)).cast("bigint")
    return (
        slices.withColumn("width", width)
        .withColumn("readers", readers)
        .withColumn("part_no", _numbers(F.col("readers")))
        .select(
            *TABLE_ID, "key_column", "salt_column", "strategy", "unit", "slice_no", "slices", "part_no",
            F.when(splits, low).otherwise(F.col("lo")).alias("lo"),
            F.when(splits, high).otherwise(F.col("hi")).alias("hi"),
            (F.col("open_low") & first).alias("open_low"),
            (F.col("open_high") & last).alias("open_high"),
        )
    )


def widened(entry: Row, readers: int) -> Row:
    """The plan entry with slices that are so much wider that there are no more than ``readers`` readers of them."""
    if entry["slice_width"] is None or entry["batches"] * entry["parts"] <= readers:
        return entry
    times = -(-entry["batches"] * entry["parts"] // readers)
    return Row(**entry.asDict() | {"slice_width": entry["slice_width"] * times, "batches": -(-entry["batches"] // times)})


def boundaries_text(entry: Row, dialect: Dialect, step: int, one_of: int = 1) -> str:
    """Source-side query for every ``step``-th key in key order, of one key in ``one_of``, drawn by a hash of all key
    columns: the source orders only those. It orders them itself, as it will compare them.

    A key met several times comes once, with its ``copies``: the source decides which keys are the same.
    """
    key, table = dialect.quote(entry["key_column"]), dialect.table(entry["ns"], entry["table"])
    whole = ", ".join([key, *[dialect.quote(s) for s in salts_of(entry["salt_column"])]])
    drawn = f" AND {dialect.in_bucket(f'CONCAT_WS({chr(39)}|{chr(39)}, {whole})', one_of, one_of - 1)}" if one_of > 1 else ""
    ranked = f"SELECT {key} AS k, ROW_NUMBER() OVER (ORDER BY {key}) AS r FROM {table} WHERE {key} IS NOT NULL{drawn}"
    return (
        f"SELECT MIN(k) AS k, COUNT(*) AS copies, MIN(r) AS r FROM ({ranked}) AS ranked"
        f" WHERE MOD(r - 1, {step}) = 0 GROUP BY k"
    )


def is_uneven(entry: Row) -> bool:
    """Whether slices of equal key width may differ much in rows: gaps in the keys, or many rows per key."""
    span = entry["hi"] - entry["lo"] + 1
    return span > 2 * entry["rows"] or entry["rows"] > span


def balanced_predicates(boundaries: Sequence[tuple[Any, int]], entry: Row, dialect: Dialect) -> list[str]:
    """WHERE texts of readers with about as many rows each, from every n-th key and its copies, in key order.

    A reader takes the keys from one boundary up to the next. A key with m > 1 copies holds at least m - 1
    readers' rows: it gets m readers of its own, told apart by a hash of all other key columns.
    """
    key, salts = dialect.quote(entry["key_column"]), [dialect.quote(s) for s in salts_of(entry["salt_column"])]
    salt = salts[0] if len(salts) == 1 else f"CONCAT_WS('|', {', '.join(salts)})" if salts else ""
    texts = []
    for i, (k, copies) in enumerate(boundaries):
        at, start = dialect.literal(k), ">="
        if copies > 1 and salt:
            if i == 0:
                texts.append(f"({key} < {at} OR {key} IS NULL)")
            texts += [f"{key} = {at} AND {dialect.in_bucket(salt, copies, j)}" for j in range(copies)]
            start = ">"
        tests = [] if i == 0 and start == ">=" else [f"{key} {start} {at}"]
        if i + 1 < len(boundaries):
            tests.append(f"{key} < {dialect.literal(boundaries[i + 1][0])}")
        text = " AND ".join(tests) or "1 = 1"
        texts.append(f"({text} OR {key} IS NULL)" if i == 0 and start == ">=" and tests else text)
    return texts


def predicates(intervals: DataFrame, dialect: Dialect) -> DataFrame:
    """Adds ``predicate``: the WHERE text a reader sends to the source for its interval."""
    key = quoted(F.col("key_column"), dialect.quote_char)
    lo, hi = F.col("lo").cast("string"), F.col("hi").cast("string")
    at_low = F.concat(key, F.lit(" >= "), lo)
    at_high = F.concat(key, F.lit(" <= "), hi)
    by_key = (
        F.when(F.col("open_low") & F.col("open_high"), F.lit("1 = 1"))
        .when(F.col("open_low"), F.concat(F.lit("("), at_high, F.lit(" OR "), key, F.lit(" IS NULL)")))
        .when(F.col("open_high"), at_low)
        .otherwise(F.concat(at_low, F.lit(" AND "), at_high))
    )
    from_page = F.concat(F.lit("ctid >= '("), lo, F.lit(",0)'::tid"))
    to_page = F.concat(F.lit("ctid < '("), hi, F.lit(",0)'::tid"))
    by_page = F.when(F.col("open_high"), from_page).otherwise(F.concat(from_page, F.lit(" AND "), to_page))
    names = F.split("salt_column", SALT_SEPARATOR)
    salt = F.array_join(F.transform(names, lambda c: quoted(c, dialect.quote_char)), ", ")

    # Of a composite key all columns are hashed: the first alone may be the same in most rows.
    whole_key = F.when(F.col("salt_column").isNull(), key).otherwise(
        F.concat(F.lit("CONCAT_WS('|', "), key, F.lit(", "), salt, F.lit(")"))
    )
    bucket = F.replace(F.lit(dialect.bucket_template), F.lit("{column}"), whole_key)
    bucket = F.replace(bucket, F.lit("{buckets}"), F.col("slices").cast("string"))
    bucket = F.concat(bucket, F.lit(" = "), lo)
    or_null = F.concat(F.lit("("), bucket, F.lit(" OR "), whole_key, F.lit(" IS NULL)"))
    by_bucket = F.when(F.col("lo") == 0, or_null).otherwise(bucket)
    text = (
        F.when(F.col("unit") == "key", by_key)
        .when(F.col("unit") == "page", by_page)
        .when(F.col("unit") == "bucket", by_bucket)
        .otherwise(F.lit("1 = 1"))
    )
    return intervals.withColumn("predicate", text)


def in_key_slice(key: Column, lo: int, hi: int, open_low: bool, open_high: bool) -> Column:
    """Row test of a key slice."""
    test = F.lit(True)
    if not open_low:
        test = key >= F.lit(lo)
    if not open_high:
        upper = key <= F.lit(hi)
        test = (upper | key.isNull()) if open_low else test & upper
    return test


def in_bucket(key: Column, bucket: int, buckets: int) -> Column:
    """Row test of a hash slice; null keys go to bucket 0."""
    return F.coalesce(hash_bucket(key, buckets), F.lit(0)) == bucket


def in_page_slice(page: Column, lo: int | Column, hi: int | Column, open_high: bool | Column) -> Column:
    """Row test of a page slice."""
    return (page >= F.lit(lo)) & (F.lit(open_high) | (page < F.lit(hi)))
