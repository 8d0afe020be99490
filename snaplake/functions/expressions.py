"""Column expressions shared by the plan, the sources and the ledger."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wide enough for the span of any two 64-bit keys.
WIDE = "decimal(20,0)"


def int_div(a: Column, b: Column) -> Column:
    """Integer quotient; stays exact where a double would not."""
    return F.call_function("div", a, b)


def ceil_div(a: Column, b: Column) -> Column:
    """Quotient of two non-negative integers, rounded up."""
    return int_div(a + b - F.lit(1), b)


def at_least(value: int, x: Column) -> Column:
    return F.greatest(F.lit(value).cast("bigint"), x)


def hash_bucket(column: Column, buckets: Column | int) -> Column:
    """CRC-32 bucket of a key, the same number ``MOD(CRC32(key), n)`` gives in MySQL."""
    n = F.lit(buckets).cast("bigint") if isinstance(buckets, int) else buckets
    return F.pmod(F.crc32(column.cast("string").cast("binary")), n)


def age_seconds(since: Column, now: Column, *, rounded: Column) -> Column:
    """Whole seconds from ``since`` to ``now``, never negative; halves are rounded up where ``rounded``."""
    micros = F.timestamp_diff("MICROSECOND", since, now)
    shift = F.when(rounded, 500_000).otherwise(0)
    # greatest() skips nulls, so an unknown age is kept apart
    return F.when(micros.isNotNull(), at_least(0, int_div(micros + shift, F.lit(1_000_000))))


def elapsed_text(seconds: Column) -> Column:
    """``1h 2m 5s``; the hours are left out when there are none."""
    hours = int_div(seconds, F.lit(3600))
    minutes = int_div(seconds % 3600, F.lit(60))
    below = F.format_string("%dm %ds", minutes, seconds % 60)
    return F.when(hours > 0, F.concat(hours.cast("string"), F.lit("h "), below)).otherwise(below)


def file_stamp(ts: Column) -> Column:
    """Timestamp as it appears in object names."""
    return F.date_format(ts, "yyyyMMdd_HHmmss")


def iso_seconds(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def quoted(name: Column, quote: str) -> Column:
    """Identifier in quotes, with quotes inside it doubled."""
    q = F.lit(quote)
    return F.concat(q, F.replace(name, q, F.lit(quote * 2)), q)
