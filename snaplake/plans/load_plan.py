"""How each table is read: one row per table, computed from its profile by column expressions alone.

A profile has ``PROFILE_COLUMNS``; the plan adds

``parts``        parallel readers of a table, or of one slice of it
``large``        whether the table runs in the large lane
``strategy``     single, key_partitioned, range_batches, hash_batches, page_parallel or page_batches
``slice_width``  keys, rows or pages per slice
``batches``      slices of the table
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from snaplake.config import LoadConfig
from snaplake.frames import local_frame
from snaplake.functions.expressions import WIDE
from snaplake.plans.catalog import TABLE_ID
from snaplake.sources.dialects import DIALECTS

PROFILE_COLUMNS = [*TABLE_ID, "key_column", "salt_column", "key_kind", "rows", "lo", "hi", "pages"]
PLAN_COLUMNS = [*PROFILE_COLUMNS, "parts", "large", "strategy", "slice_width", "batches"]

PROFILE_SCHEMA = (
    "source string, ns string, table string, key_column string, salt_column string, key_kind string, "
    "rows bigint, lo bigint, hi bigint, pages bigint"
)
PLAN_SCHEMA = PROFILE_SCHEMA + ", parts bigint, large boolean, strategy string, slice_width bigint, batches bigint"

BATCHED = ("range_batches", "hash_batches", "page_batches")


def key_span(lo: Column, hi: Column) -> Column:
    """Number of key values from ``lo`` to ``hi``; exact for any pair of 64-bit keys."""
    return hi.cast(WIDE) - lo.cast(WIDE) + F.lit(1)


def plan_loads(profile: DataFrame, cfg: LoadConfig) -> DataFrame:
    """The plan, in SQL expressions: a chain of projections over the profile, without a shuffle."""
    batch = f"{cfg.large_table_batch_size}L"
    batched = f"rows >= {cfg.large_table_threshold} AND {not cfg.single_shot}"
    spread = "key_kind = 'numeric' AND hi > lo"
    paged_sources = ", ".join(f"'{d.name}'" for d in DIALECTS.values() if d.physical_pages)
    span = f"(CAST(hi AS {WIDE}) - CAST(lo AS {WIDE}) + 1)"

    sized = profile.selectExpr(
        *TABLE_ID, "key_column", "salt_column", "key_kind", "rows", "lo", "hi",
        "CASE WHEN key_kind = 'page' THEN greatest(1L, pages) ELSE pages END AS pages",
        f"""CASE WHEN key_kind = 'page' OR ({spread})
            THEN greatest(1L, least((rows + {cfg.chunk_size - 1}) div {cfg.chunk_size}, {cfg.num_threads}L))
            ELSE 1L END AS parts""",
        f"rows >= {cfg.large_table_threshold} AS large",
    )
    # A key with fewer values than one batch cannot be cut by value; the table's pages can.
    narrow = f"source IN ({paged_sources}) AND key_kind = 'numeric' AND pages > 0 AND {span} < {batch}"
    chosen = sized.selectExpr(
        "*",
        f"""CASE WHEN key_kind = 'page' AND NOT ({batched}) THEN 'page_parallel'
                 WHEN key_kind = 'page' OR ({narrow} AND {batched}) THEN 'page_batches'
                 WHEN {spread} AND {batched} THEN 'range_batches'
                 WHEN key_kind = 'text' AND {batched} THEN 'hash_batches'
                 WHEN {spread} AND parts > 1 THEN 'key_partitioned'
                 ELSE 'single' END AS strategy""",
    )
    # What the slices of a table divide, and how much of it a slice takes. A slice is to have a batch of rows, so
    # their number follows from the rows: however sparse a key is, it gets no more slices than that.
    measured = chosen.selectExpr(
        "*",
        f"""CASE strategy WHEN 'range_batches' THEN {span}
                          WHEN 'hash_batches' THEN CAST(rows AS {WIDE})
                          WHEN 'page_batches' THEN CAST(pages AS {WIDE}) END AS extent""",
        "greatest(1L, (rows + greatest(1L, pages) - 1) div greatest(1L, pages)) AS rows_per_page",
        f"greatest(1L, (rows + {batch} - 1) div {batch}) AS wanted",
    )
    sliced = measured.selectExpr(
        "*",
        f"""CASE strategy WHEN 'page_batches' THEN greatest(1L, ({batch} + rows_per_page - 1) div rows_per_page)
                          WHEN 'hash_batches' THEN {batch}
                          WHEN 'range_batches' THEN (extent + wanted - 1) div wanted END AS slice_width""",
    )
    batches = "CASE WHEN extent IS NOT NULL THEN (extent + slice_width - 1) div slice_width ELSE 1L END AS batches"
    return sliced.selectExpr("*", batches).select(*PLAN_COLUMNS)


def plan_frame(spark: SparkSession, entries: Sequence[Row]) -> DataFrame:
    """A plan from collected entries: what was profiled once is not profiled again."""
    return local_frame(spark, [tuple(e[c] for c in PLAN_COLUMNS) for e in entries], PLAN_SCHEMA)


def compaction_targets(plan: DataFrame) -> DataFrame:
    """Tables that were loaded slice by slice, whose files are therefore small."""
    return plan.filter(F.col("strategy").isin(*BATCHED))
