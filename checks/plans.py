"""Profiles, plans and slices of the given tables."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from checks.registry import check
from checks.tables import CFG, SINGLE_SHOT, full_plan, plan_entries, plan_sql, sources
from snaplake.operators.coverage import slice_coverage
from snaplake.plans.catalog import TABLE_ID, assign_page_keys, discover_keys, list_tables
from snaplake.plans.load_plan import compaction_targets as batched_tables
from snaplake.plans.load_plan import BATCHED
from snaplake.plans.slices import plan_slices


@check("table_profile", plan_sql(CFG) + 'SELECT source, ns, "table", key_column, salt_column, key_kind, "rows", lo, hi FROM profile')
def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = []
    for src in sources(spark, sf_dir):
        c = src.catalog()
        keys = discover_keys(list_tables(c.tables, c.namespaces), c.constraints, c.key_usage, c.columns)
        profiles.append(assign_page_keys(src.profile(keys.collect())))
    return functools.reduce(DataFrame.unionByName, profiles).drop("pages")


_PLAN_ROWS = "SELECT * REPLACE (coalesce(slice_width, 0) AS slice_width) FROM plan"


@check("load_plan", plan_sql(CFG) + _PLAN_ROWS)
def load_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return full_plan(spark, sf_dir).fillna(0, ["slice_width"])


@check("plan_single_shot", plan_sql(SINGLE_SHOT) + _PLAN_ROWS)
def plan_single_shot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return full_plan(spark, sf_dir, SINGLE_SHOT).fillna(0, ["slice_width"])


@check(
    "compaction_targets",
    plan_sql(CFG) + """SELECT source, ns, "table", strategy, batches FROM plan
    WHERE strategy IN ('range_batches', 'hash_batches', 'page_batches')""",
)
def compaction_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batched_tables(full_plan(spark, sf_dir)).select(*TABLE_ID, "strategy", "batches")


def _slices(name: str, strategy: str, sql: str) -> None:
    @check(name, plan_sql(CFG) + sql)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        chosen = full_plan(spark, sf_dir).filter(f"strategy = '{strategy}'")
        return plan_slices(chosen).select(
            *TABLE_ID, "slice_no", "slices", "lo", "hi", "open_low", "open_high", "parts"
        )


_EXPLODED = """, numbered AS (SELECT *, unnest(range(batches)) AS i FROM plan WHERE strategy = '{strategy}')
SELECT source, ns, "table", i AS slice_no, batches AS slices, {lo} AS lo, {hi} AS hi,
  {open_low} AS open_low, {open_high} AS open_high, {parts} AS parts FROM numbered"""

_slices("range_slices", "range_batches", _EXPLODED.format(
    strategy="range_batches", lo="lo + i * slice_width", hi="least(hi, lo + (i + 1) * slice_width - 1)",
    open_low="i = 0", open_high="i = batches - 1", parts="parts",
))
_slices("hash_slices", "hash_batches", _EXPLODED.format(
    strategy="hash_batches", lo="i", hi="i", open_low="false", open_high="false", parts="parts",
))
_slices("page_slices", "page_batches", _EXPLODED.format(
    strategy="page_batches", lo="i * slice_width", hi="least((i + 1) * slice_width, pages)",
    open_low="i = 0", open_high="i = batches - 1",
    parts="greatest(1, least(parts, least((i + 1) * slice_width, pages) - i * slice_width))",
))


@check(
    "slice_coverage",
    plan_sql(CFG) + """SELECT source, ns, "table", strategy, batches AS slices, "rows",
    0::BIGINT AS rows_in_none, 0::BIGINT AS rows_in_two FROM plan
    WHERE strategy IN ('range_batches', 'hash_batches', 'page_batches')""",
)
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over the rows of every table that is loaded in slices, each at the slices its plan gives it."""
    found = [slice_coverage(src, e) for src in sources(spark, sf_dir) for e in plan_entries(src).values() if e["strategy"] in BATCHED]
    return functools.reduce(DataFrame.unionByName, found)
