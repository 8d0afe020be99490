"""The given tables as two sources, with the settings that make every planning rule fire on them."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Row, SparkSession

from snaplake import FileSource, FileTable, LoadConfig, MYSQL, POSTGRESQL, ParquetSink, plan_source
from snaplake.workspace import shared_dir

CFG = LoadConfig(num_threads=4, chunk_size=200, large_table_threshold=1_000, large_table_batch_size=500)
SINGLE_SHOT = LoadConfig(
    num_threads=4, chunk_size=200, large_table_threshold=1_000, large_table_batch_size=500, single_shot=True
)
ROWS_PER_PAGE = 1_000

# Declared keys: parquet carries no constraints.
KEYS = {
    "mysql": {
        "orders": ("o_orderkey",),
        "customer": ("c_name",),
        "conversations": ("conv_id", "turn"),
        "supplier": ("s_suppkey",),
        "labels": (),
        "region": ("r_regionkey",),
        "nation": ("n_nationkey",),
        "benchmark": ("item_id",),
    },
    "postgresql": {
        "part": ("p_partkey",),
        "events": ("user_id", "event_id"),
        "lineitem": (),
        "pages": ("url",),
        "documents": ("doc_id",),
        "embeddings": ("vec_id",),
    },
}
NS = {"mysql": "shop", "postgresql": "app"}
TEXT_KEYS = {"c_name", "url"}
DIALECT = {"mysql": MYSQL, "postgresql": POSTGRESQL}


def source(spark: SparkSession, sf_dir: str, kind: str, **options) -> FileSource:
    tables = {(NS[kind], t): FileTable(f"{sf_dir.rstrip('/')}/{t}.parquet", k) for t, k in KEYS[kind].items()}
    return FileSource(spark, DIALECT[kind], tables, rows_per_page=ROWS_PER_PAGE, **options)


def sources(spark: SparkSession, sf_dir: str) -> list[FileSource]:
    return [source(spark, sf_dir, kind) for kind in KEYS]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    kind = next(k for k, tables in KEYS.items() if name in tables)
    return source(spark, sf_dir, kind).scan(NS[kind], name)


def full_plan(spark: SparkSession, sf_dir: str, cfg: LoadConfig = CFG) -> DataFrame:
    plans = [plan_source(s, cfg) for s in sources(spark, sf_dir)]
    return functools.reduce(DataFrame.unionByName, plans)


def plan_entry(src: FileSource, name: str, cfg: LoadConfig = CFG) -> Row:
    return plan_entries(src, cfg)[name]


def plan_entries(src: FileSource, cfg: LoadConfig = CFG) -> dict[str, Row]:
    return {e["table"]: e for e in plan_source(src, cfg).collect()}


def new_sink(spark: SparkSession) -> ParquetSink:
    """A sink over a fresh folder, with database names of its own."""
    folder = shared_dir(spark, "snaplake")
    return ParquetSink(spark, folder, prefix=f"s{folder[-12:]}_")


# --- the same, as SQL -----------------------------------------------------------------------------------


def _profile_sql() -> str:
    selects = []
    for kind, tables in KEYS.items():
        for name, key in tables.items():
            numeric = [k for k in key if k not in TEXT_KEYS]
            if numeric:
                how, column = "'numeric'", f"'{numeric[0]}'"
                bounds = f"coalesce(min({numeric[0]}), 0)::BIGINT AS lo, coalesce(max({numeric[0]}), 0)::BIGINT AS hi"
            else:
                text = key and kind == "mysql"
                column = f"'{key[0]}'" if text else "NULL::VARCHAR"
                how = "'text'" if text else "CASE WHEN count(*) > 0 THEN 'page' ELSE 'none' END"
                how = how if kind == "postgresql" or text else "'none'"
                bounds = "0::BIGINT AS lo, 0::BIGINT AS hi"
            salt = f"'{key[-1]}'" if len(key) > 1 else "NULL::VARCHAR"
            selects.append(
                f"SELECT '{kind}' AS source, '{NS[kind]}' AS ns, '{name}' AS \"table\", {column} AS key_column, "
                f"{salt} AS salt_column, {how} AS key_kind, count(*) AS \"rows\", {bounds}, "
                f"(count(*) + {ROWS_PER_PAGE - 1}) // {ROWS_PER_PAGE} AS pages FROM {name}"
            )
    return "profile AS (" + "\nUNION ALL ".join(selects) + ")"


def plan_sql(cfg: LoadConfig) -> str:
    """CTEs ``profile`` and ``plan``."""
    t, b = cfg.large_table_threshold, cfg.large_table_batch_size
    single = str(cfg.single_shot).lower()
    return f"""WITH {_profile_sql()},
sized AS (SELECT source, ns, "table", key_column, salt_column, key_kind, "rows", lo, hi,
  CASE WHEN key_kind = 'page' THEN greatest(pages, 1) ELSE pages END AS pages,
  CASE WHEN key_kind = 'page' OR (key_kind = 'numeric' AND hi > lo)
       THEN greatest(1, least(("rows" + {cfg.chunk_size - 1}) // {cfg.chunk_size}, {cfg.num_threads}))
       ELSE 1 END AS parts,
  "rows" >= {t} AS large FROM profile),
chosen AS (SELECT *, CASE
  WHEN key_kind = 'page' AND ({single} OR NOT large) THEN 'page_parallel'
  WHEN key_kind = 'page' THEN 'page_batches'
  WHEN source = 'postgresql' AND key_kind = 'numeric' AND large AND NOT {single} AND hi - lo + 1 < {b} AND pages > 0
    THEN 'page_batches'
  WHEN key_kind = 'numeric' AND hi > lo AND large AND NOT {single} THEN 'range_batches'
  WHEN key_kind = 'text' AND large AND NOT {single} THEN 'hash_batches'
  WHEN key_kind = 'numeric' AND hi > lo AND parts > 1 THEN 'key_partitioned'
  ELSE 'single' END AS strategy FROM sized),
measured AS (SELECT *, CASE strategy WHEN 'range_batches' THEN hi - lo + 1 WHEN 'hash_batches' THEN "rows"
  WHEN 'page_batches' THEN pages END AS extent FROM chosen),
widened AS (SELECT *, CASE strategy
  WHEN 'page_batches' THEN greatest(1, ceil({b} / greatest(1, ceil("rows" / pages)))::BIGINT)
  WHEN 'hash_batches' THEN {b}
  WHEN 'range_batches' THEN ceil(extent / greatest(1, ceil("rows" / {b})))::BIGINT END AS slice_width FROM measured),
plan AS (SELECT source, ns, "table", key_column, salt_column, key_kind, "rows", lo, hi, pages, parts, large, strategy, slice_width,
  CASE WHEN extent IS NOT NULL THEN (extent + slice_width - 1) // slice_width ELSE 1 END AS batches FROM widened)
"""


def counts_sql() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{kind}' AS source, '{NS[kind]}' AS ns, '{name}' AS \"table\", count(*) AS \"rows\" FROM {name}"
        for kind, tables in KEYS.items()
        for name in tables
    )
