"""Catalog operators, over catalog frames derived from the ``events`` table.

Every user of a day is taken for a table, every event for one of its columns, so the catalog grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import check
from checks.tables import table
from snaplake.plans.catalog import (
    TABLE_ID, assign_page_keys, count_tables, discover_keys, estimate_pages, list_namespaces, list_tables,
    stale_tables, target_names,
)

def of_type(values: dict[str, Column | str], otherwise: Column | str | None = None) -> Column:
    chain = F
    for event_type, value in values.items():
        chain = chain.when(F.col("event_type") == event_type, value)
    return chain.otherwise(otherwise)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.when(F.col("user_id") % 2 == 0, "mysql").otherwise("postgresql")
    return table(spark, sf_dir, "events").withColumn("source", source).withColumn("day", F.date_format("ts", "dd"))


def _named(spark: SparkSession, sf_dir: str) -> DataFrame:
    ns = of_type(
        {
            "view": F.concat(F.lit("shop_"), "day"),
            "click": "mysql",
            "purchase": "information_schema",
            "signup": F.concat(F.lit("pg_temp_"), "day"),
        },
        "performance_schema",
    )
    return events(spark, sf_dir).select(
        "source",
        ns.alias("ns"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("table"),
        F.when(F.col("user_id") % 5 == 0, "VIEW").otherwise("BASE TABLE").alias("table_type"),
    )


_NAMED_SQL = """named AS (SELECT DISTINCT CASE WHEN user_id % 2 = 0 THEN 'mysql' ELSE 'postgresql' END AS source,
  CASE event_type WHEN 'view' THEN 'shop_' || strftime(ts, '%d') WHEN 'click' THEN 'mysql'
    WHEN 'purchase' THEN 'information_schema' WHEN 'signup' THEN 'pg_temp_' || strftime(ts, '%d')
    ELSE 'performance_schema' END AS ns,
  'user_' || user_id AS "table", CASE WHEN user_id % 5 = 0 THEN 'VIEW' ELSE 'BASE TABLE' END AS table_type FROM events),
user_ns AS (SELECT DISTINCT source, ns FROM named WHERE CASE source
  WHEN 'mysql' THEN ns NOT IN ('information_schema', 'performance_schema', 'mysql', 'sys')
  ELSE ns <> 'information_schema' AND ns NOT LIKE 'pg#_%' ESCAPE '#' END),
listed AS (SELECT DISTINCT source, ns, "table" FROM named SEMI JOIN user_ns USING (source, ns)
  WHERE source = 'mysql' OR table_type = 'BASE TABLE')"""


@check("catalog_namespaces", f"WITH {_NAMED_SQL} SELECT source, ns FROM user_ns ORDER BY 1, 2")
def catalog_namespaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_namespaces(_named(spark, sf_dir))


@check("catalog_tables", f'WITH {_NAMED_SQL} SELECT source, ns, "table" FROM listed ORDER BY 1, 2, 3')
def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = _named(spark, sf_dir)
    return list_tables(named, named)


@check("catalog_table_count", f"WITH {_NAMED_SQL} SELECT source, ns, count(*) AS n_tables FROM listed GROUP BY 1, 2")
def catalog_table_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = _named(spark, sf_dir)
    return count_tables(list_tables(named, named))


@check(
    "target_names",
    f"""WITH {_NAMED_SQL} SELECT source, ns, "table",
    source || '/' || CASE source WHEN 'postgresql' THEN 'postgres/' ELSE '' END || ns || '/' || "table" AS target_path,
    '`lakehouse`.`' || source || '`.' || CASE source WHEN 'postgresql' THEN '`postgres`.' ELSE '' END
      || '`' || ns || '`.`' || "table" || '`' AS target_name FROM listed""",
)
def target_names_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = _named(spark, sf_dir)
    return target_names(list_tables(named, named), "lakehouse")


# --- tables of a day ------------------------------------------------------------------------------------


def _columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("value") >= 20
    return events(spark, sf_dir).select(
        "source",
        F.concat(F.lit("d"), "day").alias("ns"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("table"),
        F.concat(F.lit("c"), F.col("event_id").cast("string")).alias("column"),
        F.col("event_id").alias("ordinal"),
        F.when(key, "pk").otherwise("uq").alias("constraint_name"),
        F.when(key, "PRIMARY KEY").otherwise("UNIQUE").alias("constraint_type"),
        of_type({"signup": "bigint", "click": "int", "error": "integer", "view": "varchar"}, "decimal").alias("data_type"),
        F.floor("value").cast("bigint").alias("size"),
        "event_type",
        "ts",
    )


def _relations(columns: DataFrame) -> DataFrame:
    """Row and page figures per table: some negative, some zero."""
    return columns.groupBy(*TABLE_ID).agg(
        (F.max("size") - 40).alias("rows"), F.greatest(F.min("size") - 15, F.lit(0)).alias("pages")
    )


_COLUMNS_SQL = """cols AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'mysql' ELSE 'postgresql' END AS source,
  'd' || strftime(ts, '%d') AS ns, 'user_' || user_id AS "table", 'c' || event_id AS "column", event_id AS ordinal,
  CASE WHEN value >= 20 THEN 'PRIMARY KEY' ELSE 'UNIQUE' END AS constraint_type,
  CASE event_type WHEN 'signup' THEN 'bigint' WHEN 'click' THEN 'int' WHEN 'error' THEN 'integer'
    WHEN 'view' THEN 'varchar' ELSE 'decimal' END AS data_type,
  floor(value)::BIGINT AS size, event_type, ts FROM events),
rels AS (SELECT source, ns, "table", max(size) - 40 AS "rows", greatest(min(size) - 15, 0) AS pages FROM cols
  GROUP BY ALL)"""


@check(
    "key_discovery",
    f"""WITH {_COLUMNS_SQL},
    firsts AS (SELECT source, ns, "table", arg_min("column", ordinal) AS first_key,
      list("column" ORDER BY ordinal) AS all_keys,
      arg_min("column", ordinal) FILTER (WHERE CASE source
        WHEN 'mysql' THEN data_type IN ('tinyint', 'smallint', 'mediumint', 'int', 'bigint')
        ELSE data_type IN ('smallint', 'integer', 'bigint') END) AS numeric_key
      FROM cols WHERE constraint_type = 'PRIMARY KEY' GROUP BY 1, 2, 3)
    SELECT r.source, r.ns, r."table",
      coalesce(numeric_key, CASE r.source WHEN 'mysql' THEN first_key END) AS key_column,
      nullif(array_to_string(list_filter(all_keys,
        lambda c: c <> coalesce(numeric_key, CASE r.source WHEN 'mysql' THEN first_key END)), chr(31)), '') AS salt_column,
      CASE WHEN numeric_key IS NOT NULL THEN 'numeric'
           WHEN r.source = 'mysql' AND first_key IS NOT NULL THEN 'text'
           WHEN r.source = 'postgresql' AND r."rows" > 0 THEN 'page' ELSE 'none' END AS key_kind
    FROM rels r LEFT JOIN firsts f ON r.source = f.source AND r.ns = f.ns AND r."table" = f."table" """,
)
def key_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = _columns(spark, sf_dir)
    relations = _relations(columns)
    constraints = columns.select(*TABLE_ID, "constraint_name", "constraint_type").distinct()
    usage = columns.select(*TABLE_ID, "constraint_name", "column", "ordinal")
    keys = discover_keys(relations, constraints, usage, columns.select(*TABLE_ID, "column", "data_type"))
    sized = keys.join(relations.select(*TABLE_ID, "rows"), TABLE_ID, "left")
    return assign_page_keys(sized).select(*TABLE_ID, "key_column", "salt_column", "key_kind")


@check(
    "page_estimate",
    f"""WITH {_COLUMNS_SQL},
    widths AS (SELECT source, ns, "table", sum(nullif(size, 0)) AS w FROM cols GROUP BY 1, 2, 3)
    SELECT r.source, r.ns, r."table", greatest("rows", 0) AS "rows",
      CASE WHEN pages > 0 THEN pages
           WHEN "rows" > 0 THEN greatest(1, ("rows" * coalesce(w, 100)::BIGINT) // 8192) ELSE 0 END::BIGINT AS pages
    FROM rels r LEFT JOIN widths s ON r.source = s.source AND r.ns = s.ns AND r."table" = s."table" """,
)
def page_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = _columns(spark, sf_dir)
    widths = columns.select(*TABLE_ID, "column", F.nullif("size", F.lit(0)).alias("avg_width"))
    return estimate_pages(_relations(columns), widths)


NOW = "2024-01-20 12:00:00"
FIVE_DAYS = 432_000


@check(
    "stale_stats",
    f"""WITH {_COLUMNS_SQL},
    times AS (SELECT source, ns, "table", coalesce(max(ts) FILTER (WHERE event_type = 'signup'),
      max(ts) FILTER (WHERE event_type = 'purchase'),
      max(ts) FILTER (WHERE event_type = 'view' AND source = 'mysql')) AS since FROM cols GROUP BY 1, 2, 3),
    ages AS (SELECT source, ns, "table", CASE WHEN since IS NOT NULL THEN greatest(0,
      (epoch_us(TIMESTAMP '{NOW}') - epoch_us(since) + CASE source WHEN 'postgresql' THEN 500000 ELSE 0 END)
      // 1000000) END AS age_s FROM times)
    SELECT source, ns, "table", coalesce(age_s, -1) AS age_s FROM ages WHERE age_s >= {FIVE_DAYS} OR (age_s IS NULL AND source = 'postgresql')""",
)
def stale_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = _columns(spark, sf_dir)

    def latest(event_type: str, also: Column) -> Column:
        return F.max(F.when((F.col("event_type") == event_type) & also, F.col("ts")))

    times = columns.groupBy(*TABLE_ID).agg(
        latest("signup", F.lit(True)).alias("last_update"),
        latest("purchase", F.lit(True)).alias("update_time"),
        latest("view", F.col("source") == "mysql").alias("create_time"),
    )
    tables = columns.select(*TABLE_ID).distinct()
    stale = stale_tables(tables, times, F.lit(NOW).cast("timestamp_ntz"), FIVE_DAYS)
    return stale.fillna(-1, ["age_s"])  # unknown ages
