"""Catalog operators: which tables there are, how they are keyed and whose statistics are stale.

Every function takes catalog frames (DataFrames) and returns one, so a catalog of any size stays distributed.

=============  =================================================================================
namespaces     source, ns
tables         source, ns, table, table_type
constraints    source, ns, table, constraint_name, constraint_type
key_usage      source, ns, table, constraint_name, column, ordinal
columns        source, ns, table, column, data_type
relations      source, ns, table, rows, pages
column_stats   source, ns, table, column, avg_width
stats_times    source, ns, table, last_update, update_time, create_time
=============  =================================================================================

``source`` is the name of a dialect. For PostgreSQL ``last_update`` holds the last automatic analyze,
``update_time`` the last manual one, and ``create_time`` is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaplake.functions.expressions import age_seconds, at_least, int_div, quoted
from snaplake.sources.dialects import DIALECTS, Dialect

TABLE_ID = ["source", "ns", "table"]

# Bytes of a physical page, and the row width assumed when no column width is known.
PAGE_BYTES = 8192
DEFAULT_ROW_WIDTH = 100

# Between the names in ``salt_column``; no column is named with it.
SALT_SEPARATOR = "\x1f"


def by_source(rule: Callable[[Dialect], str]) -> Column:
    """A per-dialect rule, given as SQL text, as one expression over the ``source`` column."""
    return F.expr("CASE source " + " ".join(f"WHEN '{d.name}' THEN {rule(d)}" for d in DIALECTS.values()) + " END")


def one_of(column: str, values: Iterable[str]) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in values)})"


def _is_system(d: Dialect) -> str:
    named = one_of("ns", d.system_namespaces)
    return f"({named} OR startswith(ns, '{d.system_prefix}'))" if d.system_prefix else named


def list_namespaces(namespaces: DataFrame) -> DataFrame:
    """User namespaces of every source, ordered by name."""
    user = namespaces.filter(~by_source(_is_system)).select("source", "ns").distinct()
    return user.orderBy("source", "ns")


def list_tables(tables: DataFrame, namespaces: DataFrame) -> DataFrame:
    """Tables of the user namespaces, ordered by name; views only where the source lists them."""
    listed = by_source(lambda d: "true" if d.lists_views else "table_type = 'BASE TABLE'")
    user = namespaces.filter(~by_source(_is_system)).select("source", "ns").distinct()
    found = tables.filter(listed).select(*TABLE_ID).distinct()
    return found.join(user, ["source", "ns"], "left_semi").orderBy(*TABLE_ID)


def count_tables(tables: DataFrame) -> DataFrame:
    """Tables per source and namespace."""
    return tables.groupBy("source", "ns").agg(F.count(F.lit(1)).alias("n_tables"))


def discover_keys(
    tables: DataFrame, constraints: DataFrame, key_usage: DataFrame, columns: DataFrame
) -> DataFrame:
    """The column each table is read by: its first integer key column, else (MySQL) its first key column.

    Adds ``key_column``, ``key_kind`` (numeric, text or none) and ``salt_column`` to ``tables``. The salt names all
    other columns of a composite key: one value of the key column alone may hold most of the rows, and so may one value
    of any other column.
    """
    primary = constraints.filter(F.col("constraint_type") == "PRIMARY KEY")
    usable = by_source(lambda d: one_of("data_type", d.integer_types))
    first_keys = (
        primary.join(key_usage, [*TABLE_ID, "constraint_name"])
        .join(columns, [*TABLE_ID, "column"])
        .groupBy(*TABLE_ID)
        .agg(
            F.min_by("column", F.when(usable, F.col("ordinal"))).alias("numeric_key"),
            F.min_by("column", "ordinal").alias("first_key"),
            F.array_sort(F.collect_list(F.struct("ordinal", "column"))).alias("all_keys"),
        )
    )
    has_number = F.col("numeric_key").isNotNull()
    has_text = F.col("first_key").isNotNull() & by_source(lambda d: str(d.text_keys))
    keyed = tables.select(*TABLE_ID).join(first_keys, TABLE_ID, "left").select(
        *TABLE_ID, "all_keys",
        F.when(has_number, F.col("numeric_key")).when(has_text, F.col("first_key")).alias("key_column"),
        F.when(has_number, "numeric").when(has_text, "text").otherwise("none").alias("key_kind"),
    )
    others = F.filter(F.col("all_keys.column"), lambda c: c != F.col("key_column"))
    salt = F.when(F.size(others) > 0, F.array_join(others, SALT_SEPARATOR))
    return keyed.select(*TABLE_ID, "key_column", salt.alias("salt_column"), "key_kind")


def salts_of(salt_column: str | None) -> list[str]:
    """The names in a ``salt_column``."""
    return salt_column.split(SALT_SEPARATOR) if salt_column else []


def assign_page_keys(keys: DataFrame) -> DataFrame:
    """Keyless tables with rows are read by physical page where the source has pages. Needs ``rows``."""
    by_page = (F.col("key_kind") == "none") & by_source(lambda d: str(d.physical_pages)) & (F.col("rows") > 0)
    return keys.withColumn("key_kind", F.when(by_page, "page").otherwise(F.col("key_kind")))


def stats_age(tables: DataFrame, stats_times: DataFrame, now: Column) -> DataFrame:
    """Age in seconds of every table's statistics; null when the source does not know."""
    since = F.coalesce("last_update", "update_time", "create_time")
    age = age_seconds(since, now, rounded=by_source(lambda d: str(d.rounds_age)))
    return tables.join(stats_times, TABLE_ID, "left").select(*TABLE_ID, age.alias("age_s"))


def stale_tables(tables: DataFrame, stats_times: DataFrame, now: Column, max_age_seconds: int) -> DataFrame:
    """Tables whose statistics are at least ``max_age_seconds`` old; none when that is not positive.

    A table of unknown age counts as stale or not as its source has it.
    """
    unknown = by_source(lambda d: str(d.unknown_age_is_stale))
    stale = F.coalesce(F.col("age_s") >= max_age_seconds, unknown)
    return stats_age(tables, stats_times, now).filter(stale & F.lit(max_age_seconds > 0))


def row_estimate(rows: Column) -> Column:
    """A catalog's row estimate; a missing or negative one counts as no rows."""
    return at_least(0, F.coalesce(rows, F.lit(0)).cast("bigint"))


def row_widths(column_stats: DataFrame) -> DataFrame:
    """Bytes of a row of each table, where its columns' widths are known."""
    return column_stats.groupBy(*TABLE_ID).agg(F.sum("avg_width").cast("bigint").alias("row_width"))


def pages_of(rows: Column, row_width: Column) -> Column:
    """Pages that so many rows take, at least one."""
    width = F.when(row_width > 0, row_width).otherwise(F.lit(DEFAULT_ROW_WIDTH)).cast("bigint")
    return at_least(1, int_div(rows * width, F.lit(PAGE_BYTES)))


def estimate_pages(relations: DataFrame, column_stats: DataFrame) -> DataFrame:
    """Physical pages per table: the catalog's figure, else an estimate from rows and the width of a row."""
    widths = row_widths(column_stats)
    rows = row_estimate(F.col("rows"))
    estimated = pages_of(rows, F.col("row_width"))
    pages = F.when(F.col("pages") > 0, F.col("pages")).when(rows > 0, estimated).otherwise(F.lit(0))
    return relations.join(widths, TABLE_ID, "left").select(
        *TABLE_ID, rows.alias("rows"), pages.cast("bigint").alias("pages")
    )


def target_path(source: Column, database: Column, ns: Column, table: Column) -> Column:
    """Folder of a table under the warehouse; the database level exists only where the source has one."""
    return F.concat_ws("/", source, F.when(source == "postgresql", database), ns, table)


def target_names(tables: DataFrame, catalog: str, database: str = "postgres") -> DataFrame:
    """Where each table lands: its path under the warehouse and its quoted catalog name."""
    levels = [
        F.lit(catalog),
        F.col("source"),
        F.when(F.col("source") == "postgresql", F.lit(database)),
        F.col("ns"),
        F.col("table"),
    ]
    return tables.select(
        *TABLE_ID,
        target_path(F.col("source"), F.lit(database), F.col("ns"), F.col("table")).alias("target_path"),
        F.concat_ws(".", *[quoted(level, "`") for level in levels]).alias("target_name"),
    )
