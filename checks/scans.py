"""Scans and filters."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from checks.registry import check
from checks.tables import NS, ROWS_PER_PAGE, SINGLE_SHOT, plan_entry, source, table
from snaplake.functions.expressions import hash_bucket
from snaplake.functions.filters import to_column, to_sql
from snaplake import FileSource, FileTable, MYSQL, POSTGRESQL
from snaplake.plans.load_plan import plan_frame
from snaplake.plans.slices import in_page_slice, plan_slices, reader_intervals
from snaplake.workspace import shared_dir


@check("scan_full", "SELECT * FROM orders")
def scan_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "mysql").scan(NS["mysql"], "orders")


@check(
    "scan_pk_partitioned",
    """WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders),
    s AS (SELECT lo + (hi - lo) // 4 AS lo, hi - (hi - lo) // 4 AS hi FROM b)
    SELECT o.*, (least(greatest(o_orderkey, s.lo), s.hi) - s.lo) // ((s.hi - s.lo + 1 + 3) // 4) AS part_no
    FROM orders o, s""",
)
def scan_pk_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row, with the reader it falls to when the bounds span only the middle of the keys."""
    src = source(spark, sf_dir, "mysql")
    entry = plan_entry(src, "orders", SINGLE_SHOT)
    quarter = (entry["hi"] - entry["lo"]) // 4
    middle = Row(**(entry.asDict() | {"lo": entry["lo"] + quarter, "hi": entry["hi"] - quarter}))
    return _by_reader(spark, src, middle)


def _by_reader(spark: SparkSession, src: FileSource, entry: Row) -> DataFrame:
    """The table as the readers of its slices read it, one after the other, with the reader's number."""
    readers = reader_intervals(plan_slices(plan_frame(spark, [entry]))).orderBy("slice_no", "part_no").collect()
    frames = [src.read_slice(entry, r).withColumn("part_no", F.lit(r["part_no"]).cast("bigint")) for r in readers]
    return functools.reduce(DataFrame.unionByName, frames)


@check(
    "scan_pk_range",
    """WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) - min(o_orderkey) + 1 AS span FROM orders)
    SELECT o.* FROM orders o, b WHERE o_orderkey BETWEEN lo + span // 4 AND lo + span // 4 + span // 2 - 1""",
)
def scan_pk_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = source(spark, sf_dir, "mysql")
    entry = plan_entry(src, "orders")
    span = entry["hi"] - entry["lo"] + 1
    lo = entry["lo"] + span // 4
    piece = Row(unit="key", slice_no=1, slices=3, lo=lo, hi=lo + span // 2 - 1, open_low=False, open_high=False)
    return src.read_slice(entry, piece)


@check("scan_page_parallel", "SELECT * FROM lineitem")
def scan_page_parallel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row once, read by the readers of disjoint page intervals, of a table in several files."""
    src = _in_files(spark, sf_dir)
    return _by_reader(spark, src, plan_entry(src, "lineitem", SINGLE_SHOT)).drop("part_no")


def _in_files(spark: SparkSession, sf_dir: str, files: int = 6) -> FileSource:
    """``lineitem`` in several files of its own: each task that reads it writes what it has read, to one file or more."""
    staged = shared_dir(spark, "lineitem")
    rows = source(spark, sf_dir, "postgresql").scan(NS["postgresql"], "lineitem")
    rows.write.option("maxRecordsPerFile", max(1, -(-rows.count() // files))).parquet(staged)
    tables = {(NS["postgresql"], "lineitem"): FileTable(staged)}
    return FileSource(spark, POSTGRESQL, tables, rows_per_page=ROWS_PER_PAGE)


@check(
    "scan_page_range",
    f"""WITH n AS (SELECT count(*) AS n FROM lineitem),
    pages AS (SELECT unnest(range((n + {ROWS_PER_PAGE - 1}) // {ROWS_PER_PAGE})) AS page, n FROM n)
    SELECT page, least({ROWS_PER_PAGE}, n - page * {ROWS_PER_PAGE}) AS n_rows FROM pages""",
)
def scan_page_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every page of a table without a key, each page read as a slice of its own group of ten."""
    src = source(spark, sf_dir, "postgresql")
    entry = plan_entry(src, "lineitem")
    tens = Row(**entry.asDict() | {"strategy": "page_batches", "slice_width": 10, "batches": max(1, -(-entry["pages"] // 10))})
    slices = plan_slices(plan_frame(spark, [tens])).select("slice_no", "lo", "hi", "open_high")
    pages = src.paged(NS["postgresql"], "lineitem").groupBy("page").agg(F.count(F.lit(1)).alias("n_rows"))
    number = F.least(F.call_function("div", F.col("page"), F.lit(10).cast("bigint")), F.lit(tens["batches"] - 1).cast("bigint"))
    of_slice = pages.withColumn("slice_no", number).join(slices, "slice_no")
    return of_slice.filter(in_page_slice(F.col("page"), F.col("lo"), F.col("hi"), F.col("open_high"))).select("page", "n_rows")


# CRC-32 (polynomial 0xEDB88320) over the bytes of the url, which DuckDB has no function for.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT,
  list_transform(range(octet_length(encode(url))), lambda i: ('0x' || substr(hex(encode(url)), (2 * i + 1)::BIGINT, 2))::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))),
  4294967295::BIGINT)"""


@check("scan_hash_bucket", f"SELECT *, {_CRC32} % 4 AS bucket FROM pages")
def scan_hash_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.withColumn("bucket", hash_bucket(F.col("url"), 4))


PURCHASES = {
    "logic": "and",
    "conditions": [
        {"field": "event_type", "op": "eq", "value": "purchase"},
        {"field": "ts", "op": "gte", "value": "2024-01-10"},
    ],
    "groups": [],
}


@check("scan_filtered", "SELECT * FROM events WHERE event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-10'")
def scan_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "postgresql").scan_where(NS["postgresql"], "events", PURCHASES)


def _filtered(name: str, of: str, group: dict, sql: str) -> None:
    @check(name, sql)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = table(spark, sf_dir, of)
        return df.filter(to_column(group, df.schema))


def _one(field: str, op: str, value: object = None) -> dict:
    return {"conditions": [{"field": field, "op": op, "value": value}]}


_filtered("filter_eq", "orders", _one("o_orderstatus", "eq", "F"), "SELECT * FROM orders WHERE o_orderstatus = 'F'")
_filtered("filter_ne", "events", _one("event_type", "ne", "view"), "SELECT * FROM events WHERE event_type <> 'view'")
_filtered("filter_gt", "orders", _one("o_totalprice", "gt", 250000.5), "SELECT * FROM orders WHERE o_totalprice > 250000.5")
_filtered(
    "filter_gte", "orders", _one("o_orderdate", "gte", "1998-01-01"),
    "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'",
)
_filtered("filter_lt", "lineitem", _one("l_quantity", "lt", 10), "SELECT * FROM lineitem WHERE l_quantity < 10")
_filtered("filter_lte", "events", _one("value", "lte", 100), "SELECT * FROM events WHERE value <= 100")
_filtered(
    "filter_like", "orders", _one("o_orderpriority", "like", "_-%I%"),
    "SELECT * FROM orders WHERE o_orderpriority LIKE '_-%I%'",
)
_filtered(
    "filter_in", "events", _one("event_type", "in", ["purchase", "signup", None]),
    "SELECT * FROM events WHERE event_type IN ('purchase', 'signup', NULL)",
)
_filtered(
    "filter_between", "orders", _one("o_orderdate", "between", ["1996-01-01", "1997-12-31"]),
    "SELECT * FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31'",
)
_filtered(
    "filter_nested",
    "orders",
    {
        "logic": "and",
        "conditions": [
            {"field": "o_orderpriority", "op": "like", "value": "1-%"},
            {"field": "o_orderstatus", "op": "in", "value": ["F", "O"]},
        ],
        "groups": [
            {
                "logic": "or",
                "conditions": [
                    {"field": "o_totalprice", "op": "between", "value": [1000, 200000]},
                    {"field": "o_orderstatus", "op": "is_null"},
                ],
                "groups": [
                    {"conditions": [
                        {"field": "o_orderdate", "op": "lt", "value": "1996-01-01"},
                        {"field": "o_orderstatus", "op": "eq", "value": "O"},
                    ]}
                ],
            }
        ],
    },
    """SELECT * FROM orders WHERE o_orderpriority LIKE '1-%' AND o_orderstatus IN ('F', 'O')
    AND (o_totalprice BETWEEN 1000 AND 200000 OR o_orderstatus IS NULL
         OR (o_orderdate < TIMESTAMP '1996-01-01' AND o_orderstatus = 'O'))""",
)


def _nullable_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without the priority of the least urgent ones: the given tables hold no nulls."""
    urgent = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").withColumn("o_orderpriority", urgent)


_NULLABLE_SQL = "SELECT * REPLACE (nullif(o_orderpriority, '5-LOW') AS o_orderpriority) FROM orders"


@check("filter_is_null", f"SELECT * FROM ({_NULLABLE_SQL}) WHERE o_orderpriority IS NULL")
def filter_is_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _nullable_orders(spark, sf_dir)
    return df.filter(to_column(_one("o_orderpriority", "is_null"), df.schema))


@check("filter_is_not_null", f"SELECT * FROM ({_NULLABLE_SQL}) WHERE o_orderpriority IS NOT NULL")
def filter_is_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _nullable_orders(spark, sf_dir)
    return df.filter(to_column(_one("o_orderpriority", "is_not_null"), df.schema))


RENDERED = {
    "logic": "or",
    "conditions": [
        {"field": "event_type", "op": "in", "value": ["purchase", "it's", None]},
        {"field": "props", "op": "is_null"},
    ],
    "groups": [
        {
            "conditions": [
                {"field": "event_type", "op": "like", "value": "s_gn%"},
                {"field": "value", "op": "between", "value": [10, 50.5]},
                {"field": "user_id", "op": "ne", "value": 7},
            ],
        },
        {"conditions": [{"field": "event_id", "op": "lt", "value": 100}, {"field": "value", "op": "gte", "value": 100}]},
    ],
}


@check(
    "filter_rendered",
    """SELECT * FROM events WHERE event_type IN ('purchase', 'it''s', NULL) OR props IS NULL
    OR (event_type LIKE 's_gn%' AND value BETWEEN 10 AND 50.5 AND user_id <> 7) OR (event_id < 100 AND value >= 100)""",
)
def filter_rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that pass the text that a filter is sent to a MySQL source as; Spark reads that text the same way."""
    return table(spark, sf_dir, "events").filter(F.expr(to_sql(RENDERED, MYSQL)))
