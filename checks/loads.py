"""Loads into a fresh sink, read back."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from checks.registry import check
from checks.tables import CFG, NS, counts_sql, new_sink, plan_entry, plan_sql, source, sources
from snaplake import FileSource, FileTable, LoadFailed, POSTGRESQL, ParquetSink
from snaplake.frames import local_frame
from snaplake.functions.digest import rows_digest
from snaplake.operators.ledger import RunLedger
from snaplake.operators.load import load_all, load_filtered, load_table, target_of
from snaplake.operators.snapshot import plan_source, snapshot
from snaplake.plans.even import slice_of, tie_bits, tie_of
from snaplake.workspace import shared_dir


@check("sink_replace", "SELECT * FROM customer")
def sink_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second replace is the one that counts."""
    src, sink = source(spark, sf_dir, "mysql"), new_sink(spark)
    target = target_of(src, NS["mysql"], "customer")
    sink.replace(src.scan(NS["mysql"], "supplier"), target)
    sink.replace(src.scan(NS["mysql"], "customer"), target)
    return sink.read(target)


@check("sink_append", "SELECT * FROM supplier UNION ALL SELECT * FROM supplier")
def sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, sink = source(spark, sf_dir, "mysql"), new_sink(spark)
    target = target_of(src, NS["mysql"], "supplier")
    sink.replace(src.scan(NS["mysql"], "supplier"), target)
    sink.append(src.scan(NS["mysql"], "supplier"), target)
    return sink.read(target)


@check("load_batched", "SELECT * FROM orders")
def load_batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key range by key range: the first replaces, the others append."""
    src, sink = source(spark, sf_dir, "mysql", slice_by="plan"), new_sink(spark)
    entry = plan_entry(src, "orders")
    load_table(src, sink, entry, publish="incremental")
    return sink.read(target_of(src, NS["mysql"], "orders"))


@check("load_hash_batched", "SELECT * FROM customer")
def load_hash_batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, sink = source(spark, sf_dir, "mysql", slice_by="plan"), new_sink(spark)
    entry = plan_entry(src, "customer")
    load_table(src, sink, entry, publish="incremental")
    return sink.read(target_of(src, NS["mysql"], "customer"))


@check("load_page_batched", "SELECT * FROM lineitem")
def load_page_batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, sink = source(spark, sf_dir, "postgresql", slice_by="plan"), new_sink(spark)
    entry = plan_entry(src, "lineitem")
    load_table(src, sink, entry, publish="incremental")
    return sink.read(target_of(src, NS["postgresql"], "lineitem"))


@check("load_file_batched", "SELECT * FROM events")
def load_file_batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of many files, a group of files at a time."""
    given, staged, sink = source(spark, sf_dir, "postgresql"), new_sink(spark), new_sink(spark)
    target = target_of(given, NS["postgresql"], "events")
    staged.replace(given.scan(NS["postgresql"], "events").repartition(8), target)
    key = (NS["postgresql"], "events")
    src = FileSource(spark, POSTGRESQL, {key: FileTable(staged.location(target), ("user_id", "event_id"))}, rows_per_page=1_000)
    load_table(src, sink, plan_entry(src, "events"), publish="incremental")
    return sink.read(target)


EXPENSIVE_RETURNS = {
    "conditions": [{"field": "l_returnflag", "op": "eq", "value": "R"}],
    "groups": [
        {
            "logic": "or",
            "conditions": [
                {"field": "l_extendedprice", "op": "gte", "value": 50000},
                {"field": "l_shipdate", "op": "between", "value": ["1998-01-01", "1998-12-31"]},
            ],
        }
    ],
}


@check(
    "load_filtered",
    """SELECT * FROM lineitem WHERE l_returnflag = 'R' AND (l_extendedprice >= 50000
    OR l_shipdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-12-31')""",
)
def load_filtered_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, sink = source(spark, sf_dir, "postgresql"), new_sink(spark)
    load_filtered(src, sink, NS["postgresql"], "lineitem", EXPENSIVE_RETURNS)
    return sink.read(target_of(src, NS["postgresql"], "lineitem"))


@check("compact", "SELECT * FROM orders UNION ALL SELECT * FROM orders")
def compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, sink = source(spark, sf_dir, "mysql"), new_sink(spark)
    target = target_of(src, NS["mysql"], "orders")
    orders = src.scan(NS["mysql"], "orders")
    sink.replace(orders, target)
    sink.append(orders, target)
    sink.compact(target)
    return sink.read(target)


@check(
    "load_all",
    f"""SELECT source, ns, "table", "rows" AS rows_observed, "rows" AS rows_landed FROM ({counts_sql()})""",
)
def load_all_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables of both sources; the counts the writes saw, and the rows that can be read back."""
    found = []
    for src in sources(spark, sf_dir):
        sink = new_sink(spark)
        for r in load_all(spark, src, sink, plan_source(src, CFG), CFG):
            landed = sink.read(target_of(src, r.ns, r.table)).agg(F.count(F.lit(1)).alias("rows_landed"))
            found.append(landed.select(
                F.lit(r.source).alias("source"), F.lit(r.ns).alias("ns"), F.lit(r.table).alias("table"),
                F.lit(r.rows).cast("bigint").alias("rows_observed"), "rows_landed",
            ))
    return functools.reduce(DataFrame.unionByName, found)


class FailsOnce:
    """A source whose first read of one table fails."""

    def __init__(self, inner: FileSource, table: str):
        self.inner, self.table = inner, table

    def __getattr__(self, name: str):
        return getattr(self.inner, name)

    def waves(self, entry, group=None, first=0, layout=None):
        if entry["table"] == self.table:
            self.table = None
            raise OSError("the connection was lost")
        return self.inner.waves(entry, group, first, layout)


@check(
    "load_results",
    plan_sql(CFG) + """SELECT source, ns, "table", strategy, "rows", 'success' AS status,
    CASE WHEN "table" IN ('nation', 'part') THEN 2 ELSE 1 END AS attempts FROM plan""",
)
def load_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ledger keeps of two runs, in each of which a table had to be loaded again."""
    found = []
    for src in sources(spark, sf_dir):
        sink = new_sink(spark)
        ledger, failing = RunLedger(spark, sink), FailsOnce(src, "nation" if src.dialect.name == "mysql" else "part")
        ledger.record_results("run", load_all(spark, failing, sink, plan_source(src, CFG), CFG), [])
        found.append(ledger.table_results().drop("run_id", "error", "digest", "compaction_problem"))
    return functools.reduce(DataFrame.unionByName, found)


@check(
    "refresh_stats",
    f"""SELECT source, "table", "rows" FROM ({counts_sql()})""",
)
def refresh_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole snapshots of both sources, then the row counts in the statistics of the landed tables."""
    counts = []
    for src in sources(spark, sf_dir):
        sink = new_sink(spark)
        done = snapshot(src, sink, CFG)
        for r in done.results:
            target = target_of(src, r.ns, r.table)
            if (r.ns, r.table) not in done.refreshed:
                sink.refresh_statistics(target)
            counts.append((r.source, r.table, sink.statistics_rows(target)))
    return local_frame(spark, counts, "source string, table string, rows bigint")


class Unreachable:
    """A source one of whose tables can never be read."""

    def __init__(self, inner: FileSource, table: str):
        self.inner, self.table = inner, table

    def __getattr__(self, name: str):
        return getattr(self.inner, name)

    def waves(self, entry, group=None, first=0, layout=None):
        if entry["table"] == self.table:
            raise OSError(f"table {entry['table']} does not answer")
        return self.inner.waves(entry, group, first, layout)


@check(
    "load_failures",
    plan_sql(CFG) + """SELECT source, ns, "table", strategy, NULL::BIGINT AS "rows", 'failed' AS status, 2 AS attempts,
    'table ' || "table" || ' does not answer' AS error, (SELECT count(*) - 1 FROM plan p WHERE p.source = plan.source) AS landed
    FROM plan WHERE "table" IN ('orders', 'events')""",
)
def load_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables that failed twice in runs of both sources, as the ledger has them, and how many others landed."""
    found = []
    for src in sources(spark, sf_dir):
        sink = new_sink(spark)
        ledger, bad = RunLedger(spark, sink), "orders" if src.dialect.name == "mysql" else "events"
        try:
            snapshot(Unreachable(src, bad), sink, CFG, host="db", ledger=ledger)
        except LoadFailed as problem:
            run_id = ledger.runs().first()["run_id"]
            landed = ledger.table_results().agg(F.count_if(F.col("status") == "success").alias("landed"))
            failed = ledger.failed_tables(run_id).select("source", "ns", "table", "strategy", "rows", "status", "attempts", "error")
            assert len(problem.results) == plan_source(src, CFG).count()
            found.append(failed.join(F.broadcast(landed)))
    return functools.reduce(DataFrame.unionByName, found)


@check(
    "landed_digest",
    f"""SELECT source, ns, "table", "rows", true AS written_as_read, true AS landed_as_written FROM ({counts_sql()})""",
)
def landed_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For all tables: the digest that the write saw, beside the same sum over the source and over what can be read back."""
    found = []
    for src in sources(spark, sf_dir):
        sink = ParquetSink(spark, shared_dir(spark, "snaplake"), prefix=f"d{uuid.uuid4().hex[:12]}_", digests=True)
        for r in load_all(spark, src, sink, plan_source(src, CFG), CFG):
            seen = F.lit(r.digest).cast("decimal(38,0)")
            sums = []
            for side, rows in (("given", src.scan(r.ns, r.table)), ("landed", sink.read(target_of(src, r.ns, r.table)))):
                sums.append(rows.agg(rows_digest(rows.schema).alias(side), F.count(F.lit(1)).alias(f"{side}_rows")))
            both = sums[0].join(F.broadcast(sums[1]))  # a row each
            found.append(both.select(
                F.lit(r.source).alias("source"), F.lit(r.ns).alias("ns"), F.lit(r.table).alias("table"), F.col("landed_rows").alias("rows"),
                (F.col("given") == seen).alias("written_as_read"), (F.col("landed") == seen).alias("landed_as_written"),
            ))
    return functools.reduce(DataFrame.unionByName, found)


EVEN_BATCH = 500


@check(
    "even_slices",
    f"""SELECT count(*) AS "rows", ceil(count(*) / {EVEN_BATCH})::BIGINT AS slices, true AS within_5_percent FROM events""",
)
def even_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices of a skewed key, many of whose values hold a good part of a slice: how many rows each one's reader gets."""
    given, staged = source(spark, sf_dir, "postgresql"), new_sink(spark)
    target = target_of(given, NS["postgresql"], "events")
    spent = F.floor("value").cast("bigint").alias("spent")
    staged.replace(given.scan(NS["postgresql"], "events").select("*", spent).repartitionByRange(4, "spent"), target)
    key = (NS["postgresql"], "events")
    src = FileSource(spark, POSTGRESQL, {key: FileTable(staged.location(target), ("spent", "event_id"))}, slice_by="even")
    entry = plan_entry(src, "events")
    wanted = -(-entry["rows"] // EVEN_BATCH)
    entry = Row(**entry.asDict() | {"strategy": "range_batches", "batches": wanted})
    pieces = src.pieces(entry)
    tie = tie_of(["event_id"], tie_bits(entry["lo"], entry["hi"]))
    number = slice_of(F.col("spent"), tie, [p["low"] for p in pieces[1:]])
    per_slice = src.scan(*key).groupBy(number.alias("slice_no")).agg(F.count(F.lit(1)).alias("n"))
    even = F.greatest(F.max("n") - F.sum("n") / wanted, F.sum("n") / wanted - F.min("n")) <= 0.05 * F.sum("n") / wanted
    return per_slice.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("slices"), even.alias("within_5_percent"))
