"""Ledger and documents. Run events and log positions are derived from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.catalogs import events, of_type
from checks.registry import check
from checks.tables import CFG, counts_sql, new_sink, sources
from snaplake.operators.ledger import active_runs, latest_runs
from snaplake.operators.load import load_all, results_frame
from snaplake.operators.manifest import replication_documents, snapshot_manifests
from snaplake.operators.snapshot import plan_source


def _run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = {"signup": "pending", "view": "running", "purchase": "success", "error": "failed"}
    return events(spark, sf_dir).select(
        F.format_string("run_%d_%s", "user_id", "day").alias("run_id"),
        "ts",
        of_type(status, "cancelled").alias("status"),
        F.col("source").alias("db_type"),
        F.format_string("db%d", F.col("user_id") % 7).alias("host"),
        F.floor(F.col("value") * 20).cast("bigint").alias("elapsed_s"),
        of_type({"error": F.col("props")}).alias("error"),
        of_type({"click": F.col("ts")}).alias("cancelled_at"),
    )


_RUNS_SQL = """happened AS (SELECT 'run_' || user_id || '_' || strftime(ts, '%d') AS run_id, ts,
  CASE event_type WHEN 'signup' THEN 'pending' WHEN 'view' THEN 'running' WHEN 'purchase' THEN 'success'
    WHEN 'error' THEN 'failed' ELSE 'cancelled' END AS status,
  CASE WHEN user_id % 2 = 0 THEN 'mysql' ELSE 'postgresql' END AS db_type, 'db' || user_id % 7 AS host,
  floor(value * 20)::BIGINT AS s, props, CASE event_type WHEN 'click' THEN ts END AS cancelled_at FROM events),
lasts AS (SELECT run_id, arg_max(status, ts) AS status, arg_max(db_type, ts) AS db_type, arg_max(host, ts) AS host,
  min(ts) AS started_at, arg_max(s, ts) AS s, arg_max(props, ts) AS props, max(cancelled_at) AS cancelled_at
  FROM happened GROUP BY run_id)"""


@check(
    "run_ledger",
    f"""WITH {_RUNS_SQL} SELECT run_id, status, db_type, host, started_at,
    CASE status WHEN 'success' THEN CASE WHEN s >= 3600 THEN (s // 3600) || 'h ' ELSE '' END
      || (s % 3600 // 60) || 'm ' || (s % 60) || 's' END AS elapsed,
    CASE status WHEN 'failed' THEN props END AS error, cancelled_at FROM lasts""",
)
def run_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_runs(_run_events(spark, sf_dir))


@check(
    "run_conflicts",
    f"WITH {_RUNS_SQL} SELECT run_id, db_type, host, status FROM lasts WHERE status IN ('pending', 'running')",
)
def run_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return active_runs(_run_events(spark, sf_dir))


def _positions(spark: SparkSession, sf_dir: str, *by: str) -> DataFrame:
    """Log positions: the last event of each source, or of each source and day."""
    log = events(spark, sf_dir).withColumn("db_type", F.col("source"))
    return log.groupBy("db_type", *by).agg(
        F.max("ts").alias("snapshot_at"),
        F.concat(F.lit("log."), F.max("day")).alias("file"),
        F.max("event_id").alias("position"),
        F.lit("shop").alias("do_db"),
        F.lit("").alias("ignore_db"),
        F.concat(F.lit("0/"), F.max("event_id").cast("string")).alias("gtid_or_lsn"),
    )


def _positions_sql(by: str) -> str:
    return f"""positions AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'mysql' ELSE 'postgresql' END AS db_type,
  max(ts) AS snapshot_at, 'log.' || max(strftime(ts, '%d')) AS file, max(event_id) AS position,
  '0/' || max(event_id) AS lsn FROM events GROUP BY {by})"""


_BINLOG = "'binlog_file': file, 'binlog_position': position, 'binlog_do_db': 'shop', 'binlog_ignore_db': '', 'executed_gtid_set': lsn"
_WAL = "'wal_file': file, 'wal_offset': position, 'wal_lsn': lsn"
_AT = "'snapshot_at': strftime(snapshot_at, '%Y-%m-%dT%H:%M:%S')"


@check(
    "replication_status",
    f"""WITH {_positions_sql("1, strftime(ts, '%d')")}
    SELECT 'snapshot_status/' || db_type || '_' || strftime(snapshot_at, '%Y%m%d_%H%M%S') || '_'
      || CASE db_type WHEN 'postgresql' THEN 'wal' ELSE 'binlog' END || '_status.json' AS object_key,
    CASE db_type WHEN 'postgresql' THEN to_json({{{_AT}, {_WAL}}})::VARCHAR
      ELSE to_json({{{_AT}, {_BINLOG}}})::VARCHAR END AS body FROM positions""",
)
def replication_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replication_documents(_positions(spark, sf_dir, "day"))


_DOC = f"{_AT}, 'db_type': db_type, 'tables': tables"


@check(
    "snapshot_manifest",
    f"""WITH {_positions_sql("1")}, counted AS ({counts_sql()}),
    listed AS (SELECT source AS db_type, list({{'database': ns, 'name': "table", 'row_count': "rows"}} ORDER BY "table")
      AS tables FROM counted GROUP BY source)
    SELECT db_type || '_' || strftime(snapshot_at, '%Y%m%d_%H%M%S') || '.json' AS object_key,
    CASE db_type WHEN 'postgresql' THEN to_json({{{_DOC}, {_WAL}}})::VARCHAR
      ELSE to_json({{{_DOC}, {_BINLOG}}})::VARCHAR END AS body FROM positions JOIN listed USING (db_type)""",
)
def snapshot_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifests with the rows that loads of both sources observed."""
    results = [
        r for src in sources(spark, sf_dir)
        for r in load_all(spark, src, new_sink(spark), plan_source(src, CFG), CFG)
    ]
    return snapshot_manifests(_positions(spark, sf_dir), results_frame(spark, results))
