"""Documents a snapshot leaves behind: what was loaded, and the source's log position it started from.

A position frame has ``db_type, snapshot_at, file, position, do_db, ignore_db, gtid_or_lsn``: the position is
an input, taken by whoever holds the source's lock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.functions.expressions import file_stamp, iso_seconds

# Names of the position fields in the documents of each source.
WAL_FIELDS = {"wal_file": "file", "wal_offset": "position", "wal_lsn": "gtid_or_lsn"}
BINLOG_FIELDS = {
    "binlog_file": "file",
    "binlog_position": "position",
    "binlog_do_db": "do_db",
    "binlog_ignore_db": "ignore_db",
    "executed_gtid_set": "gtid_or_lsn",
}
KEEP_NULLS = {"ignoreNullFields": "false"}


def _document(*head: Column) -> Column:
    """JSON text of the leading fields and the position, named as the source type has it."""
    is_wal = F.col("db_type") == "postgresql"
    wal, binlog = (
        F.to_json(F.struct(*head, *[F.col(c).alias(name) for name, c in fields.items()]), KEEP_NULLS)
        for fields in (WAL_FIELDS, BINLOG_FIELDS)
    )
    return F.when(is_wal, wal).otherwise(binlog)


def replication_documents(positions: DataFrame) -> DataFrame:
    """``object_key`` and ``body`` of the position document of each snapshot."""
    kind = F.when(F.col("db_type") == "postgresql", "wal").otherwise("binlog")
    key = F.format_string("snapshot_status/%s_%s_%s_status.json", F.col("db_type"), file_stamp(F.col("snapshot_at")), kind)
    return positions.select(key.alias("object_key"), _document(iso_seconds(F.col("snapshot_at")).alias("snapshot_at")).alias("body"))


def snapshot_manifests(positions: DataFrame, results: DataFrame) -> DataFrame:
    """``object_key`` and ``body`` of each snapshot's manifest, with the rows every table was loaded with.

    A manifest lists its tables, so a group is as long as the list of tables the run planned.
    """
    entry = F.struct(F.col("ns").alias("database"), F.col("table").alias("name"), F.col("rows").alias("row_count"))
    tables = results.groupBy(F.col("source").alias("db_type")).agg(F.sort_array(F.collect_list(entry)).alias("tables"))
    head = [iso_seconds(F.col("snapshot_at")).alias("snapshot_at"), F.col("db_type"), F.col("tables")]
    key = F.format_string("%s_%s.json", F.col("db_type"), file_stamp(F.col("snapshot_at")))
    return positions.join(tables, "db_type").select(key.alias("object_key"), _document(*head).alias("body"))


def save_document(spark: SparkSession, folder: str, object_key: str, body: str) -> str:
    """Write one small document under ``folder``, on any filesystem Spark can reach."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{object_key}")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True)
    try:
        stream.write(bytearray(body.encode("utf-8")))
    finally:
        stream.close()
    return path.toString()
