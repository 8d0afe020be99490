"""Snapshots of relational tables in a lakehouse, as Spark jobs."""

from snaplake.config import LoadConfig, session_conf
from snaplake.functions.filters import to_column, to_sql, validate_filter
from snaplake.jobs import Jobs
from snaplake.operators.ledger import RunConflict, RunLedger, active_runs, latest_runs
from snaplake.operators.load import LoadFailed, Run, load_all, load_filtered, load_table
from snaplake.operators.snapshot import Snapshot, plan_source, snapshot
from snaplake.sinks import IcebergSink, ParquetSink
from snaplake.sinks.base import Target
from snaplake.sources.dialects import MYSQL, POSTGRESQL, dialect_of
from snaplake.sources.files import FileSource, FileTable
from snaplake.sources.jdbc import JdbcSource

__all__ = [
    "FileSource", "FileTable", "IcebergSink", "JdbcSource", "Jobs", "LoadConfig", "LoadFailed", "MYSQL", "POSTGRESQL",
    "ParquetSink", "Run", "RunConflict", "RunLedger", "Snapshot", "Target", "active_runs", "dialect_of",
    "latest_runs", "load_all", "load_filtered", "load_table", "plan_source", "session_conf", "snapshot",
    "to_column", "to_sql", "validate_filter",
]
