from snaplake.sinks.iceberg import IcebergSink
from snaplake.sinks.parquet import ParquetSink

__all__ = ["IcebergSink", "ParquetSink"]
