"""Parquet tables of the session catalog, for clusters without Iceberg.

A replace writes a new folder, wave by wave, and then points the table at it, so readers see the old rows or the new ones
and a failed load changes nothing. Which folder is the current one is written down next to the data (``_CURRENT``) before
the catalog is told, and is what counts: a session whose catalog knows another folder, or none, is put right when the table
is read. Old folders stay, as old snapshots would.

The first wave lies in the version's folder itself; every further one and every append has a folder of its own in it, which
scans of the table look into. So one that is repeated, by a driver that doesn't know whether it was done, takes its own
folder's place and no other's.
"""

from __future__ import annotations

import json
import math
import threading
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snaplake.config import DEFAULT_FILE_ROWS, DEFAULT_TARGET_FILE_BYTES
from snaplake.functions.digest import rows_digest
from snaplake.marks import Marks
from snaplake.sinks.base import Target, Written, counted, frames_of, written_of
from snaplake.sql import quote, text

_NESTED = {"recursiveFileLookup": "true"}


@dataclass(frozen=True)
class _Version:
    """What ``_CURRENT`` says: the folder, and what its writes saw, if all of them are known."""

    folder: str
    written: Written | None = None

    @classmethod
    def of(cls, mark: str | None) -> _Version | None:
        if mark is None:
            return None
        if not mark.startswith("{"):  # of tables that an earlier release wrote: the folder alone
            return cls(mark)
        said = json.loads(mark)
        rows, digest = said.get("rows"), said.get("digest")
        return cls(said["version"], None if rows is None else Written(rows, None if digest is None else int(digest)))

    def mark(self) -> str:
        w = self.written
        digest = None if w is None or w.digest is None else str(w.digest)
        return json.dumps({"version": self.folder, "rows": None if w is None else w.rows, "digest": digest})


class ParquetSink:
    def __init__(
        self,
        spark: SparkSession,
        warehouse: str,
        *,
        prefix: str = "",
        target_bytes: int = DEFAULT_TARGET_FILE_BYTES,
        file_rows: int = DEFAULT_FILE_ROWS,
        digests: bool = False,
    ):
        self.spark = spark
        self.warehouse = warehouse.rstrip("/")
        self.prefix = prefix
        self.target_bytes = target_bytes
        self.file_rows = file_rows  # at most, in one file
        self.digests = digests
        self.marks = Marks(spark, self.warehouse)
        self._pointed: dict[Target, str] = {}  # the folder that this session's catalog has
        self._lock = threading.Lock()

    def _database(self, target: Target) -> str:
        """The session catalog has one namespace level, so the levels are joined."""
        return quote(self.prefix + "__".join(target.namespace))

    def name(self, target: Target) -> str:
        return f"{self._database(target)}.{quote(target.table)}"

    # --- writes -----------------------------------------------------------------------------------------

    def stage(self, target: Target, token: str | None = None) -> ParquetStage:
        return ParquetStage(self, target, token or uuid.uuid4().hex)

    def replace(self, df: DataFrame | Iterable[DataFrame], target: Target, token: str | None = None) -> int:
        stage = self.stage(target, token)
        for wave, frame in enumerate(frames_of(df)):
            stage.write(wave, frame)
        stage.publish()
        return stage.written.rows

    def append(self, df: DataFrame, target: Target, token: str | None = None) -> int:
        there = self.read(target).schema  # also puts the catalog right
        version = _Version.of(self.marks.read(self._current(target)))
        rows = df.select(*[F.col(quote(f.name)).cast(f.dataType).alias(f.name) for f in there])
        folder = f"{version.folder}/append-{token or uuid.uuid4().hex}"
        again = token is not None and self._complete(folder)
        seen = self._seen(folder) if again else self.write_folder(rows, folder)
        if not again:
            with self._lock:
                now = _Version.of(self.marks.read(self._current(target)))
                if now.folder == version.folder and now.written is not None:
                    self.marks.replace(self._current(target), _Version(now.folder, now.written + seen).mark())
        self.spark.catalog.refreshTable(self.name(target))
        return seen.rows

    def write_folder(self, df: DataFrame, folder: str) -> Written:
        rows, seen = counted(df, self.digests)
        rows.write.mode("overwrite").option("maxRecordsPerFile", self.file_rows).parquet(folder)
        return written_of(seen, self.digests)

    def _complete(self, folder: str) -> bool:
        return self.marks.exists(f"{folder.removeprefix(self.warehouse)}/_SUCCESS".lstrip("/"))

    def _seen(self, folder: str) -> Written:
        """What the write of a complete folder saw: its rows from the files' footers."""
        rows = self.spark.read.parquet(f"{folder}/*.parquet")
        digest = [rows_digest(rows.schema).alias("digest")] if self.digests else []
        got = rows.agg(F.count(F.lit(1)).alias("rows"), *digest).first()
        return Written(got["rows"], int(got["digest"]) if self.digests else None)

    def publish(self, target: Target, folder: str, schema: T.StructType, written: Written | None) -> None:
        """Say next to the data that ``folder`` is the current version, then tell this session's catalog."""
        self.marks.replace(self._current(target), _Version(folder, written).mark())
        self._point(target, folder, schema)

    @staticmethod
    def _current(target: Target) -> str:
        return f"{target.path}/_CURRENT"

    def current_version(self, target: Target) -> str | None:
        """The folder of the table's current version, as written next to its data; None if there is none."""
        version = _Version.of(self.marks.read(self._current(target)))
        return version and version.folder

    def written(self, target: Target) -> Written | None:
        version = _Version.of(self.marks.read(self._current(target)))
        return version and version.written

    # --- the catalog ------------------------------------------------------------------------------------

    def exists(self, target: Target) -> bool:
        """Whether the table is there; this session's catalog then has its current version."""
        folder = self.current_version(target)
        if folder is None:
            return self.spark.catalog.tableExists(self.name(target))
        if self._pointed.get(target) != folder:
            if self.spark.catalog.tableExists(self.name(target)) and self._located(target).endswith(folder.removeprefix("file:")):
                self._pointed[target] = folder
            else:
                self._point(target, folder, self._scan(folder).schema)
        return True

    def _scan(self, folder: str, spark: SparkSession | None = None, schema: T.StructType | None = None) -> DataFrame:
        reader = (spark or self.spark).read.options(**_NESTED)
        return (reader.schema(schema) if schema else reader).parquet(folder)

    def _point(self, target: Target, folder: str, schema: T.StructType) -> None:
        self.ensure_namespace(target)
        name = self.name(target)
        written = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        if self.spark.catalog.tableExists(name):
            if target in self._pointed and self.spark.table(name).schema == written:
                self.spark.sql(f"ALTER TABLE {name} SET LOCATION {text(folder)}")
                self.spark.catalog.refreshTable(name)
                self._pointed[target] = folder
                return
            self.spark.sql(f"DROP TABLE {name}")  # external: its files stay
        self.spark.catalog.createTable(name, path=folder, source="parquet", schema=written, **_NESTED)
        self._pointed[target] = folder

    def ensure_namespace(self, target: Target) -> None:
        folder = f"{self.warehouse}/{'/'.join(target.namespace)}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self._database(target)} LOCATION {text(folder)}")

    def _located(self, target: Target) -> str:
        detail = self.spark.sql(f"DESCRIBE EXTENDED {self.name(target)}")
        return detail.filter("col_name = 'Location'").first()["data_type"]

    def location(self, target: Target) -> str:
        self.exists(target)
        return self._located(target)

    def read(self, target: Target) -> DataFrame:
        self.exists(target)
        return self.spark.table(self.name(target))

    # --- upkeep -----------------------------------------------------------------------------------------

    def footprint(self, target: Target) -> tuple[int, int, int]:
        """Number of the table's data files, their bytes and those of the largest, as a Spark job over their list."""
        reader = self.spark.read.format("binaryFile").options(pathGlobFilter="*.parquet", **_NESTED)
        files = reader.load(self.location(target))
        row = files.coalesce(1).agg(F.count("length").alias("n"), F.sum("length").alias("size"), F.max("length").alias("largest")).first()
        return row["n"], row["size"] or 0, row["largest"] or 0

    def _at_most(self, folder: str) -> tuple[int, int]:
        """Files and bytes of a folder, marks included, as its file system adds them up: no job, and no list of them."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        summary = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).getContentSummary(path)
        # Each folder has a mark of success.
        return summary.getFileCount() - summary.getDirectoryCount(), summary.getLength()

    def compact(self, target: Target) -> None:
        """Bring files to about the target size, without a shuffle: small ones together, large ones in parts.

        Spark's file scan packs small files, and row groups of large ones, into partitions up to a byte limit; with
        that limit at the target size, each task of the copy writes one file of about it. Files that are as few as
        they can be and none too large stay as they are.
        """
        folder = self.location(target)
        files, size = self._at_most(folder)
        if files <= max(1, math.ceil(size / self.target_bytes)):
            if size <= 2 * self.target_bytes or self.footprint(target)[2] <= 2 * self.target_bytes:
                return
        packing = self.spark.newSession()
        packing.conf.set("spark.sql.files.maxPartitionBytes", str(self.target_bytes))
        # A file costs a thousandth of a partition at least: so empty files don't all fall to one task.
        packing.conf.set("spark.sql.files.openCostInBytes", str(self.target_bytes // 1000))
        packing.conf.set("spark.sql.files.minPartitionNum", "1")
        version, schema = self.stage(target).folder, self.read(target).schema
        written = self.written(target)
        self._scan(folder, packing, schema).write.parquet(version)
        self.publish(target, version, schema, written)

    def refresh_statistics(self, target: Target) -> None:
        """The table's rows, as its writes counted them, become a property of it; bytes follow from its files. Only a
        table whose writes are not known is scanned."""
        self.exists(target)
        version, name = _Version.of(self.marks.read(self._current(target))), self.name(target)
        if version is None or version.written is None:
            self.spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS")
            return
        values = {"snaplake.rows": version.written.rows, "snaplake.rows.of": version.folder}
        self.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({', '.join(f'{text(k)} = {text(str(v))}' for k, v in values.items())})")

    def statistics_rows(self, target: Target) -> int | None:
        """Row count in the table's statistics, if it has any for its current version."""
        rows = {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.name(target)}").collect()}
        if rows.get("snaplake.rows.of") == self.current_version(target):
            return int(rows["snaplake.rows"]) if "snaplake.rows" in rows else None
        detail = self.spark.sql(f"DESCRIBE EXTENDED {self.name(target)}").filter("col_name = 'Statistics'").first()
        words = detail["data_type"].split() if detail else []
        return int(words[words.index("rows") - 1]) if "rows" in words else None


class ParquetStage:
    """A version folder, being written. Its waves are complete where Spark's mark of success says so."""

    def __init__(self, sink: ParquetSink, target: Target, token: str):
        self.sink, self.target, self.token = sink, target, token
        self.folder = f"{sink.warehouse}/{target.path}/{token}"
        self.schema: T.StructType | None = None
        self.written = Written(0, 0 if sink.digests else None)

    @property
    def published(self) -> bool:
        return self.sink.current_version(self.target) == self.folder

    def write(self, wave: int, df: DataFrame) -> Written:
        folder = f"{self.folder}/wave-{wave:06d}" if wave else self.folder
        self.schema = self.schema or df.schema
        seen = self.sink._seen(folder) if self.sink._complete(folder) else self.sink.write_folder(df, folder)
        self.written += seen
        return seen

    def skip(self, written: Written) -> None:
        """Count waves that an earlier driver wrote."""
        self.written += written

    def publish(self) -> None:
        if not self.published:
            schema = self.schema or self.sink._scan(self.folder).schema
            self.sink.publish(self.target, self.folder, schema, self.written)
