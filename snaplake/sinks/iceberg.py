"""Tables of an Iceberg catalog. Needs the catalog's jar and conf (``snaplake.config.session_conf``).

A table that comes in one wave is one commit. Several waves go to a branch of the table, each in a commit of its own that
says which wave of which load it is; then the branch is put in the place of ``main``. Every row is written once. If
another load has changed ``main`` meanwhile, the branch doesn't follow from it and Iceberg refuses: the second of two
loads that clash fails, and its rows stay on its branch.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaplake.config import DEFAULT_TARGET_FILE_BYTES
from snaplake.sinks.base import Target, Written, counted, frames_of, written_of
from snaplake.sql import quote, text

#: Properties of a snapshot that say which wave of which load it is, and what its write saw.
_TOKEN, _WAVE = "snaplake-token", "snaplake-wave"


class IcebergSink:
    def __init__(
        self, spark: SparkSession, catalog: str = "lakehouse", target_bytes: int = DEFAULT_TARGET_FILE_BYTES, digests: bool = False
    ):
        self.spark = spark
        self.catalog = catalog
        self.target_bytes = target_bytes
        self.digests = digests
        self._written: dict[Target, Written] = {}

    def name(self, target: Target) -> str:
        return ".".join(quote(p) for p in (self.catalog, *target.namespace, target.table))

    def _in_catalog(self, target: Target) -> str:
        """The name as procedures of the catalog take it."""
        return text(".".join(quote(p) for p in (*target.namespace, target.table)))

    def ensure_namespace(self, target: Target) -> None:
        for depth in range(1, len(target.namespace) + 1):
            level = ".".join(quote(p) for p in (self.catalog, *target.namespace[:depth]))
            self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {level}")

    def stage(self, target: Target, token: str | None = None) -> IcebergStage:
        self.ensure_namespace(target)
        return IcebergStage(self, target, token or uuid.uuid4().hex)

    def replace(self, df: DataFrame | Iterable[DataFrame], target: Target, token: str | None = None) -> int:
        """One frame is one commit. Several are written to a branch, which then takes the table's place."""
        frames = frames_of(df)
        first = next(frames)
        second = next(frames, None)
        if second is None and token is None:
            self.ensure_namespace(target)
            rows, seen = counted(first, self.digests)
            rows.writeTo(self.name(target)).using("iceberg").createOrReplace()
            self._written[target] = written_of(seen, self.digests)
            return self._written[target].rows
        stage = self.stage(target, token)
        stage.write(0, first)
        for wave, frame in enumerate((f for part in ((second,), frames) for f in part if f is not None), 1):
            stage.write(wave, frame)
        stage.publish()
        return stage.written.rows

    def append(self, df: DataFrame, target: Target, token: str | None = None) -> int:
        if token is not None:
            before = self._committed(target, token, 0)
            if before is not None:
                return before.rows
        rows, seen = counted(df, self.digests)
        writer = rows.writeTo(self.name(target))
        (self._tagged(writer, token, 0) if token is not None else writer).append()
        now = written_of(seen, self.digests)
        if target in self._written:
            self._written[target] += now
        return now.rows

    @staticmethod
    def _tagged(writer, token: str, wave: int):
        return writer.option(f"snapshot-property.{_TOKEN}", token).option(f"snapshot-property.{_WAVE}", str(wave))

    def _committed(self, target: Target, token: str, wave: int) -> Written | None:
        """What the commit of a load's wave added, if there is one: the table's own record of it."""
        found = self.spark.sql(
            f"SELECT CAST(summary['added-records'] AS BIGINT) AS added FROM {self.name(target)}.snapshots"
            f" WHERE summary['{_TOKEN}'] = {text(token)} AND summary['{_WAVE}'] = '{wave}'"
        ).first()
        return None if found is None else Written(found["added"] or 0)

    def written(self, target: Target) -> Written | None:
        """What this sink's own writes of the table saw."""
        return self._written.get(target)

    def compact(self, target: Target) -> None:
        self.spark.sql(
            f"CALL {quote(self.catalog)}.system.rewrite_data_files(table => {self._in_catalog(target)},"
            f" options => map('target-file-size-bytes', '{self.target_bytes}'))"
        )

    def refresh_statistics(self, target: Target) -> None:
        """Iceberg keeps row counts with each commit; what is computed are the columns' sketches."""
        self.spark.sql(f"CALL {quote(self.catalog)}.system.compute_table_stats(table => {self._in_catalog(target)})")

    def exists(self, target: Target) -> bool:
        return self.spark.catalog.tableExists(self.name(target))

    def read(self, target: Target) -> DataFrame:
        return self.spark.table(self.name(target))


class IcebergStage:
    """A branch of the table.

    The first wave takes the place of all rows on the branch, the others are appended. Columns the table hasn't are
    added to it; columns it has and the waves haven't are null in the new rows.
    """

    def __init__(self, sink: IcebergSink, target: Target, token: str):
        self.sink, self.target, self.token = sink, target, token
        self.branch = f"load_{re.sub('[^0-9A-Za-z_]', '_', token)}"
        self.written = Written(0, 0 if sink.digests else None)
        self._there = False

    def _ensure(self, df: DataFrame) -> None:
        """The table and the branch. A branch starts from a commit, so a new table gets an empty one."""
        if self._there:
            return
        name = self.sink.name(self.target)
        if not self.sink.exists(self.target):
            df.limit(0).writeTo(name).using("iceberg").create()
        self.sink.spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('write.spark.accept-any-schema' = 'true')")
        self.sink.spark.sql(f"ALTER TABLE {name} CREATE BRANCH IF NOT EXISTS {quote(self.branch)}")
        self._there = True

    def write(self, wave: int, df: DataFrame) -> Written:
        self._ensure(df)
        seen = self.sink._committed(self.target, self.token, wave)
        if seen is None:
            rows, watch = counted(df, self.sink.digests)
            writer = rows.writeTo(f"{self.sink.name(self.target)}.{quote('branch_' + self.branch)}").option("mergeSchema", "true")
            writer = self.sink._tagged(writer, self.token, wave)
            writer.overwrite(F.lit(True)) if wave == 0 else writer.append()
            seen = written_of(watch, self.sink.digests)
        self.written += seen
        return seen

    def skip(self, written: Written) -> None:
        """Count waves that an earlier driver wrote."""
        self.written += written

    def publish(self) -> None:
        """Put the branch in the place of ``main``, which must not have changed since the branch was made."""
        s, name = self.sink, self.sink.name(self.target)
        s.spark.sql(f"CALL {quote(s.catalog)}.system.fast_forward({s._in_catalog(self.target)}, 'main', {text(self.branch)})")
        s.spark.sql(f"ALTER TABLE {name} DROP BRANCH IF EXISTS {quote(self.branch)}")
        s._written[self.target] = self.written
