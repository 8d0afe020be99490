"""Profiles and schemas of file tables, kept for as long as the tables' files are the same."""

from __future__ import annotations

import json
import threading
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from snaplake.marks import Marks

_LOCK = threading.Lock()


def folder_state(spark: SparkSession, path: str) -> list | None:
    """What tells a changed table from an unchanged one: path, files, bytes, and when an entry of the folder last changed, as
    the file system adds them up itself. None if it can't say; such a table is profiled each time."""
    try:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        summary, status = files.getContentSummary(folder), files.getFileStatus(folder)
        newest = status.getModificationTime()
        if status.isDirectory() and summary.getDirectoryCount() > 1:
            newest = max([newest, *[s.getModificationTime() for s in files.listStatus(folder) if s.isDirectory()]])
        return [path, summary.getFileCount(), summary.getLength(), newest] if newest else None
    except Py4JJavaError:
        return None


class ProfileCache:
    """A few numbers for each table, in one file that all drivers reach. It is replaced as a whole; of two drivers that
    add to it at once the later one's figures stay, and the other's tables are profiled again."""

    def __init__(self, spark: SparkSession, file: str):
        folder, _, self.name = file.rpartition("/")
        self.marks = Marks(spark, folder)

    def load(self) -> dict[str, dict[str, Any]]:
        said = self.marks.read(self.name)
        return {"profiles": {}, "schemas": {}} | (json.loads(said) if said else {})

    def add(self, kind: str, entries: dict[str, Any]) -> None:
        with _LOCK:
            kept = self.load()
            kept[kind].update(entries)
            self.marks.replace(self.name, json.dumps(kept))
