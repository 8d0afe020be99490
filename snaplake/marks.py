"""Small files that drivers leave for each other: leases, cancel marks, what a table's current version is.

They lie in a folder that every driver reaches, through Hadoop's file systems. A name is created by one driver only: on
a local disk by the system's exclusive create, elsewhere by the file system's create without overwriting, which HDFS
does as one step (an object store does if its connector has conditional writes). A replace writes beside and renames.
"""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Marks:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _files(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def exists(self, name: str) -> bool:
        path = self._path(name)
        return self._files(path).exists(path)

    def names(self, start: str) -> list[str]:
        """Names that begin with ``start``; for the few marks of one kind."""
        path = self._path(start)
        found = self._files(path).globStatus(self._path(f"{start}*")) or []
        return sorted(f"{start.rpartition('/')[0]}/{f.getPath().getName()}".lstrip("/") for f in found)

    def read(self, name: str) -> str | None:
        path = self._path(name)
        files = self._files(path)
        try:
            stream = files.open(path)
        except Py4JJavaError as problem:
            if "FileNotFoundException" in problem.java_exception.getClass().getName():
                return None
            raise
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a mark that is not there yet; False if it is."""
        path = self._path(name)
        files = self._files(path)
        files.mkdirs(path.getParent())
        if files.getUri().getScheme() == "file":
            try:
                # Whole when it shows: a link to a finished file is made by one caller only.
                whole = f"{path.toUri().getPath()}.{uuid.uuid4().hex}"
                with open(whole, "x", encoding="utf-8") as out:
                    out.write(text)
                return _link(whole, path.toUri().getPath())
            except FileExistsError:
                return False
        try:
            self._write(files, path, text, overwrite=False)
        except Py4JJavaError as problem:
            if "AlreadyExists" in problem.java_exception.getClass().getName() or files.exists(path):
                return False
            raise
        return True

    def replace(self, name: str, text: str) -> None:
        """Write a mark or put it in the place of the old one: readers see the one or the other, whole."""
        path = self._path(name)
        files = self._files(path)
        files.mkdirs(path.getParent())
        beside = self._path(f"{name}.{uuid.uuid4().hex}")
        self._write(files, beside, text, overwrite=True)
        jvm = self.spark._jvm
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        full = files.makeQualified(path)
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(full.toUri(), self.spark._jsc.hadoopConfiguration()).rename(files.makeQualified(beside), full, how)

    def take_away(self, name: str) -> bool:
        """Remove a mark; of several that try at once, one gets True."""
        path = self._path(name)
        files = self._files(path)
        aside = self._path(f"{name}.{uuid.uuid4().hex}.gone")
        try:
            if not files.rename(path, aside):
                return False
        except Py4JJavaError as problem:
            if "FileNotFound" in problem.java_exception.getClass().getName():
                return False
            raise
        files.delete(aside, False)
        return True

    @staticmethod
    def _write(files, path, text: str, *, overwrite: bool) -> None:
        out = files.create(path, overwrite)
        try:
            out.write(text.encode("utf-8"))
        finally:
            out.close()


def _link(whole: str, name: str) -> bool:
    try:
        os.link(whole, name)
    except FileExistsError:
        return False
    finally:
        os.unlink(whole)
    return True
