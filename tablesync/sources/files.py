"""Small files beside a table, in whatever store its folder is in (driver only).

Spark reads and writes data; this is for the few bytes that say something about a table:
its schema, a note of what a run is about to do.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


class SmallFiles:
    """Files by path through the file system that Spark itself uses for the path."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        where = self._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self._conf), where

    def exists(self, path: str) -> bool:
        fs, where = self._at(path)
        return fs.exists(where)

    def names(self, folder: str) -> list[str]:
        """Names in a folder, sorted; none if there is no such folder."""
        fs, where = self._at(folder)
        if not fs.exists(where):
            return []
        return sorted(status.getPath().getName() for status in fs.listStatus(where))

    def modified(self, path: str) -> int:
        """Milliseconds since 1970, by the store's clock."""
        fs, where = self._at(path)
        return fs.getFileStatus(where).getModificationTime()

    def write(self, path: str, text: str) -> None:
        """A new file, never an existing one."""
        fs, where = self._at(path)
        out = fs.create(where, False)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def read(self, path: str) -> str:
        fs, where = self._at(path)
        stream = fs.open(where)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, path: str) -> None:
        """A file or a folder with all in it; nothing if there is none."""
        fs, where = self._at(path)
        fs.delete(where, True)

    def qualified(self, path: str) -> str:
        """The path with its scheme, as Spark reports it of files in it."""
        fs, where = self._at(path)
        return fs.makeQualified(where).toString()
