"""What a replace has still to do, noted beside its target.

A replace overwrites the days of its slice and then drops the days that the slice lacks.
Before the overwrite it notes which partitions the target has in the replaced range, and
after the commit that it committed. If the run stops before the drop, the next run on the
target, whatever its slice, finds the note and drops them.

Which of the noted partitions the overwrite filled is seen from their files: new ones are
younger than the note. Both times come from the store of the table.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.session import quote_name
from tablesync.sources.files import SmallFiles

log = logging.getLogger("tablesync")

#: Folder beside the data; Spark passes over names that begin like this.
FOLDER = "_tablesync"
#: So many partitions are kept in the note itself; more are a table beside it.
INLINE = 200


def to_lines(rows: DataFrame, most: int) -> list[str] | None:
    """The rows as JSON texts, or None if there are more than ``most``."""
    texts = rows.select(F.to_json(F.struct(*[F.col(quote_name(c)) for c in rows.columns]), {"ignoreNullFields": "false"}))
    found = [r[0] for r in texts.take(most + 1)]
    return found if len(found) <= most else None


def from_lines(spark: SparkSession, lines: list[str], schema: T.StructType) -> DataFrame:
    texts = spark.createDataFrame([(x,) for x in lines], "line string")
    return texts.select(F.from_json("line", schema).alias("r")).select("r.*")


@dataclass(frozen=True)
class Note:
    """Partitions that a replace found in its range, and the time it noted them (ms)."""

    name: str
    since: int
    partitions: DataFrame


class Notes:
    def __init__(self, spark: SparkSession, location: str):
        self.spark = spark
        self.files = SmallFiles(spark)
        self.folder = f"{location.rstrip('/')}/{FOLDER}"

    def _path(self, name: str, kind: str) -> str:
        return f"{self.folder}/{name}.{kind}"

    def _table(self, rows: DataFrame, name: str, kind: str) -> DataFrame:
        """Rows as a table of the note's; few ones are kept on the driver instead."""
        lines = to_lines(rows, INLINE)
        if lines is not None:
            return from_lines(self.spark, lines, rows.schema)
        path = self._path(name, kind)
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def open(self, partitions: DataFrame) -> Note | None:
        """A note of these partitions, or None if there are none."""
        lines = to_lines(partitions, INLINE)
        if lines == []:
            return None
        name = uuid.uuid4().hex
        if lines is None:
            partitions.write.parquet(self._path(name, "partitions"))
        said = {"schema": partitions.schema.json(), "partitions": lines}
        path = self._path(name, "json")
        self.files.write(path, json.dumps(said))
        if self.files.modified(path) % 1000 == 0:
            # Perhaps a store that counts whole seconds: leave the second in which older files may have been written.
            self.files.delete(path)
            time.sleep(1.0)
            self.files.write(path, json.dumps(said))
        return self._read(name)

    def _read(self, name: str) -> Note:
        path = self._path(name, "json")
        said = json.loads(self.files.read(path))
        schema = T.StructType.fromJson(json.loads(said["schema"]))
        if said["partitions"] is None:
            rows = self.spark.read.schema(schema).parquet(self._path(name, "partitions"))
        else:
            rows = from_lines(self.spark, said["partitions"], schema)
        return Note(name, self.files.modified(path), rows)

    def commit(self, note: Note) -> None:
        self.files.write(self._path(note.name, "committed"), "")

    def committed(self) -> Iterator[Note]:
        """Notes of replaces that committed and did not finish."""
        names = self.files.names(self.folder)
        for name in sorted({n.rsplit(".", 1)[0] for n in names if n.endswith(".json")}):
            if f"{name}.committed" in names:
                yield self._read(name)
            else:
                log.warning("%s: a replace stopped before its commit was noted; the next one that writes rows makes up for it", self.folder)

    def stale(self, note: Note, filled: DataFrame, columns: list[str]) -> DataFrame:
        """The noted partitions without a partner among ``filled``, apart from the tables they come from."""
        same = None
        for c in columns:
            equal = F.col(f"n.{quote_name(c)}").eqNullSafe(F.col(f"f.{quote_name(c)}"))
            same = equal if same is None else same & equal
        rows = note.partitions.alias("n").join(filled.alias("f"), same, "left_anti")
        return self._table(rows, note.name, f"stale-{uuid.uuid4().hex}")

    def close(self, note: Note) -> None:
        """Forget a note; its file goes last but for the mark, so a stop in between is a stop before."""
        for name in self.files.names(self.folder):
            if name.startswith(f"{note.name}.") and not name.endswith((".json", ".committed")):
                self.files.delete(f"{self.folder}/{name}")
        self.files.delete(self._path(note.name, "json"))
        self.files.delete(self._path(note.name, "committed"))

    def forget_uncommitted(self) -> None:
        """Drop notes of replaces that never committed, after a replace that did."""
        names = self.files.names(self.folder)
        for name in {n.rsplit(".", 1)[0] for n in names if n.endswith(".json")}:
            if f"{name}.committed" not in names:
                self.close(Note(name, 0, self.spark.range(0)))
