"""Day-partitioned targets addressed by a path, without a catalog.

The data lie in the usual ``column=value`` folders. The schema lies beside them, in
``_schema/000001.json`` and so on: a wider slice adds a version, never changes one, so an
empty target has a schema, files that lack later columns are read with them as NULL, and
two runs that widen at the same time cannot both win. A path that somebody else filled is
taken over with the schema that merging its files' schemas gives.

Writes, replaces, notes and counts are those of :class:`DayTarget`; only where partitions
are listed and dropped differs: from the files' paths, and by deleting folders.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.predicates import DEFAULT_YEAR_COLUMN
from tablesync.operators.target import DEFAULT_PARTITION_NAME, DayTarget, _find
from tablesync.session import quote_name
from tablesync.sources.catalog import TableInfo
from tablesync.sources.files import SmallFiles

SCHEMA_FOLDER = "_schema"
#: Column of a listed partition besides its values: its folder below the target's path.
_FOLDER = "tablesync folder"


class PathTarget(DayTarget):
    """A target at ``path``; the rest is as for :class:`DayTarget`.

    ``require_filter`` is kept with the schema, so it holds for every later target there.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        day_column: str,
        year_column: str | None = DEFAULT_YEAR_COLUMN,
        format: str = "parquet",
        rebalance: bool = True,
        require_filter: bool = True,
    ):
        super().__init__(spark, path.rstrip("/"), day_column, year_column, format, rebalance, require_filter)
        self.files = SmallFiles(spark)
        self._kept: tuple[str, dict] | None = None  # (newest version's name, what it says)

    # ------------------------------------------------------------------ the schema beside the data
    def _said(self) -> dict | None:
        """What the newest schema version says, read again only if there is a newer one."""
        folder = f"{self.table}/{SCHEMA_FOLDER}"
        versions = [n for n in self.files.names(folder) if n.endswith(".json")]
        if not versions:
            return None
        if self._kept is None or self._kept[0] != versions[-1]:
            self._kept = (versions[-1], json.loads(self.files.read(f"{folder}/{versions[-1]}")))
        return self._kept[1]

    def _say(self, schema: T.StructType, partitions: list[str], require_filter: bool) -> None:
        """A new schema version; fails if another run wrote one in the meantime."""
        number = int(self._kept[0].split(".")[0]) + 1 if self._said() else 1
        said = {
            "schema": json.loads(T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields]).json()),
            "partitions": partitions,
            "require_filter": require_filter,
        }
        self.files.write(f"{self.table}/{SCHEMA_FOLDER}/{number:06d}.json", json.dumps(said))

    def _has_data(self) -> bool:
        return any(not n.startswith(("_", ".")) for n in self.files.names(self.table))

    def exists(self) -> bool:
        """The path has a schema, or data that somebody else put there."""
        return self._said() is not None or self._has_data()

    def schema(self) -> T.StructType:
        said = self._said()
        if said is not None:
            return T.StructType.fromJson(said["schema"])
        return self.spark.read.format(self.format).option("mergeSchema", "true").load(self.table).schema

    def _describe(self) -> TableInfo:
        raise NotImplementedError("a path has no catalog entry")

    def partition_columns(self) -> list[str]:
        said = self._said()
        return list(said["partitions"]) if said else self._partition_columns_for(self.schema())

    def location(self) -> str:
        return self.table

    def filter_required(self) -> bool:
        said = self._said()
        return bool(said and said["require_filter"])

    def create_empty(self, schema: T.StructType) -> bool:
        """K4: a target with this schema and no rows, unless there is one."""
        if self._said() is not None:
            return False
        if self._has_data():  # take it over as it is
            schema = self.schema()
            self._say(schema, self._partition_columns_for(schema), False)
            return False
        pcols = self._partition_columns_for(schema)
        fields = [f for f in schema.fields if f.name not in pcols] + [schema[c] for c in pcols]
        self._say(T.StructType(fields), pcols, self.require_filter)
        return True

    def _evolve(self, schema: T.StructType) -> None:
        """K1 field addition: a schema version with the slice's new columns before the partition columns."""
        new, pcols = self._new_fields(schema), self.partition_columns()
        have = self.schema()
        if bad := [f.name for f in new if f.name.lower() in {c.lower() for c in self._partition_columns_for(schema)}]:
            raise ValueError(f"target {self.table} is not partitioned by {bad}")
        old = [f for f in have.fields if f.name not in pcols]
        self._say(T.StructType(old + new + [have[c] for c in pcols]), pcols, self.filter_required())

    # ------------------------------------------------------------------ rows and partitions
    def _insert(self, df: DataFrame, obs: Observation, metrics: list[Column], pcols: list[str], overwrite: bool, year: int | None) -> None:
        writer = df.observe(obs, *metrics).write.format(self.format).partitionBy(*pcols)
        if overwrite:
            writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(self.table)
        else:
            writer.mode("append").save(self.table)

    def _frame(self) -> DataFrame:
        return self.spark.read.format(self.format).schema(self.schema()).load(self.table)

    def _partition_frame(self, day: str | None = None) -> DataFrame:
        """The partitions as typed columns, from a listing of the files' paths; contents are not read.

        ``day`` narrows the listing only where the day is the outermost folder.
        """
        schema, pcols = self.schema(), self.partition_columns()
        root = self.files.qualified(self.table)
        listing = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        names = self.files.names(self.table)
        if day is not None and pcols[0] == _find(pcols, self.day_column):
            names = [n for n in names if n == f"{pcols[0]}={day}"]
        folders = [f"{self.table}/{n}" for n in names if "=" in n]
        if not folders:
            values = T.StructType([T.StructField(c, schema[c].dataType) for c in pcols])
            return self.spark.createDataFrame([], values.add(_FOLDER, "string"))
        # Folder names are escaped as Spark escapes them; url_decode gets %20 for the plus signs, which are plain.
        below = F.substring(F.col("path"), len(root) + 2, 1 << 30)
        found = listing.load(folders).select(below.alias("below"))
        folder = F.substring_index("below", "/", len(pcols))
        found = found.select(folder.alias(_FOLDER)).distinct()
        pieces = F.split(F.col(quote_name(_FOLDER)), "/")
        cols = []
        for k, c in enumerate(pcols):
            raw = F.regexp_extract(F.get(pieces, F.lit(k)), "=(.*)$", 1)
            text = F.url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))
            value = F.when(raw == F.lit(DEFAULT_PARTITION_NAME), F.lit(None)).otherwise(text)
            cols.append(value.cast(schema[c].dataType).alias(c))
        return found.select(*cols, quote_name(_FOLDER))

    def _drop(self, partitions: Iterable[Row]) -> None:
        for row in partitions:
            self.files.delete(f"{self.table}/{row[_FOLDER]}")

    def _check_dropped(self, stale: DataFrame, pcols: list[str]) -> None:
        left = stale.select(quote_name(_FOLDER)).intersect(self._partition_frame().select(quote_name(_FOLDER)))
        if still := left.take(5):
            raise RuntimeError(f"partitions of {self.table} could not be dropped: {[r[0] for r in still]}")
