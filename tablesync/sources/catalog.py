"""Catalog scans: table list (S7), table sizes (S8), existence."""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesync.functions.text import split_list
from tablesync.session import quote_ident

log = logging.getLogger("tablesync")

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:(//[^/]*)?"

# Fixed value: this table list means every table of the database.
ALL_TABLES = "ALL"

#: Partition folders whose files are listed at once.
FOLDERS_PER_LISTING = 1000


def list_tables(spark: SparkSession, database: str, tables: str | list[str]) -> list[str]:
    """The configured names, or every table of ``database`` for ``ALL``."""
    names = split_list(tables) if isinstance(tables, str) else list(tables)
    if names and names[0] == ALL_TABLES:
        return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)
    return names


def table_exists(spark: SparkSession, name: str) -> bool:
    """S9."""
    return spark.catalog.tableExists(name)


class TableInfo(NamedTuple):
    """What a catalog says of a table."""

    partition_columns: list[str]
    storage: str  # storage properties, as text
    properties: str  # table properties, as text
    location: str


def describe_table(spark: SparkSession, name: str) -> TableInfo:
    """Partition columns, properties and location of a catalog table, from one
    ``DESCRIBE TABLE EXTENDED`` (cheaper than listing columns via the catalog API)."""
    pcols: list[str] = []
    said = {"Storage Properties": "", "Table Properties": "", "Location": ""}
    section = ""
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quote_ident(name)}").collect():
        col = (r["col_name"] or "").strip()
        if col.startswith("#"):
            section = col if col != "# col_name" else section
        elif not col:
            section = ""
        elif section == "# Partition Information":
            pcols.append(col)
        elif col in said and section == "# Detailed Table Information":
            said[col] = r["data_type"] or ""
    return TableInfo(pcols, said["Storage Properties"], said["Table Properties"], said["Location"])


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    """The partition columns of a catalog table."""
    return describe_table(spark, name).partition_columns


def _bare(path: str) -> str:
    """A path without scheme and authority, without a trailing slash."""
    return re.sub(_SCHEME, "", path).rstrip("/") or "/"


def _listing(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """One ``binaryFile`` listing over all paths (Spark lists many roots in a
    distributed job); paths without a folder are left out."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        return reader.load(paths)
    except AnalysisException:
        kept = []
        for path in paths:
            try:
                reader.load(path)
                kept.append(path)
            except AnalysisException as exc:  # no folder yet: the table has no size
                log.info("no files at %s: %s", path, exc)
        return reader.load(kept) if kept else None


def file_sizes(spark: SparkSession, locations: Mapping[str, str]) -> DataFrame:
    """Bytes on disk per table, ``table_name string, bytes long``.

    All locations (files or directory trees) are listed in one ``binaryFile``
    scan with only ``path`` and ``length`` selected, so file contents are never
    read; hidden and ``_``-prefixed files are skipped like any Spark scan skips
    them. Each file belongs to the deepest location that contains it (found by
    joining the file's ancestor paths with the locations), so nested table
    folders are not counted twice. A location without files yields no row
    (such a table is skipped, as tables without a size are).
    """
    empty = spark.createDataFrame([], "table_name string, bytes long")
    if not locations:
        return empty
    listing = _listing(spark, list(dict.fromkeys(locations.values())))
    if listing is None:
        return empty
    files = listing.select(F.regexp_replace("path", _SCHEME, "").alias("file"), "length")
    parts = F.split("file", "/")
    ancestors = F.transform(F.sequence(F.lit(2), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    candidates = files.select("file", "length", F.explode(ancestors).alias("location"))
    bare = {name: _bare(path) for name, path in locations.items()}
    owners = spark.createDataFrame(list(bare.items()), "table_name string, location string")
    # One row per table, so its size is bounded by the table list: broadcast it
    # (never the listing, which grows with the number of files).
    owned = candidates.join(F.broadcast(owners), "location")
    if _nested(set(bare.values())):
        # A file under nested folders matches several tables; the deepest owns it.
        depth = F.length("location")
        deepest = F.max(depth).over(Window.partitionBy("file"))  # a handful of rows per file
        owned = owned.withColumn("deepest", deepest).where(depth == F.col("deepest"))
    return owned.groupBy("table_name").agg(F.sum("length").cast("long").alias("bytes"))


def _nested(locations: set[str]) -> bool:
    """Whether one location lies inside another (decided on the table list)."""
    ordered = sorted(loc.rstrip("/") + "/" for loc in locations)
    return any(b.startswith(a) for a, b in zip(ordered, ordered[1:]))


def _bytes_under(spark: SparkSession, folders: list[str]) -> int:
    """Bytes of the files under these folders, of which some may be missing."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders)
        return files.agg(F.sum("length")).first()[0] or 0
    except AnalysisException as exc:
        if len(folders) == 1:  # no folder: the partition has no size
            log.info("no files at %s: %s", folders[0], exc)
            return 0
    half = len(folders) // 2
    return _bytes_under(spark, folders[:half]) + _bytes_under(spark, folders[half:])


def partitioned_size(spark: SparkSession, table: str, location: str) -> int:
    """S8 for one partitioned table: bytes of the partitions that the catalog has, in their folders
    below ``location``.

    The files of ``FOLDERS_PER_LISTING`` folders are listed and added up at a time (in a
    distributed job), so the driver holds the partitions' names and one batch's files, never
    those of the whole table. A partition kept elsewhere does not count, as none of its
    files lie below ``location``.
    """
    total, batch = 0, []
    for row in spark.sql(f"SHOW PARTITIONS {quote_ident(table)}").toLocalIterator():
        batch.append(f"{location.rstrip('/')}/{row['partition']}")
        if len(batch) == FOLDERS_PER_LISTING:
            total += _bytes_under(spark, batch)
            batch = []
    return total + (_bytes_under(spark, batch) if batch else 0)


def catalog_sizes(spark: SparkSession, database: str, tables: str | list[str]) -> DataFrame:
    """S7 + S8 on catalog tables: ``table_name string, bytes long``, a row per table with a size.

    One ``SHOW TABLE EXTENDED`` call reads every table's location and, where the catalog
    has it, its size; only the files of tables without a recorded size are listed, those of a
    partitioned table by batches of its partitions' folders, unless the folders of tables
    nest. Names match as the catalog matches them, in any case; an unknown one is an error.
    The result of that call has one entry per table (metadata).
    """
    info = spark.sql(f"SHOW TABLE EXTENDED IN {quote_ident(database)} LIKE '*'").where(~F.col("isTemporary"))
    found = info.select(
        "tableName",
        F.regexp_extract("information", r"(?m)^Location: (.*)$", 1).alias("location"),
        F.regexp_extract("information", r"(?m)^Statistics: ([0-9]+) bytes", 1).alias("bytes"),
        F.col("information").rlike(r"(?m)^Partition Provider: Catalog$").alias("partitioned"),
    )
    known = {r["tableName"].lower(): r for r in found.collect()}
    names = list(dict.fromkeys(t.lower() for t in list_tables(spark, database, tables)))
    unknown = [t for t in names if t not in known]
    if unknown:
        raise ValueError(f"no table {', '.join(unknown)} in {database}")
    chosen = [known[t] for t in names]
    recorded = [(r["tableName"], int(r["bytes"])) for r in chosen if r["bytes"]]
    listed = {r["tableName"]: r["location"] for r in chosen if not r["bytes"] and r["location"]}
    if not _nested({_bare(r["location"]) for r in known.values() if r["location"]}):
        for r in chosen:
            if r["partitioned"] and r["tableName"] in listed:
                found_bytes = partitioned_size(spark, f"{database}.{r['tableName']}", listed.pop(r["tableName"]))
                recorded += [(r["tableName"], found_bytes)] if found_bytes else []
    sizes = spark.createDataFrame(recorded, "table_name string, bytes long")
    return sizes.unionByName(file_sizes(spark, listed)) if listed else sizes
