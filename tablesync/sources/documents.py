"""Whole-file JSON documents (S6): one JSON object per file."""

from __future__ import annotations

import os
import re
import sys
from urllib.parse import quote

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.session import disk_path, in_session, small_files_session

# Python workers get the functions themselves, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Control characters inside strings are accepted, like a non-strict JSON parser.
_JSON_OPTIONS = {"allowUnquotedControlChars": "true"}
#: A folder of a partition (``key=value``), less those whose key hides a column of the scan.
_PARTITION = re.compile(r"(?!(?:value|_metadata)=)[^=%]+=.+", re.IGNORECASE | re.DOTALL)
#: Bytes of a file that Spark's reader has to read.
_NOT_PLAIN = -1
#: Bytes that opening a file on a disk counts as: a task of 16 MB holds eight thousand files at most.
_OPEN_COST = 2 << 10
#: Bytes of documents that leave Python at once.
_EMIT_BYTES = 4 << 20


def read_json_documents(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    keep_path: bool = False,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """Each file is read whole and parsed as one JSON document.

    Files are spread over tasks, many small ones to each; each document is parsed on
    an executor, so no file content passes through the driver. A folder on a disk is also
    listed on the executors, so the number of its files does not weigh on the driver. With
    ``mode="PERMISSIVE"`` a file that does not parse gives a row of NULLs; ``mode="FAILFAST"``
    fails the read instead, as a strict parser would.
    """
    rest = ["file_path"] if keep_path else []
    raw = _on_disk(spark, path)
    if raw is None:
        cols = ["value", F.col("_metadata.file_path").alias("file_path")] if keep_path else ["value"]
        raw = in_session(spark, small_files_session(spark).read.text(path, wholetext=True).select(*cols))
    doc = F.from_json(F.col("value"), schema, {**_JSON_OPTIONS, "mode": mode}).alias("doc")
    return raw.select(doc, *rest).select("doc.*", *rest)


def _on_disk(spark: SparkSession, path: str) -> DataFrame | None:
    """value and file_path of the files that Spark's reader finds in a folder on a disk.

    That reader lists all files on the driver and copies Hadoop's configuration for each one.
    None where it has to read them: other stores, single files, patterns, compressed files and
    ones with checksums, trees that are not partitions of one kind, missing files ignored.
    """
    top = disk_path(spark, path)
    lenient = [spark.conf.get(f"spark.sql.files.ignore{k}Files", "false").lower() for k in ("Missing", "Corrupt")]
    if top is None or not os.path.isdir(top) or re.search(r"[\[\]{}*?\\]", path) or "true" in lenient:
        return None
    with os.scandir(top) as entries:
        below = [e.name for e in entries if not _hidden(e.name) and e.is_dir()]
    if not all(map(_PARTITION.fullmatch, below)):
        return None
    spread = spark.sparkContext.defaultParallelism
    folders = [(top, "", False)] + [(f"{top}/{name}", f"{name.partition('=')[0]}/", True) for name in below]
    listed = spark.createDataFrame(folders, "folder string, keys string, deep boolean").repartition(min(len(folders), 4 * spread))
    files = listed.mapInArrow(_files_in(_compressed_suffixes(spark)), "file string, bytes long, keys string")
    found = files.groupBy("keys").agg(F.count_if(F.col("bytes") > 0).alias("n"), F.sum("bytes").alias("bytes"), F.min("bytes").alias("least")).limit(2).collect()
    if len(found) != 1 or found[0].least == _NOT_PLAIN or found[0].n == 0:
        return None
    keys = found[0]["keys"].lower().split("/")
    if len(keys) != len(set(keys)):
        return None
    # As Spark's reader deals files out, but at another cost of opening one.
    weight = found[0].bytes + found[0].n * _OPEN_COST
    task = min(_bytes_conf(spark, "spark.sql.files.maxPartitionBytes"), max(_OPEN_COST, weight // spread))
    files = files.where("bytes > 0").select("file").repartition(min(found[0].n, -(-weight // task)))
    return files.mapInArrow(_whole, "value binary, file_path string").withColumn("value", F.col("value").cast("string"))


def _hidden(name: str) -> bool:
    """Whether Spark's readers pass over a file or folder of this name."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _files_in(compressed: tuple[str, ...]):
    """Lists folders: each file with its bytes and the keys of the folders it is in."""

    def listed(folder, keys, deep):
        with os.scandir(folder) as entries:
            for e in entries:
                if _hidden(e.name):
                    if e.name.endswith(".crc") and not _hidden(e.name[1:-4]):
                        yield e.path, _NOT_PLAIN, keys
                elif e.is_dir():
                    if deep and _PARTITION.fullmatch(e.name):
                        yield from listed(e.path, f"{keys}{e.name.partition('=')[0]}/", True)
                    elif deep:
                        yield e.path, _NOT_PLAIN, keys
                else:
                    try:
                        size = e.stat().st_size
                    except FileNotFoundError:  # a link to nothing, or gone meanwhile
                        continue
                    yield e.path, _NOT_PLAIN if e.name.endswith(compressed) else size, keys

    def run(batches):
        import itertools

        import pyarrow as pa

        for batch in batches:
            files = itertools.chain.from_iterable(itertools.starmap(listed, zip(*batch.to_pydict().values(), strict=True)))
            while part := list(itertools.islice(files, 10_000)):
                path, size, keys = zip(*part, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(path), pa.array(size, pa.int64()), pa.array(keys)], names=["file", "bytes", "keys"])

    return run


def _whole(batches):
    """Each file's content, and its path as Spark's readers write it."""
    import pyarrow as pa

    def uri(file):  # as Java quotes it
        return "file:" + re.sub(r"[\x00-\x7f]+|[\x80-\x9f\s]", lambda m: quote(m[0], safe="/-_.!~'()*,;:$&+=@"), file)

    for batch in batches:
        files = batch.column(0).to_pylist()
        values, start, size = [], 0, 0
        for k, file in enumerate(files):
            with open(file, "rb", buffering=0) as f:
                values.append(f.read())
            size += len(values[-1])
            if size >= _EMIT_BYTES or k + 1 == len(files):
                paths = pa.array(map(uri, files[start : k + 1]), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary()), paths], names=["value", "file_path"])
                values, start, size = [], k + 1, 0


def _compressed_suffixes(spark: SparkSession) -> tuple[str, ...]:
    """Ends of the names of files that Hadoop's readers decompress."""
    jvm, conf = spark.sparkContext._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory.getCodecClasses(conf)
    return tuple(jvm.org.apache.hadoop.util.ReflectionUtils.newInstance(c, conf).getDefaultExtension() for c in codecs)


def _bytes_conf(spark: SparkSession, key: str) -> int:
    return spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
