"""Session helpers: where scratch and target data may live, identifier quoting."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR_KEY = "spark.checkpoint.dir"
OVERWRITE_MODE_KEY = "spark.sql.sources.partitionOverwriteMode"
OPEN_COST_KEY = "spark.sql.files.openCostInBytes"
ARROW_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Bytes that opening a small file counts as: a task of 16 MB holds a thousand files at most.
SMALL_FILE_COST = 16 << 10


def _context(spark: SparkSession):
    """The SparkContext, or None where there is none (Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    value = spark.conf.get(CHECKPOINT_DIR_KEY, None)
    if value:
        return value
    sc = _context(spark)
    if sc is not None:
        return sc.getConf().get(CHECKPOINT_DIR_KEY, None) or sc.getCheckpointDir()
    return None


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session (tests) without that setting gets a fresh local
    folder of its own; on a cluster a machine-local folder would be wrong, so
    we refuse instead of guessing.
    """
    root = _configured_checkpoint_dir(spark)
    if root:
        return root.rstrip("/")
    sc = _context(spark)
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError(
            f"set {CHECKPOINT_DIR_KEY} to a shared folder (HDFS/object store) before running"
        )
    root = tempfile.mkdtemp(prefix="tablesync-")
    if sc is not None:
        sc.setCheckpointDir(root)
        return sc.getCheckpointDir() or root
    return root


def disk_path(spark: SparkSession, path: str) -> str | None:
    """``path`` in the machines' own file tree, None where it is in another store."""
    sc = _context(spark)
    if sc is None:
        return None
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    uri = fs.makeQualified(at).toUri()
    return uri.getPath() if uri.getScheme() == "file" else None


def fresh_database(spark: SparkSession, prefix: str = "tsync") -> str:
    """Create a uniquely named database located under the shared root."""
    name = f"{prefix}_{uuid.uuid4().hex[:12]}"
    location = f"{shared_root(spark)}/databases/{name}.db"
    spark.sql(f"CREATE DATABASE {quote_ident(name)} LOCATION '{location}'")
    return name


def dynamic_session(spark: SparkSession) -> SparkSession:
    """A session like ``spark`` whose overwrites of partitioned tables are dynamic."""
    return _session_with(spark, OVERWRITE_MODE_KEY, "dynamic")


def small_files_session(spark: SparkSession) -> SparkSession:
    """A session like ``spark`` whose tasks read many small files each.

    A file counts as its bytes and the cost of opening it. Spark's 4 MB for the latter
    makes a task of every few files; with ``SMALL_FILE_COST`` a task's size is bytes.
    """
    cost = spark.conf.get(OPEN_COST_KEY)
    number = re.fullmatch(r"(\d+)b?", cost, re.IGNORECASE)
    if number and int(number[1]) <= SMALL_FILE_COST:
        return spark
    return _session_with(spark, OPEN_COST_KEY, str(SMALL_FILE_COST))


def small_batches_session(spark: SparkSession, rows: int) -> SparkSession:
    """A session like ``spark`` whose rows go to Python at most ``rows`` at a time."""
    now = int(spark.conf.get(ARROW_ROWS_KEY))
    return spark if 0 < now <= rows else _session_with(spark, ARROW_ROWS_KEY, str(rows))


def in_session(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A frame of another session as one of ``spark``; its files stay dealt out as there."""
    if df.sparkSession is spark:
        return df
    name = f"frame_{uuid.uuid4().hex}"
    df.createGlobalTempView(name)
    try:
        return spark.table(f"{spark.conf.get('spark.sql.globalTempDatabase')}.{name}")
    finally:
        spark.catalog.dropGlobalTempView(name)


def _session_with(spark: SparkSession, key: str, value: str) -> SparkSession:
    session = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if spark.conf.isModifiable(k):
            session.conf.set(k, v)
    session.conf.set(key, value)
    return session


def quote_ident(name: str) -> str:
    """Quote a possibly qualified table name (``db.table``) for SQL text."""
    return ".".join(quote_name(part) for part in name.split("."))


def quote_name(name: str) -> str:
    """Quote one name, of a column say, whatever characters it has (dots included)."""
    return "`" + name.replace("`", "``") + "`"


def sql_string(value: str) -> str:
    """A Spark SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
