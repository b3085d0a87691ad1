"""File relay (C5): re-write delimited files as comma CSV files (K5)."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablesync.functions.status import error_text
from tablesync.sources.delimited import PIPE, read_delimited

log = logging.getLogger("tablesync")

RELAY_STATUS = T.StructType(
    [
        T.StructField("file", T.StringType(), False),
        T.StructField("output", T.StringType(), False),
        T.StructField("ok", T.BooleanType(), False),
        T.StructField("error", T.StringType(), True),
    ]
)


def export_csv(
    df: DataFrame,
    path: str,
    header: bool = True,
    sep: str = ",",
    mode: str = "errorifexists",
    keep_blanks: bool = False,
) -> None:
    """K5: write ``df`` as comma CSV with a header into the folder ``path``.

    Re-aimed from the original single part file (``coalesce(1)``, which pushes a
    whole file through one task): every input split is written by its own task,
    as its own part file with its own header line. Part numbers follow the split
    order, so reading the parts in name order gives the rows in input order.
    An existing output fails by default (T12). Spark's writer trims values;
    ``keep_blanks`` writes them as they are.
    """
    writer = df.write.mode(mode).option("header", str(header).lower()).option("sep", sep)
    if keep_blanks:
        writer = writer.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
    writer.csv(path)


def output_path(root: str, file: str) -> str:
    """The relay target of ``file`` under ``root`` with exactly one slash.

    Only the path of ``file`` is used, so ``hdfs://nn/data/a.csv`` and
    ``/data/a.csv`` both land at ``<root>/data/a.csv``.
    """
    path = urlparse(file).path if "://" in file or file.startswith("file:") else file
    return root.rstrip("/") + "/" + path.lstrip("/")


def relay_files(
    spark: SparkSession,
    files: list[str],
    output_root: str,
    sep: str = PIPE,
    infer: bool = True,
    mode: str = "errorifexists",
    parallelism: int = 1,
) -> DataFrame:
    """Relay each file; a failing file is reported and the next one runs.

    Returns one status row per file, in input order (the original only logged
    failures). ``infer=False`` relays every value as the text it is, blanks at its
    ends included. Every file is its own Spark job writing its own folder, so with
    ``parallelism > 1`` several files are relayed at once.
    """

    def relay(file: str) -> tuple:
        target = output_path(output_root, file)
        try:
            export_csv(read_delimited(spark, file, sep=sep, infer=infer), target, mode=mode, keep_blanks=not infer)
            return (file, target, True, None)
        except Exception as exc:
            log.error("relay of %s failed: %s", file, exc)
            return (file, target, False, error_text(exc))

    if parallelism <= 1 or len(files) <= 1:
        status = [relay(f) for f in files]
    else:
        with ThreadPoolExecutor(max_workers=parallelism, thread_name_prefix="tablesync-relay") as pool:
            status = list(pool.map(relay, files))
    return spark.createDataFrame(status, RELAY_STATUS)
