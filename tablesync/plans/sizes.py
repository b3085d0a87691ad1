"""Size report (C6): bytes and decimal GB per table (S8, F11), and the rollup
(A5 total size, A6 number of tables that report a size)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.functions.units import bytes_to_gb
from tablesync.sources.catalog import catalog_sizes, file_sizes


def size_report(spark: SparkSession, locations: Mapping[str, str]) -> DataFrame:
    """``table_name, bytes, size_gb`` for each table location that holds files."""
    return _report(file_sizes(spark, locations))


def catalog_size_report(spark: SparkSession, database: str, tables: str | list[str]) -> DataFrame:
    """C6 on catalog tables; ``tables`` may be ``"ALL"``."""
    return _report(catalog_sizes(spark, database, tables))


def _report(sizes: DataFrame) -> DataFrame:
    return sizes.select("table_name", "bytes", bytes_to_gb("bytes").alias("size_gb"))


def size_total(report: DataFrame) -> DataFrame:
    """A5 + A6: ``tables, total_gb``; whole bytes are added up, so their order doesn't matter."""
    return report.agg(
        F.count("table_name").alias("tables"),
        bytes_to_gb(F.coalesce(F.sum("bytes"), F.lit(0))).alias("total_gb"),
    )
