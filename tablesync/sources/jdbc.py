"""Control table over JDBC (S3).

The control lookup itself (filter on the key, newest row first, one row) lives in
``tablesync.plans.notify`` and works on any DataFrame, so the same code runs on a
JDBC source, a catalog table or a Parquet copy. Equality filters are pushed into
the remote query by Spark's JDBC source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablesync.functions.text import fill_template


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    **options: str,
) -> DataFrame:
    """S3: a remote table; filters applied later are pushed to the database."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if user is not None:
        reader = reader.option("user", user)
    if password is not None:
        reader = reader.option("password", password)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load()


def read_jdbc_query(
    spark: SparkSession,
    url: str,
    template: str,
    values: dict[str, str | int],
    user: str | None = None,
    password: str | None = None,
    **options: str,
) -> DataFrame:
    """S3 with a configured SQL template: ``<NAME>`` placeholders are filled as
    quoted literals (F4) and the statement is read as ``(sql) AS tbl``."""
    sql = fill_template(template, values)
    return read_jdbc_table(spark, url, f"({sql}) AS tbl", user, password, **options)
