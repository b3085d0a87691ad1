"""Slice scan (S1, P1): every column of the rows a run copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablesync.operators.predicates import DEFAULT_YEAR_COLUMN, SliceSpec
from tablesync.session import quote_ident


def resolve_column(df: DataFrame, name: str | None) -> str | None:
    """The frame's own spelling of a column name (names match case-insensitively)."""
    if name is None:
        return None
    for c in df.columns:
        if c.lower() == name.lower():
            return c
    return None


def read_slice(
    source: DataFrame,
    spec: SliceSpec,
    day_column: str,
    year_column: str | None = DEFAULT_YEAR_COLUMN,
) -> DataFrame:
    """``SELECT * FROM source WHERE <slice>``, column order and types kept.

    The year test of a day slice is used only when the source has the year
    column. On a partitioned source both tests become partition filters; on a
    plain Parquet file a day derived as ``CAST(ts AS DATE)`` still becomes a
    pushed ``ts`` range.
    """
    day = resolve_column(source, day_column)
    if day is None:
        raise ValueError(f"source has no day column {day_column!r}; columns: {source.columns}")
    day_type = source.schema[day].dataType
    if not isinstance(day_type, T.DateType):
        # Compared with a DATE, a timestamp matches midnight only: an almost always
        # empty slice would be reported as a clean 0 = 0.
        raise ValueError(f"day column {day!r} must be DATE, not {day_type.simpleString()}; derive it with CAST(<ts> AS DATE)")
    year = resolve_column(source, year_column)
    return source.where(spec.source_filter(day, year))


def source_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    """A catalog source table ``database.table``."""
    return spark.table(quote_ident(f"{database}.{table}"))
