"""Validation report (K6) and process report (K7) rows."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.runtime import runtime_text
from tablesync.operators.target import DayTarget, WriteResult

# The validation report's columns, in order, all non-null, with the
# counts kept as text. It is partitioned by load_date (the job's start date).
REPORT_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("source_row_count", T.StringType(), False),
        T.StructField("destination_row_count", T.StringType(), False),
        T.StructField("count_result", T.StringType(), False),
        T.StructField("database_name", T.StringType(), False),
        T.StructField("load_date", T.DateType(), False),
        T.StructField("job_start_time", T.TimestampType(), False),
        T.StructField("job_end_time", T.TimestampType(), False),
        T.StructField("total_runtime", T.StringType(), False),
        T.StructField("log_details", T.StringType(), False),
    ]
)
REPORT_PARTITION = "load_date"
# The columns the notify job adds to a control row for its report.
PROCESS_COLUMNS = ("source_system", "table_name", "count_result", "cda_date")
PROCESS_PARTITION = "cda_date"


@dataclass(frozen=True)
class ReportRow:
    """One table's outcome as the driver knows it."""

    table_name: str
    source_row_count: str
    destination_row_count: str
    count_result: str
    database_name: str
    load_date: dt.date
    job_start_time: dt.datetime
    job_end_time: dt.datetime
    log_details: str


def report_frame(spark: SparkSession, rows: list[ReportRow]) -> DataFrame:
    """K6 rows with the fixed schema; ``total_runtime`` is F5 of the two times.

    ``rows`` holds one small entry per table of the job, never data rows.
    """
    fields = [f for f in REPORT_SCHEMA.fields if f.name != "total_runtime"]
    base = spark.createDataFrame(
        [tuple(getattr(r, f.name) for f in fields) for r in rows], T.StructType(fields)
    ).coalesce(1)  # rows that the driver made: one small file per append
    cols = [
        runtime_text("job_start_time", "job_end_time").alias(f.name) if f.name == "total_runtime" else F.col(f.name)
        for f in REPORT_SCHEMA.fields
    ]
    return base.select(*cols)


def append_report(spark: SparkSession, report: DataFrame, table: str) -> WriteResult:
    """K6: append report rows to a table partitioned by ``load_date``, without a shuffle."""
    return DayTarget(spark, table, REPORT_PARTITION, year_column=None, rebalance=False).append(report)


def _value(v: Column | str | dt.date | dt.datetime) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def process_rows(
    control: DataFrame,
    source_system: Column | str,
    table_name: Column | str,
    count_result: Column | str,
    run_date: Column | str | dt.date,
) -> DataFrame:
    """K7 rows: the control row(s) plus the run values (P6) and the run date.

    A control column of the same name is replaced in place, as ``withColumn`` does.
    """
    return control.withColumns(
        {
            "source_system": _value(source_system).cast("string"),
            "table_name": _value(table_name).cast("string"),
            "count_result": _value(count_result).cast("string"),
            "cda_date": F.to_date(_value(run_date)),
        }
    )


def append_process_report(spark: SparkSession, rows: DataFrame, table: str) -> WriteResult:
    """K7: append process rows to a table partitioned by ``cda_date``, without a shuffle."""
    return DayTarget(spark, table, PROCESS_PARTITION, year_column=None, rebalance=False).append(rows)
