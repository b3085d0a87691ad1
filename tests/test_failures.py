"""Failure paths: a failed write keeps the old slice (T15), a failed publish adds a
second Fail row (T8), and the message payload bytes (F10)."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF001
from tablesync import DayTarget, FixedClock, MessageSink, Notify, Replication, SliceSpec, replicate_and_notify, resolve_run_mode
from tablesync.functions.message import status_messages, utf8_payload
from tablesync.session import fresh_database

D = dt.date
SCHEMA = "id long, v string, cda_year int, cda_dt date"


def test_failed_replace_keeps_old_slice(spark):
    db = fresh_database(spark)
    t = DayTarget(spark, f"{db}.t", "cda_dt")
    t.append(spark.createDataFrame([(1, "old", 2024, D(2024, 1, 2)), (2, "old", 2024, D(2024, 1, 3))], SCHEMA))
    new = spark.createDataFrame([(3, "new", 2024, D(2024, 1, 2)), (4, "boom", 2024, D(2024, 1, 3))], SCHEMA)
    failing = new.withColumn("v", F.when(F.col("v") == "boom", F.raise_error(F.lit("source broke"))).otherwise(F.col("v")))
    try:
        t.replace(failing, SliceSpec.from_date("2024-01-02").replace_predicate("cda_dt"))
        raised = False
    except Exception as exc:  # the job fails as a whole
        raised = "source broke" in str(exc)
    assert raised
    assert sorted(tuple(r) for r in spark.table(f"{db}.t").select("id", "v").collect()) == [(1, "old"), (2, "old")]


def test_publish_failure_adds_second_fail_row(spark):
    db = fresh_database(spark)
    ev = spark.read.parquet(f"{SF001}/events.parquet").withColumns(
        {"cda_dt": F.col("ts").cast("date"), "cda_year": F.year("ts").cast("int")}
    )
    control = spark.createDataFrame(
        [("events", "src", 20240115, dt.datetime(2024, 1, 15, 8, 0, 0), None)],
        "source_table string, target_db string, cda_date int, business_ts timestamp_ntz, delivery_ts timestamp_ntz",
    )
    job = Replication(
        spark, ["events"], db, "cda_dt", resolve_run_mode("2024-01-15"), load_source=lambda t: ev,
        database_name="src", clock=FixedClock(dt.datetime(2024, 2, 1)), report_table=f"{db}.validation_report",
    )
    # No Kafka package on this classpath: the publish fails after the report row was written.
    report = replicate_and_notify(job, Notify(control, sink=MessageSink("kafka", topic="process"))).collect()
    assert [r.count_result for r in report] == ["Pass", "Fail"]
    assert report[1].log_details
    assert report[1].destination_row_count == report[0].destination_row_count
    assert spark.table(f"{db}.validation_report").count() == 2


def test_utf8_payload(spark):
    df = spark.createDataFrame([("Zürich",)], "note string")
    msg = status_messages(df, "db", "t", "Pass")
    text, payload = msg.select("value", utf8_payload("value").alias("p")).first()
    assert bytes(payload) == text.encode("utf-8")


def test_orc_target(spark):
    db = fresh_database(spark)
    t = DayTarget(spark, f"{db}.t", "cda_dt", format="orc")
    t.append(spark.createDataFrame([(1, "a", 2024, D(2024, 1, 1))], SCHEMA))
    t.append(spark.createDataFrame([(2, 2024, D(2024, 1, 2), 5)], "id long, cda_year int, cda_dt date, extra int"))
    t.replace(spark.createDataFrame([(3, "c", 2024, D(2024, 1, 1))], SCHEMA), SliceSpec.day("2024-01-01").replace_predicate("cda_dt"))
    rows = sorted(tuple(r) for r in spark.table(f"{db}.t").select("id", "v", "extra").collect())
    assert rows == [(2, None, 5), (3, "c", None)]
    assert "orc" in spark.sql(f"DESCRIBE TABLE EXTENDED {db}.t").where("col_name = 'Provider'").first()[1]
