"""Configuration-driven jobs on catalog sources (S1 on a partitioned source, S7, C6)."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tablesync.plans import jobs
from tablesync.session import fresh_database, shared_root


@pytest.fixture()
def source_db(spark):
    """A catalog source database: ``events`` partitioned like the original sources."""
    db = fresh_database(spark)
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    ev = ev.withColumns({"CDA_DT": F.col("ts").cast("date"), "cda_year": F.year("ts").cast("int")})
    ev.write.partitionBy("cda_year", "CDA_DT").saveAsTable(f"{db}.events")
    spark.read.parquet(f"{SF001}/orders.parquet").withColumns(
        {"CDA_DT": F.col("o_orderdate").cast("date"), "cda_year": F.year("o_orderdate").cast("int")}
    ).write.saveAsTable(f"{db}.orders")
    return db


def _set(spark, **kv):
    for k, v in kv.items():
        spark.conf.set(jobs.PREFIX + k.replace("_", "."), v)


def test_batch_job_from_conf(spark, source_db):
    target = fresh_database(spark)
    _set(spark, source_database=source_db, tables="ALL", target_database=target, run_date="2024-01-15")
    spark.conf.set(jobs.PREFIX + "day.column", "cda_dt")  # matched case-insensitively
    spark.conf.set(jobs.PREFIX + "report.table", f"{target}.validation_report")
    report = {r.table_name: r for r in jobs.run_batch(spark).collect()}
    assert set(report) == {"events", "orders"}
    assert report["events"].count_result == "Pass" and int(report["events"].source_row_count) > 0
    assert report["orders"].source_row_count == "0"  # no orders on that day
    assert spark.table(f"{target}.validation_report").count() == 2


def test_source_slice_is_partition_pruned(spark, source_db):
    from tablesync import SliceSpec, read_slice

    df = read_slice(spark.table(f"{source_db}.events"), SliceSpec.day("2024-01-15"), "CDA_DT")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cda_year" in plan or "PartitionFilters" in plan
    assert "CDA_DT" in plan.split("PartitionFilters")[1].split("]")[0]


def test_sizes_job_from_conf(spark, source_db):
    _set(spark, sizes_database=source_db, sizes_tables="ALL")
    rows = {r.table_name: r for r in jobs.run_sizes(spark).collect()}
    assert set(rows) == {"events", "orders"}
    assert all(r.bytes > 0 for r in rows.values())


def test_relay_job_from_conf(spark):
    root = shared_root(spark)
    src = f"{root}/landing/{fresh_database(spark)}.csv"
    spark.createDataFrame([("1", "a")], "id string, n string").write.option("header", "true").option("sep", "|").csv(src)
    out = f"{root}/relay/{fresh_database(spark)}"
    _set(spark, relay_files=f" {src} ", relay_output=out)
    status = jobs.run_relay(spark).collect()
    assert [s.ok for s in status] == [True]


def test_main_usage():
    assert jobs.main(["nope"]) == 2


def test_auto_layout_skips_the_shuffle_for_day_partitioned_sources(spark, source_db):
    from tablesync import Replication, resolve_run_mode

    job = Replication(spark, ["events", "orders"], fresh_database(spark), "cda_dt", resolve_run_mode("2024-01-15"), source_database=source_db)
    assert job.source_laid_out_by_day("events") and not job.target("events").rebalance
    assert not job.source_laid_out_by_day("orders") and job.target("orders").rebalance
    forced = Replication(spark, ["events"], "x", "cda_dt", resolve_run_mode("2024-01-15"), source_database=source_db, rebalance=True)
    assert forced.target("events").rebalance


def test_main_batch_exit_codes(spark, source_db):
    target = fresh_database(spark)
    _set(spark, source_database=source_db, tables="events", target_database=target, run_date="2024-01-15")
    spark.conf.set(jobs.PREFIX + "day.column", "CDA_DT")
    spark.conf.set(jobs.PREFIX + "fail.exit", "true")
    try:
        assert jobs.main(["batch"]) == 0
        spark.conf.set(jobs.PREFIX + "tables", "events,missing_table")
        assert jobs.main(["batch"]) == 1
    finally:
        spark.conf.unset(jobs.PREFIX + "fail.exit")


def test_odd_column_names_survive(spark):
    import datetime as dt

    from tablesync import Replication, replicate, resolve_run_mode

    db = fresh_database(spark)
    src = spark.createDataFrame(
        [(1, "x", dt.date(2024, 1, 1), 2024), (2, "y", dt.date(2024, 1, 2), 2024)],
        "`id` long, `a b` string, `CDA_DT` date, `cda_year` int",
    )
    job = Replication(spark, ["odd"], db, "cda_dt", resolve_run_mode("0000-01-01"), load_source=lambda t: src)
    assert replicate(job).first().count_result == "Pass"
    wider = src.withColumn("we`ird", F.lit(1.5))
    job2 = Replication(spark, ["odd"], db, "cda_dt", resolve_run_mode("2024-01-02"), load_source=lambda t: wider)
    assert replicate(job2).first().count_result == "Pass"
    rows = sorted(tuple(r) for r in spark.table(f"{db}.odd").select("id", "`a b`", "`we``ird`").collect())
    assert rows == [(1, "x", None), (2, "y", 1.5)]


def test_notify_settings_build_a_template_reader_and_sink(spark):
    keys = {
        "control.url": "jdbc:unused://host/db",
        "control.query": "select business_ts, delivery_ts from log where source_table = <SOURCE_TABLE>",
        "process.table": "v.process_report",
        "publish.format": "kafka",
        "publish.topic": "process",
        "publish.option.kafka.bootstrap.servers": "broker:9092",
    }
    for k, v in keys.items():
        spark.conf.set(jobs.PREFIX + k, v)
    try:
        notify = jobs.notify_from_conf(spark)  # builds, reads nothing yet
    finally:
        for k in keys:
            spark.conf.unset(jobs.PREFIX + k)
    assert callable(notify.control)
    assert notify.process_table == "v.process_report"
    assert (notify.sink.format, notify.sink.topic) == ("kafka", "process")
    assert notify.sink.options == {"kafka.bootstrap.servers": "broker:9092"}
