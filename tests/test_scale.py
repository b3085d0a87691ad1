"""Scale behaviour: a hot day is split over several writers; observed counts stay
exact when tasks fail and run again."""

import os
import subprocess
import sys
import textwrap

from pyspark.sql import functions as F

from conftest import SF01
from tablesync import DayTarget, SliceSpec
from tablesync.session import fresh_database

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_hot_day_is_split_over_several_files(spark):
    """One day holds a third of the rows; AQE's rebalance splits it instead of
    sending it to one task, while small days are packed together."""
    # Eight input tasks, as a large source has many splits (the test file has one
    # row group, so one split); AQE splits a hot partition along map outputs.
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").repartition(8)
    day = F.when(F.col("l_orderkey") % 3 == 0, F.lit("1998-06-15").cast("date")).otherwise(F.col("l_shipdate").cast("date"))
    src = li.withColumns({"cda_dt": day, "cda_year": F.year(day).cast("int")})
    db = fresh_database(spark)
    t = DayTarget(spark, f"{db}.t", "cda_dt")
    # Scaled down: a small target size per write task and enough shuffle
    # partitions that ordinary ones stay below it (AQE packs those together).
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k", "spark.sql.shuffle.partitions": "200"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        res = t.replace(src, SliceSpec.from_date("0001-01-01").replace_predicate("cda_dt"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert res.rows == 60000
    files = spark.table(f"{db}.t").select(F.input_file_name().alias("f"), "cda_dt").distinct()
    per_day = {r["cda_dt"]: r["n"] for r in files.groupBy("cda_dt").agg(F.count("f").alias("n")).collect()}
    hot = per_day.pop(__import__("datetime").date(1998, 6, 15))
    assert hot > 1, "the hot day was written by a single task"
    # Days hashed into the hot day's shuffle partition are split with it; the rest
    # are written whole, packed together.
    assert sum(1 for n in per_day.values() if n > 1) < 0.1 * len(per_day)
    assert spark.table(f"{db}.t").where("cda_dt = DATE'1998-06-15'").count() == src.where("cda_dt = DATE'1998-06-15'").count()


def test_one_day_is_written_by_several_tasks(spark):
    """A day's replace has no key to be hot on: with AQE's skew splitting on and off."""
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").repartition(8)
    src = li.withColumns({"cda_dt": F.lit("1998-06-15").cast("date"), "cda_year": F.lit(1998)})
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k"}
    split = "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled"
    spec = SliceSpec.day("1998-06-15")
    for on in ("true", "false"):
        t = DayTarget(spark, f"{fresh_database(spark)}.t", "cda_dt")
        for k, v in (conf | {split: on}).items():
            spark.conf.set(k, v)
        try:
            t.replace(src, spec.replace_predicate("cda_dt"), spec.date, 1998)
            keyed = DayTarget(spark, f"{fresh_database(spark)}.t", "cda_dt")
            keyed.replace(src, SliceSpec.from_date("1998-01-01").replace_predicate("cda_dt"))
        finally:
            for k in (*conf, split):
                spark.conf.unset(k)
        for target in (t, keyed):
            files = spark.table(target.table).select(F.input_file_name().alias("f")).distinct().count()
            assert files > 1, f"skew splitting {on}: the day was written by a single task"


RETRY_SCRIPT = textwrap.dedent(
    """
    import sys
    sys.path.insert(0, {root!r})
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F, types as T
    from tablesync import DayTarget, SliceSpec
    from tablesync.session import fresh_database

    spark = (SparkSession.builder.master("local[4, 3]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")

    @F.udf(T.LongType())
    def flaky(v):
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
            raise RuntimeError("lost executor")
        return v

    src = (spark.read.parquet({sf!r} + "/events.parquet").repartition(6)
           .withColumns({{"cda_dt": F.col("ts").cast("date"), "cda_year": F.year("ts").cast("int")}})
           .withColumn("event_id", flaky("event_id")))
    expected = spark.read.parquet({sf!r} + "/events.parquet").count()
    for rebalance in (False, True):
        db = fresh_database(spark)
        t = DayTarget(spark, db + ".t", "cda_dt", rebalance=rebalance)
        res = t.replace(src, SliceSpec.from_date("0001-01-01").replace_predicate("cda_dt"))
        got = spark.table(db + ".t").count()
        print("rebalance", rebalance, "observed", res.rows, "written", got, "expected", expected)
        assert res.rows == expected and got == expected
    print("OK")
    """
)


def test_observed_count_survives_task_retries(tmp_path):
    script = tmp_path / "retry.py"
    script.write_text(RETRY_SCRIPT.format(root=ROOT, sf=SF01))
    out = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stdout[-2000:] + out.stderr[-4000:]
    assert "OK" in out.stdout


def test_replace_reads_the_source_once(spark):
    """Rows, partitions and the write come from one evaluation of the source."""
    acc = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(v):
        acc.add(1)
        return v

    ev = spark.read.parquet(f"{SF01}/events.parquet")
    src = ev.withColumns({"cda_dt": F.col("ts").cast("date"), "cda_year": F.year("ts").cast("int"), "event_id": seen("event_id")})
    db = fresh_database(spark)
    t = DayTarget(spark, f"{db}.t", "cda_dt")
    t.create_empty(src.schema)
    res = t.replace(src, SliceSpec.from_date("0001-01-01").replace_predicate("cda_dt"))
    assert res.rows == ev.count()
    assert acc.value == res.rows
