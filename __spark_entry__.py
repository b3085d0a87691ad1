"""

Every query reads the given tables whole. Stand-in sources add the day column
``cda_dt = CAST(<ts> AS DATE)`` and ``cda_year = year(<ts>)`` to a test table.
Queries that need a target create it in a fresh database under the session's
shared folder, run the real job or operator, and read the result back.

whole tables (not one year), ``json_documents`` covers every customer (not
``c_custkey < 100``), ``slice_history`` returns the sliced rows rather than a count
per year, ``target_count_missing`` is the second row of ``target_count``, the size
queries list the test tables through the catalog (``ALL``), and the control table
is a DataFrame derived from ``orders`` rather than an embedded database (none may
be started here).
"""

from __future__ import annotations

import datetime as dt
import importlib
import os
import shutil
import sys
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# This file may be loaded by path from another working directory: make the
# package next to it importable.
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from tablesync import (  # noqa: E402
    DayTarget,
    FixedClock,
    MessageSink,
    Notify,
    PathTarget,
    Replication,
    SliceSpec,
    UnfilteredRead,
    read_slice,
    relay_files,
    replicate,
    replicate_and_notify,
    resolve_run_mode,
    catalog_size_report,
    size_total,
    survivors,
)
from tablesync.functions.dates import date_key  # noqa: E402
from tablesync.functions.message import status_messages, utf8_payload  # noqa: E402
from tablesync.functions.runtime import runtime_text  # noqa: E402
from tablesync.functions.text import split_list_col  # noqa: E402
from tablesync.operators.report import REPORT_SCHEMA, append_process_report, process_rows  # noqa: E402
from tablesync.plans.notify import lookup_all  # noqa: E402
from tablesync.session import disk_path, fresh_database, shared_root  # noqa: E402
from tablesync.sources.documents import read_json_documents  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
DAY = "cda_dt"
YEAR = "cda_year"
CLOCK = FixedClock(dt.datetime(2024, 2, 1, 10, 0, 0))
DB_NAME = "tpch"

# Day columns of the stand-ins (see FIXTURES.md).
_TS = {"lineitem": "l_shipdate", "orders": "o_orderdate", "events": "ts"}

# Oracle building blocks (DuckDB).
_SRC = "(SELECT *, CAST(l_shipdate AS DATE) AS cda_dt, CAST(year(l_shipdate) AS INTEGER) AS cda_year FROM lineitem)"
_EV_NULLS = (
    "(SELECT *, CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS cda_dt, "
    "CAST(year(ts) AS INTEGER) AS cda_year FROM events)"
)
_CONTROL = (
    "(SELECT o_orderpriority AS source_table, o_orderstatus AS target_db, "
    "CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS cda_date, "
    "o_orderdate + to_seconds(o_custkey) AS business_ts, "
    "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate + to_seconds(o_orderkey) END AS delivery_ts "
    "FROM orders)"
)


# --------------------------------------------------------------------------- helpers
def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _standin(spark: SparkSession, sf_dir: str, table: str, null_every: tuple[str, int] | None = None) -> DataFrame:
    """A test table as a replication source: ``cda_dt`` and ``cda_year`` added."""
    ts = F.col(_TS[table])
    day = ts.cast("date")
    if null_every:
        key, every = null_every
        day = F.when(F.col(key) % every == 0, F.lit(None).cast("date")).otherwise(day)
    return _read(spark, sf_dir, table).withColumns({DAY: day, YEAR: F.year(ts).cast("int")})


def _job(spark: SparkSession, db: str, tables: list[str], run_date: str, load: Callable[[str], DataFrame], **kw) -> Replication:
    return Replication(
        spark,
        tables,
        db,
        DAY,
        resolve_run_mode(run_date),
        load_source=load,
        database_name=DB_NAME,
        clock=CLOCK,
        **kw,
    )


def _by_day(df: DataFrame, value: str | None = None) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n")]
    if value:
        aggs.append(F.sum(value).alias("q"))
    return df.groupBy(DAY).agg(*aggs)


def _preload(spark: SparkSession, db: str, name: str, rows: DataFrame) -> DayTarget:
    """Fill a target directly (fixture rows, NULL days included) with K1."""
    target = DayTarget(spark, f"{db}.{name}", DAY, YEAR)
    target.append(rows)
    return target


def _counts(report: DataFrame) -> DataFrame:
    return report.select("table_name", "source_row_count", "destination_row_count", "count_result")


# --------------------------------------------------------------------------- slices
def q_slice_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _standin(spark, sf_dir, "lineitem")
    return read_slice(src, SliceSpec.day("1998-06-15"), DAY, YEAR).select("l_orderkey", "l_linenumber", "l_quantity", DAY)


def q_slice_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _standin(spark, sf_dir, "lineitem")
    return read_slice(src, SliceSpec.from_date("2001-06-01"), DAY, YEAR).select("l_orderkey", "l_linenumber", "l_quantity", DAY)


def q_slice_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _standin(spark, sf_dir, "lineitem", null_every=("l_orderkey", 7))
    return read_slice(src, SliceSpec.history(), DAY, YEAR).select("l_orderkey", "l_linenumber", YEAR, DAY)


def q_delete_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = _standin(spark, sf_dir, "events", null_every=("event_id", 7))
    pred = SliceSpec.from_date("2024-01-20").replace_predicate(DAY)
    return src.where(survivors(pred)).select("event_id", DAY)


# --------------------------------------------------------------------------- replace / append
def _replace_day(spark: SparkSession, sf_dir: str, runs: int) -> DataFrame:
    db = fresh_database(spark)
    src = _standin(spark, sf_dir, "lineitem")
    _preload(spark, db, "lineitem", src.withColumn("l_quantity", F.lit(-1.0)))
    job = _job(spark, db, ["lineitem"], "1998-06-15", lambda t: src)
    for _ in range(runs):
        replicate(job, raise_on_fail=True)
    return _by_day(spark.table(f"{db}.lineitem"), "l_quantity")


def q_replace_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replace_day(spark, sf_dir, 1)


def q_replace_day_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replace_day(spark, sf_dir, 2)


def q_replace_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = fresh_database(spark)
    src = _standin(spark, sf_dir, "lineitem")
    stale = src.where(F.col(DAY) == F.lit("2001-06-01").cast("date")).withColumns(
        {DAY: F.lit("2099-01-01").cast("date"), YEAR: F.lit(2099)}
    )
    _preload(spark, db, "lineitem", src.unionByName(stale).withColumn("l_quantity", F.lit(-1.0)))
    replicate_and_notify(_job(spark, db, ["lineitem"], "2001-06-01", lambda t: src), raise_on_fail=True)
    return _by_day(spark.table(f"{db}.lineitem"), "l_quantity")


def q_replace_from_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = fresh_database(spark)
    src = _standin(spark, sf_dir, "events", null_every=("event_id", 7))
    _preload(spark, db, "events", src.withColumn("value", F.lit(-1.0)))
    replicate_and_notify(_job(spark, db, ["events"], "2024-01-20", lambda t: src), raise_on_fail=True)
    return spark.table(f"{db}.events").select("event_id", DAY, "value")


def q_replace_day_null_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day that the target also holds under a NULL year, replaced twice."""
    db = fresh_database(spark)
    src = _standin(spark, sf_dir, "lineitem")
    year = F.when(F.col("l_orderkey") % 3 == 0, F.lit(None)).otherwise(F.col(YEAR))
    target = _preload(spark, db, "lineitem", src.withColumns({"l_quantity": F.lit(-1.0), YEAR: year}))
    spec = SliceSpec.day("1998-06-15")
    rows = read_slice(src, spec, DAY, YEAR)
    dropped = [len(target.replace(rows, spec.replace_predicate(DAY), spec.date, 1998).dropped) for _ in range(2)]
    found = spark.table(f"{db}.lineitem").groupBy(YEAR, DAY).agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
    return found.withColumns({"first_dropped": F.lit(dropped[0]), "second_dropped": F.lit(dropped[1])})


def q_replace_from_extra_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table made elsewhere, partitioned by day and a text that is NULL or needs escaping."""
    db = fresh_database(spark)
    src = _standin(spark, sf_dir, "events").drop(YEAR)
    texts = F.array(F.lit("A:B"), F.lit(None).cast("string"), F.lit("x %+y"), F.lit("plain"))
    old = src.withColumns({"value": F.lit(-1.0), "region": texts[(F.col("event_id") % 4).cast("int")]})
    old.write.partitionBy(DAY, "region").saveAsTable(f"{db}.events")
    target = DayTarget(spark, f"{db}.events", DAY, year_column=None)
    spec = SliceSpec.from_date("2024-01-20")
    rows = src.withColumn("region", F.lit("plain")).where(F.col(DAY) >= F.lit(spec.date).cast("date"))
    dropped = [len(target.replace(rows, spec.replace_predicate(DAY)).dropped) for _ in range(2)]
    found = spark.table(f"{db}.events").groupBy(DAY, "region").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))
    return found.withColumns({"first_dropped": F.lit(dropped[0]), "second_dropped": F.lit(dropped[1])})


def q_append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = fresh_database(spark)
    src = _standin(spark, sf_dir, "events")
    job = _job(spark, db, ["events"], "0000-01-01", lambda t: src)
    first = replicate(job).first()
    second = replicate(job).first()
    return _by_day(spark.table(f"{db}.events")).withColumns(
        {"first_result": F.lit(first["count_result"]), "second_result": F.lit(second["count_result"])}
    )


def q_append_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = fresh_database(spark)
    src = _standin(spark, sf_dir, "lineitem")
    replicate(_job(spark, db, ["lineitem"], "0000-01-01", lambda t: src.drop("l_tax")), raise_on_fail=True)
    replicate_and_notify(_job(spark, db, ["lineitem"], "1998-06-15", lambda t: src), raise_on_fail=True)
    return spark.table(f"{db}.lineitem").select("l_orderkey", "l_linenumber", DAY, "l_tax")


def q_append_path_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target is a path: its schema lies beside it and widens without a catalog."""
    path = f"{shared_root(spark)}/targets/{fresh_database(spark)}"
    src = _standin(spark, sf_dir, "events")
    load = lambda t: src.drop("props")
    replicate(_job(spark, "", ["events"], "0000-01-01", load, target_path=path), raise_on_fail=True)
    replicate_and_notify(_job(spark, "", ["events"], "2024-01-15", lambda t: src, target_path=path), raise_on_fail=True)
    target = PathTarget(spark, f"{path}/events", DAY, YEAR)
    return target.read(SliceSpec.history().target_filter(DAY, YEAR)).select("event_id", DAY, "props")


def q_replace_from_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An open slice into a path, whose stale day is dropped; the target was created empty first."""
    path = f"{shared_root(spark)}/targets/{fresh_database(spark)}"
    src = _standin(spark, sf_dir, "events", null_every=("event_id", 7))
    run = lambda date, rows: replicate_and_notify(_job(spark, "", ["events"], date, lambda t: rows, target_path=path), raise_on_fail=True)
    run("2099-01-01", src)
    target = PathTarget(spark, f"{path}/events", DAY, YEAR)
    empty = target.count(SliceSpec.history().target_filter(DAY, YEAR))
    stale = src.where(F.col(DAY) == F.lit("2024-01-20").cast("date")).withColumns({DAY: F.lit("2098-01-01").cast("date"), YEAR: F.lit(2098)})
    target.append(src.unionByName(stale).withColumn("value", F.lit(-1.0)))
    run("2024-01-20", src)
    whole = target.read(F.col(YEAR) > 0)  # the NULL days, too
    return whole.select("event_id", DAY, "value").withColumn("empty_count", F.lit(empty))


def q_replace_stopped_then_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replace that stops between its commit and the drop of stale days; the next run has an empty slice."""

    class Stops(DayTarget):
        def _drop(self, partitions):
            raise InterruptedError

    db = fresh_database(spark)
    src = _standin(spark, sf_dir, "events")
    spec = SliceSpec.from_date("2024-01-10")
    _preload(spark, db, "events", src.withColumn("value", F.lit(-1.0)))
    sliced = read_slice(src, spec, DAY, YEAR).where(F.dayofmonth(DAY) % 2 == 1)
    try:
        Stops(spark, f"{db}.events", DAY, YEAR).replace(sliced, spec.replace_predicate(DAY))
    except InterruptedError:
        pass
    replicate_and_notify(_job(spark, db, ["events"], "2099-01-01", lambda t: src), raise_on_fail=True)
    return spark.table(f"{db}.events").select("event_id", DAY, "value")


def q_target_filter_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads of a target that requires a partition filter: refused, or counted."""
    db = fresh_database(spark)
    src = _standin(spark, sf_dir, "events")
    _preload(spark, db, "events", src)
    target = DayTarget(spark, f"{db}.events", DAY, YEAR)
    day = F.col(DAY) == F.lit("2024-01-15").cast("date")
    asked = {
        "all": F.lit(True),
        "data column": F.col("event_id") % 2 == 0,
        "any day": F.col(DAY).isNotNull(),
        "day or data": day | (F.col("event_id") % 2 == 0),
        "day": day,
        "day and data": day & (F.col("event_id") % 2 == 0),
        "year": F.col(YEAR) == 2024,
        "from": SliceSpec.from_date("2024-01-20").target_filter(DAY, YEAR),
        "nothing": F.lit(False),
    }

    def answer(predicate: Column) -> str:
        try:
            return target.count(predicate)
        except UnfilteredRead:
            return "refused"

    return spark.createDataFrame([(name, answer(p)) for name, p in asked.items()], "asked string, answer string")


def q_recount_together(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many tables, one missing and one loaded before, re-counted in one job."""
    db = fresh_database(spark)
    loads = {f"{t}_{k}": _standin(spark, sf_dir, t) for t in ("events", "orders") for k in range(3)}
    loads["part"] = _read(spark, sf_dir, "part").withColumns({DAY: F.lit(None).cast("date"), YEAR: F.lit(None).cast("int")})
    for name, rows in loads.items():
        if name.startswith("orders"):
            loads[name] = rows.where(F.year(DAY) == 1997)
    _preload(spark, db, "events_1", loads["events_1"])
    tables = [*loads, "no_such_table"]
    return _counts(replicate(_job(spark, db, tables, "0000-01-01", loads.__getitem__, parallelism=4, recount="together")))


def q_append_dotted_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = fresh_database(spark)
    src = _standin(spark, sf_dir, "events").withColumn("user.id", F.col("user_id"))
    later = src.withColumn("ty`p.e", F.struct(F.col("event_type").alias("a.b")))
    replicate(_job(spark, db, ["events"], "0000-01-01", lambda t: src), raise_on_fail=True)
    replicate_and_notify(_job(spark, db, ["events"], "2024-01-20", lambda t: later), raise_on_fail=True)
    return spark.table(f"{db}.events").select(
        "event_id", F.col("`user.id`").alias("user_id"), F.col("`ty``p.e`")["a.b"].alias("event_type")
    )


def q_nested_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = fresh_database(spark)
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("label"))
    src = _read(spark, sf_dir, "embeddings").withColumns({DAY: day, YEAR: F.year(day).cast("int")})
    replicate(_job(spark, db, ["embeddings"], "0000-01-01", lambda t: src), raise_on_fail=True)
    exploded = spark.table(f"{db}.embeddings").select("vec_id", F.posexplode("embedding"))
    return exploded.select("vec_id", (F.col("pos") + 1).alias("pos"), F.col("col").cast("double").alias("val"))


def q_empty_slice_keeps_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = fresh_database(spark)
    src = _standin(spark, sf_dir, "events")
    replicate(_job(spark, db, ["events"], "0000-01-01", lambda t: src), raise_on_fail=True)
    wider = src.withColumn("extra", F.lit(1))
    run = replicate(_job(spark, db, ["events"], "1990-01-01", lambda t: wider)).first()
    return _by_day(spark.table(f"{db}.events")).withColumns(
        {
            "columns": F.lit(",".join(spark.table(f"{db}.events").columns)),
            "source_row_count": F.lit(run["source_row_count"]),
            "destination_row_count": F.lit(run["destination_row_count"]),
            "count_result": F.lit(run["count_result"]),
        }
    )


def q_created_target_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = fresh_database(spark)
    src = _standin(spark, sf_dir, "events")
    replicate_and_notify(_job(spark, db, ["events"], "2099-01-01", lambda t: src), raise_on_fail=True)
    table = f"{db}.events"
    cols = spark.catalog.listColumns(table)
    listing = spark.createDataFrame(
        [(i + 1, c.name, c.isPartition) for i, c in enumerate(cols)], "position int, column_name string, is_partition boolean"
    )
    rows = src.agg(F.count(F.lit(1)).alias("source_rows"))
    return listing.withColumn("row_count", F.lit(spark.table(table).count()).cast("long")).crossJoin(rows)


# --------------------------------------------------------------------------- target reads
def q_target_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = fresh_database(spark)
    src = _standin(spark, sf_dir, "events")
    replicate(_job(spark, db, ["events"], "0000-01-01", lambda t: src), raise_on_fail=True)
    day = SliceSpec.day("2024-01-15").target_filter(DAY, YEAR)
    found = DayTarget(spark, f"{db}.events", DAY, YEAR).count_frame(day).select(F.lit("events").alias("table_name"), "size")
    missing = DayTarget(spark, f"{db}.missing", DAY, YEAR).count_frame(day).select(F.lit("missing").alias("table_name"), "size")
    return found.unionByName(missing)


def q_target_reread(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = fresh_database(spark)
    src = _standin(spark, sf_dir, "events")
    replicate(_job(spark, db, ["events"], "0000-01-01", lambda t: src), raise_on_fail=True)
    target = DayTarget(spark, f"{db}.events", DAY, YEAR)
    return target.read(SliceSpec.from_date("2024-01-20").target_filter(DAY, YEAR)).select("event_id", DAY)


# --------------------------------------------------------------------------- jobs and reports
def _reconcile_setup(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, DataFrame]]:
    """Sources for a history job over three tables; ``events`` was loaded before."""
    db = fresh_database(spark)
    loads = {
        "events": _standin(spark, sf_dir, "events"),
        "orders": _standin(spark, sf_dir, "orders"),
        "part": _read(spark, sf_dir, "part").withColumns({DAY: F.lit(None).cast("date"), YEAR: F.lit(None).cast("int")}),
    }
    _preload(spark, db, "events", loads["events"])  # an earlier history load
    return db, loads


def _reconcile_run(spark: SparkSession, db: str, loads: dict[str, DataFrame]) -> DataFrame:
    job = _job(spark, db, ["events", "orders", "part"], "0000-01-01", loads.__getitem__, report_table=f"{db}.validation_report")
    return replicate(job)


def q_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(_reconcile_run(spark, *_reconcile_setup(spark, sf_dir)))


def q_validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = fresh_database(spark)
    loads = {t: _standin(spark, sf_dir, t) for t in ("lineitem", "orders")}
    report_table = f"{db}.validation_report"
    replicate(_job(spark, db, ["lineitem", "orders"], "1998-06-15", loads.__getitem__, report_table=report_table))
    replicate(_job(spark, db, ["events"], "2024-01-15", lambda t: _standin(spark, sf_dir, t), report_table=report_table))
    return spark.table(report_table).select(*REPORT_SCHEMA.fieldNames())


def q_error_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = fresh_database(spark)
    report = replicate(_job(spark, db, ["events", "no_such_table"], "2024-01-15", lambda t: _standin(spark, sf_dir, t) if t in _TS else _read(spark, sf_dir, t)))
    return report.withColumn("has_details", F.length("log_details") > 0).select(
        "table_name", "source_row_count", "destination_row_count", "count_result", "has_details"
    )


def q_runtime_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _read(spark, sf_dir, "events")
    secs = (F.col("event_id") % 7200).cast("decimal(18,6)") + F.lit(0.75).cast("decimal(18,6)")
    end = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)
    return ev.select("event_id", runtime_text(F.col("ts"), end).alias("total_runtime"))


def q_date_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "orders").select("o_orderkey", date_key("o_orderdate").alias("cda_date"))


# --------------------------------------------------------------------------- notify
def _control(spark: SparkSession, sf_dir: str, table_col: Column | None = None, db_col: Column | None = None) -> DataFrame:
    """A control table derived from ``orders`` (one row per order)."""
    o = _read(spark, sf_dir, "orders")
    return o.select(
        (table_col if table_col is not None else F.col("o_orderpriority")).alias("source_table"),
        (db_col if db_col is not None else F.col("o_orderstatus")).alias("target_db"),
        date_key("o_orderdate").alias("cda_date"),
        F.timestamp_add("SECOND", F.col("o_custkey"), F.col("o_orderdate")).alias("business_ts"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None))
        .otherwise(F.timestamp_add("SECOND", F.col("o_orderkey"), F.col("o_orderdate")))
        .alias("delivery_ts"),
    )


def q_control_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup_all(_control(spark, sf_dir))


def q_process_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = fresh_database(spark)
    best = lookup_all(_control(spark, sf_dir))
    run_date = F.to_date(F.col("cda_date").cast("string"), "yyyyMMdd")
    rows = process_rows(best, F.col("target_db"), F.col("source_table"), "Pass", run_date).select(
        "business_ts", "delivery_ts", "source_system", "table_name", "count_result", "cda_date"
    )
    append_process_report(spark, rows, f"{db}.process_report")
    return spark.table(f"{db}.process_report")


def q_status_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _read(spark, sf_dir, "events")
    slashes = F.repeat(F.lit("\\"), (F.col("event_id") % 70).cast("int"))
    props = F.concat("props", slashes, F.lit("\u00fc\U0001f600"))
    control = ev.select(
        F.col("ts").alias("business_ts"), F.lit(None).cast("timestamp_ntz").alias("delivery_ts"), props.alias("props"), "event_type"
    )
    fields = ["business_ts", "delivery_ts", "props"]
    messages = status_messages(control, "db", F.col("event_type"), "Pass", fields)
    path = f"{shared_root(spark)}/messages/{fresh_database(spark)}"
    MessageSink("text", path).publish(messages)
    return spark.read.text(path).select(F.col("value").alias("message"))


def q_notify_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    db = fresh_database(spark)
    control = _control(spark, sf_dir, F.lit("lineitem"), F.lit(DB_NAME))
    path = f"{shared_root(spark)}/messages/{db}"
    notify = Notify(control, process_table=f"{db}.process_report", sink=MessageSink("text", path))
    loads = {t: _standin(spark, sf_dir, t) for t in ("lineitem", "events")}
    report = replicate_and_notify(_job(spark, db, ["lineitem", "events"], "2001-06-01", loads.__getitem__), notify)
    messages = spark.read.schema("value string").text(path)
    keyed = messages.select(F.get_json_object("value", "$.table_name").alias("table_name"), F.col("value").alias("message"))
    return report.select("table_name", "count_result").join(keyed, "table_name", "left")


def q_control_rows_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reader that finds many control rows: all are reported, the last one is published."""
    db = fresh_database(spark)
    control = _control(spark, sf_dir)
    path = f"{shared_root(spark)}/messages/{db}"

    def reader(table: str, database: str, key: int) -> DataFrame:
        wanted = F.col("cda_date") >= key if table == "lineitem" else F.lit(False)
        return control.where(wanted).select("business_ts", "delivery_ts")

    notify = Notify(reader, process_table=f"{db}.process_report", sink=MessageSink("text", path))
    loads = {t: _standin(spark, sf_dir, t) for t in ("lineitem", "events")}
    replicate_and_notify(_job(spark, db, ["lineitem", "events"], "2001-06-01", loads.__getitem__), notify)
    rows = spark.table(f"{db}.process_report").select("business_ts", "delivery_ts", "table_name", "count_result", "cda_date")
    messages = spark.read.schema("value string").text(path).select(F.col("value").alias("message"))
    return rows.withColumn("message", F.lit(None).cast("string")).unionByName(messages, allowMissingColumns=True)


def q_utf8_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").select("doc_id", F.hex(utf8_payload("text")).alias("payload"))


def q_split_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "documents").select("doc_id", F.array_join(split_list_col("text"), "|").alias("items"))


# --------------------------------------------------------------------------- files
def _pipe_fixture(spark: SparkSession, sf_dir: str, blanks: bool) -> str:
    path = f"{shared_root(spark)}/landing/{fresh_database(spark)}/customer.csv"
    c = _read(spark, sf_dir, "customer")
    name, seg = F.col("c_name"), F.col("c_mktsegment")
    if blanks:
        name, seg = F.concat(F.lit("  "), name), F.concat(seg, F.lit(" \t"))
    rows = c.select(
        F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("code"), name.alias("name"), F.col("c_acctbal").alias("bal"), seg.alias("seg")
    )
    writer = rows.write.option("header", "true").option("sep", "|")
    writer.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)
    return path


def _relay(spark: SparkSession, sf_dir: str, infer: bool) -> DataFrame:
    src = _pipe_fixture(spark, sf_dir, blanks=not infer)
    out = f"{shared_root(spark)}/relay/{fresh_database(spark)}"
    status = relay_files(spark, [src], out, infer=infer).first()
    if not status["ok"]:
        raise RuntimeError(status["error"])
    return spark.read.option("header", "true").option("inferSchema", str(infer).lower()).csv(status["output"])


def q_csv_relay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _relay(spark, sf_dir, infer=True)


def q_csv_relay_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _relay(spark, sf_dir, infer=False)


#: Files in a folder of documents, and folders that a task writes where there are tasks enough.
_FOLDER_DOCUMENTS, _TASK_FOLDERS = 1000, 10


def q_json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_root(spark)}/documents/{fresh_database(spark)}"
    c = _read(spark, sf_dir, "customer")
    doc = F.to_json(F.struct("c_custkey", "c_name", "c_acctbal")).alias("value")
    folders = max(1, -(-c.count() // _FOLDER_DOCUMENTS))
    docs = c.select(doc)
    if disk := disk_path(spark, path):
        tasks = max(4 * spark.sparkContext.defaultParallelism, -(-folders // _TASK_FOLDERS))
        _write_on_disk(docs.repartition(min(folders, tasks)), disk, _FOLDER_DOCUMENTS)
    else:
        # A folder for each task: the commit moves folders, and they are listed side by side.
        docs = docs.repartition(folders).withColumn("folder", F.spark_partition_id())
        docs.write.partitionBy("folder").option("maxRecordsPerFile", 1).text(path)
    return read_json_documents(spark, path, "c_custkey long, c_name string, c_acctbal double")


def _write_on_disk(docs: DataFrame, path: str, folder_documents: int) -> None:
    """A file for each value, as the text writer makes them, in folders of so many.

    For a file on a disk Hadoop starts a process that sets its mode, which takes far longer than
    writing it. Each try of a task has folders of its own; those of the tries that count are moved.
    """
    tries = f"{path}/_temporary"

    def write(batches):
        import uuid

        import pyarrow as pa

        folders, n = [], 0
        for batch in batches:
            for value in batch.column(0).to_pylist():
                if n % folder_documents == 0:
                    folders.append(f"{tries}/{uuid.uuid4().hex}")
                    os.mkdir(folders[-1])
                with open(f"{folders[-1]}/part-{n:05}.txt", "xb") as f:
                    f.write(value + b"\n")
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array(folders, pa.string())], names=["folder"])

    os.makedirs(tries)
    try:
        written = docs.select(F.col("value").cast("binary")).mapInArrow(write, "folder string").collect()
        for k, (folder,) in enumerate(written):
            os.rename(folder, f"{path}/folder={k}")
    finally:
        shutil.rmtree(tries, ignore_errors=True)


#: A text column of each given table; as lines of a text table its size is known.
_LINES = {
    "region": "r_name", "nation": "n_name", "customer": "c_name", "supplier": "s_name", "part": "p_name", "orders": "o_orderpriority",
    "lineitem": "l_returnflag", "events": "props", "documents": "text", "embeddings": "label", "pages": "html", "benchmark": "text",
    "labels": "doc_id", "conversations": "text",
}


def _line_tables(spark: SparkSession, sf_dir: str) -> str:
    """Text tables of the given ones, whole; the catalog has the size of every second one."""
    db = fresh_database(spark)
    for k, (t, column) in enumerate(_LINES.items()):
        _read(spark, sf_dir, t).select(F.col(column).cast("string").alias("value")).write.format("text").saveAsTable(f"{db}.{t}")
        if k % 2:
            spark.sql(f"ANALYZE TABLE {db}.{t} COMPUTE STATISTICS NOSCAN")
    return db


def q_table_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog_size_report(spark, _line_tables(spark, sf_dir), "ALL")


def q_table_sizes_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ", ".join(t.upper() if k % 3 else t for k, t in enumerate(_LINES))
    return size_total(catalog_size_report(spark, _line_tables(spark, sf_dir), names))


# --------------------------------------------------------------------------- contract
def entry(spark: SparkSession) -> DataFrame:
    """Flagship: replicate one day of ``events`` and return its validation report."""
    db = fresh_database(spark)
    src = _standin(spark, SMOKE_DIR, "events")
    report_table = f"{db}.validation_report"
    job = Replication(
        spark, ["events"], db, DAY, resolve_run_mode("2024-01-15"), load_source=lambda t: src,
        database_name=DB_NAME, report_table=report_table,
    )
    replicate(job)
    return spark.table(report_table).select(*REPORT_SCHEMA.fieldNames())


def _optional(module: str):
    """A module that may have been removed, or None; any other import error is raised."""
    try:
        return importlib.import_module(module)
    except ModuleNotFoundError as e:
        if e.name is None or not f"{module}.".startswith(f"{e.name}."):
            raise
        return None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registry = _optional("tablesync.llm.registry")
    pipeline = _optional("corpus_pipeline") if registry else None
    llm = dict(registry.QUERIES) if registry else {}
    return _own_queries() | llm | ({"pipeline": pipeline.run} if pipeline else {})


def oracle_sql() -> dict[str, str]:
    registry = _optional("tablesync.llm.registry")
    pipeline = _optional("corpus_pipeline") if registry else None
    llm = dict(registry.ORACLE_SQL) if registry else {}
    whole = {"pipeline": pipeline.ORACLE_SQL} if pipeline and pipeline.ORACLE_SQL else {}
    return _own_oracle_sql() | llm | whole


def _own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "slice_day": q_slice_day,
        "slice_from": q_slice_from,
        "slice_history": q_slice_history,
        "delete_survivors": q_delete_survivors,
        "replace_day": q_replace_day,
        "replace_day_twice": q_replace_day_twice,
        "replace_from": q_replace_from,
        "replace_from_nulls": q_replace_from_nulls,
        "replace_day_null_year": q_replace_day_null_year,
        "replace_from_extra_partition": q_replace_from_extra_partition,
        "append_dotted_column": q_append_dotted_column,
        "control_rows_all": q_control_rows_all,
        "utf8_payload": q_utf8_payload,
        "split_list": q_split_list,
        "append_twice": q_append_twice,
        "append_new_column": q_append_new_column,
        "append_path_new_column": q_append_path_new_column,
        "replace_from_path": q_replace_from_path,
        "replace_stopped_then_empty": q_replace_stopped_then_empty,
        "target_filter_required": q_target_filter_required,
        "recount_together": q_recount_together,
        "nested_passthrough": q_nested_passthrough,
        "empty_slice_keeps_target": q_empty_slice_keeps_target,
        "created_target_columns": q_created_target_columns,
        "target_count": q_target_count,
        "target_reread": q_target_reread,
        "reconcile": q_reconcile,
        "validation_report": q_validation_report,
        "error_rows": q_error_rows,
        "runtime_text": q_runtime_text,
        "date_key": q_date_key,
        "control_lookup": q_control_lookup,
        "process_report": q_process_report,
        "status_message": q_status_message,
        "notify_all": q_notify_all,
        "csv_relay": q_csv_relay,
        "csv_relay_raw": q_csv_relay_raw,
        "json_documents": q_json_documents,
        "table_sizes": q_table_sizes,
        "table_sizes_total": q_table_sizes_total,
    }


_TS_TEXT = (
    "CASE WHEN date_part('microsecond', {c}) % 1000000 = 0 THEN strftime({c}, '%Y-%m-%d %H:%M:%S') "
    "ELSE strftime({c}, '%Y-%m-%d %H:%M:%S.%f') END"
)


def _py_ts(c: str) -> str:
    return "CASE WHEN {c} IS NULL THEN 'None' ELSE {t} END".format(c=c, t=_TS_TEXT.format(c=c))


def _quoted(expr: str) -> str:
    return "'\"' || replace(replace({e}, '\\', '\\\\'), '\"', '\\\"') || '\"'".format(e=expr)


_SIZES = "WITH s AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, sum(strlen(coalesce({c}::VARCHAR, '')) + 1)::BIGINT AS bytes FROM {t}" for t, c in _LINES.items()
) + ") "


def _own_oracle_sql() -> dict[str, str]:
    return {
        "slice_day": f"SELECT l_orderkey, l_linenumber, l_quantity, cda_dt FROM {_SRC} s "
        "WHERE cda_year = 1998 AND cda_dt = DATE '1998-06-15'",
        "slice_from": f"SELECT l_orderkey, l_linenumber, l_quantity, cda_dt FROM {_SRC} s WHERE cda_dt >= DATE '2001-06-01'",
        "slice_history": "SELECT l_orderkey, l_linenumber, cda_year, cda_dt FROM (SELECT l_orderkey, l_linenumber, "
        "CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS cda_dt, "
        "CAST(year(l_shipdate) AS INTEGER) AS cda_year FROM lineitem) s WHERE cda_dt >= DATE '0001-01-01'",
        "delete_survivors": f"SELECT event_id, cda_dt FROM {_EV_NULLS} s WHERE NOT coalesce(cda_dt >= DATE '2024-01-20', false)",
        "replace_day": "SELECT cda_dt, count(*) AS n, "
        "sum(CASE WHEN cda_dt = DATE '1998-06-15' THEN l_quantity ELSE -1.0 END) AS q "
        f"FROM {_SRC} s GROUP BY cda_dt",
        "replace_day_twice": "SELECT cda_dt, count(*) AS n, "
        "sum(CASE WHEN cda_dt = DATE '1998-06-15' THEN l_quantity ELSE -1.0 END) AS q "
        f"FROM {_SRC} s GROUP BY cda_dt",
        "replace_from": "SELECT cda_dt, count(*) AS n, "
        "sum(CASE WHEN cda_dt >= DATE '2001-06-01' THEN l_quantity ELSE -1.0 END) AS q "
        f"FROM {_SRC} s GROUP BY cda_dt",
        "replace_from_nulls": "SELECT event_id, cda_dt, "
        "CASE WHEN coalesce(cda_dt >= DATE '2024-01-20', false) THEN value ELSE -1.0 END AS value "
        f"FROM {_EV_NULLS} s",
        "replace_day_null_year": "SELECT CASE WHEN cda_dt <> DATE '1998-06-15' AND l_orderkey % 3 = 0 THEN NULL ELSE cda_year END AS cda_year, "
        "cda_dt, count(*) AS n, sum(CASE WHEN cda_dt = DATE '1998-06-15' THEN l_quantity ELSE -1.0 END) AS q, "
        f"1 AS first_dropped, 0 AS second_dropped FROM {_SRC} s GROUP BY ALL",
        "replace_from_extra_partition": "WITH e AS (SELECT *, CAST(ts AS DATE) AS cda_dt, "
        "CASE event_id % 4 WHEN 0 THEN 'A:B' WHEN 2 THEN 'x %+y' WHEN 3 THEN 'plain' END AS old FROM events), "
        "n AS (SELECT *, cda_dt >= DATE '2024-01-20' AS new FROM e) "
        "SELECT cda_dt, CASE WHEN new THEN 'plain' ELSE old END AS region, count(*) AS n, "
        "sum(CASE WHEN new THEN value ELSE -1.0 END) AS v, "
        "(SELECT count(*) FROM (SELECT DISTINCT cda_dt, old FROM n WHERE new AND old IS DISTINCT FROM 'plain')) AS first_dropped, "
        "0 AS second_dropped FROM n GROUP BY ALL",
        "append_dotted_column": "SELECT event_id, user_id, CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-20' THEN event_type END AS event_type "
        "FROM events",
        "append_twice": "SELECT CAST(ts AS DATE) AS cda_dt, 2 * count(*) AS n, "
        "'Pass' AS first_result, 'Fail' AS second_result FROM events GROUP BY 1",
        "append_new_column": "SELECT l_orderkey, l_linenumber, cda_dt, "
        f"CASE WHEN cda_dt >= DATE '1998-06-15' THEN l_tax END AS l_tax FROM {_SRC} s",
        "append_path_new_column": "SELECT event_id, CAST(ts AS DATE) AS cda_dt, "
        "CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-15' THEN props END AS props FROM events",
        "replace_from_path": "SELECT event_id, cda_dt, CASE WHEN coalesce(cda_dt >= DATE '2024-01-20', false) THEN value ELSE -1.0 END AS value, "
        f"'0' AS empty_count FROM {_EV_NULLS} s",
        "replace_stopped_then_empty": "SELECT event_id, CAST(ts AS DATE) AS cda_dt, CASE WHEN CAST(ts AS DATE) >= DATE '2024-01-10' THEN value ELSE -1.0 END AS value "
        "FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-10' OR day(ts) % 2 = 1",
        "target_filter_required": "WITH e AS (SELECT event_id, CAST(ts AS DATE) AS d FROM events) "
        "SELECT * FROM (VALUES ('all', 'refused'), ('data column', 'refused'), ('any day', 'refused'), ('day or data', 'refused')) t(asked, answer) "
        "UNION ALL SELECT 'day', count(*)::VARCHAR FROM e WHERE d = DATE '2024-01-15' "
        "UNION ALL SELECT 'day and data', count(*)::VARCHAR FROM e WHERE d = DATE '2024-01-15' AND event_id % 2 = 0 "
        "UNION ALL SELECT 'year', count(*)::VARCHAR FROM e WHERE year(d) = 2024 "
        "UNION ALL SELECT 'from', count(*)::VARCHAR FROM e WHERE d >= DATE '2024-01-20' UNION ALL SELECT 'nothing', '0'",
        "recount_together": "WITH e AS (SELECT count(*) AS n FROM events), o AS (SELECT count(*) AS n FROM orders WHERE year(o_orderdate) = 1997) "
        "SELECT 'events_' || k AS table_name, n::VARCHAR AS source_row_count, (CASE WHEN k = 1 THEN 2 * n ELSE n END)::VARCHAR AS destination_row_count, "
        "CASE WHEN k = 1 THEN 'Fail' ELSE 'Pass' END AS count_result FROM e, range(3) r(k) "
        "UNION ALL SELECT 'orders_' || k, n::VARCHAR, n::VARCHAR, 'Pass' FROM o, range(3) r(k) "
        "UNION ALL SELECT 'part', '0', '0', 'Pass' UNION ALL SELECT 'no_such_table', '0', '0', 'Fail'",
        "nested_passthrough": "SELECT vec_id, CAST(pos AS INTEGER) AS pos, CAST(embedding[pos] AS DOUBLE) AS val "
        "FROM (SELECT vec_id, embedding, generate_subscripts(embedding, 1) AS pos FROM embeddings "
        "WHERE label IS NOT NULL) e",
        "empty_slice_keeps_target": "SELECT CAST(ts AS DATE) AS cda_dt, count(*) AS n, '0' AS source_row_count, "
        "'0' AS destination_row_count, 'Pass' AS count_result, "
        "'event_id,ts,user_id,event_type,value,props,cda_year,cda_dt' AS columns FROM events GROUP BY 1",
        "created_target_columns": "SELECT CAST(position AS INTEGER) AS position, column_name, is_partition, "
        "CAST(0 AS BIGINT) AS row_count, (SELECT count(*) FROM events) AS source_rows FROM (VALUES (1, 'event_id', false), (2, 'ts', false), "
        "(3, 'user_id', false), (4, 'event_type', false), (5, 'value', false), (6, 'props', false), "
        "(7, 'cda_year', true), (8, 'cda_dt', true)) t(position, column_name, is_partition)",
        "target_count": "SELECT 'events' AS table_name, CAST(count(*) AS VARCHAR) AS size FROM events "
        "WHERE CAST(ts AS DATE) = DATE '2024-01-15' UNION ALL SELECT 'missing', CAST(NULL AS VARCHAR)",
        "target_reread": "SELECT event_id, CAST(ts AS DATE) AS cda_dt FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-20'",
        "reconcile": "SELECT 'events' AS table_name, CAST(count(*) AS VARCHAR) AS source_row_count, "
        "CAST(2 * count(*) AS VARCHAR) AS destination_row_count, "
        "CASE WHEN count(*) = 2 * count(*) THEN 'Pass' ELSE 'Fail' END AS count_result FROM events "
        "UNION ALL SELECT 'orders', CAST(count(*) AS VARCHAR), CAST(count(*) AS VARCHAR), 'Pass' FROM orders "
        "WHERE o_orderdate IS NOT NULL "
        "UNION ALL SELECT 'part', CAST(count(*) FILTER (WHERE false) AS VARCHAR), '0', 'Pass' FROM part",
        "validation_report": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, CAST(count(*) AS VARCHAR) AS source_row_count, "
            "CAST(count(*) AS VARCHAR) AS destination_row_count, 'Pass' AS count_result, "
            f"'{DB_NAME}' AS database_name, DATE '2024-02-01' AS load_date, "
            "TIMESTAMP '2024-02-01 10:00:00' AS job_start_time, TIMESTAMP '2024-02-01 10:00:00' AS job_end_time, "
            f"'0 seconds' AS total_runtime, '' AS log_details FROM {t} WHERE CAST({c} AS DATE) = DATE '{d}'"
            for t, c, d in (
                ("lineitem", "l_shipdate", "1998-06-15"),
                ("orders", "o_orderdate", "1998-06-15"),
                ("events", "ts", "2024-01-15"),
            )
        ),
        "error_rows": "SELECT 'events' AS table_name, CAST(count(*) AS VARCHAR) AS source_row_count, "
        "CAST(count(*) AS VARCHAR) AS destination_row_count, 'Pass' AS count_result, false AS has_details "
        "FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15' "
        "UNION ALL SELECT 'no_such_table', '0', '0', 'Fail', true",
        "runtime_text": "SELECT event_id, CASE WHEN s < 60 THEN CAST(CAST(trunc(s) AS BIGINT) AS VARCHAR) || ' seconds' "
        "ELSE CAST(CAST(floor(s / 60) AS BIGINT) AS VARCHAR) || ' minutes ' || "
        "CAST(CAST(floor(s - 60 * floor(s / 60)) AS BIGINT) AS VARCHAR) || ' seconds' END AS total_runtime "
        "FROM (SELECT event_id, CAST(event_id % 7200 AS DOUBLE) + 0.75 AS s FROM events) t",
        "date_key": "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS cda_date FROM orders",
        "control_lookup": "SELECT source_table, target_db, cda_date, business_ts, delivery_ts FROM "
        "(SELECT *, row_number() OVER (PARTITION BY source_table, target_db, cda_date "
        "ORDER BY business_ts DESC NULLS LAST, delivery_ts DESC NULLS LAST) AS rn FROM " + _CONTROL + " c) r WHERE rn = 1",
        "process_report": "SELECT business_ts, delivery_ts, target_db AS source_system, source_table AS table_name, "
        "'Pass' AS count_result, CAST(strptime(CAST(cda_date AS VARCHAR), '%Y%m%d') AS DATE) AS cda_date FROM "
        "(SELECT *, row_number() OVER (PARTITION BY source_table, target_db, cda_date "
        "ORDER BY business_ts DESC NULLS LAST, delivery_ts DESC NULLS LAST) AS rn FROM " + _CONTROL + " c) r WHERE rn = 1",
        "status_message": "SELECT '{\"business_ts\": \"' || " + _TS_TEXT.format(c="ts") + " || '\", "
        "\"delivery_ts\": \"None\", \"props\": ' || left(" + _quoted("props || repeat('\\', (event_id % 70)::INT)") + ", -1)"
        " || '\\u00fc\\ud83d\\ude00\"' || ', \"source_system\": \"db\", "
        "\"table_name\": ' || " + _quoted("event_type") + " || ', \"count_result\": \"Pass\"}' AS message FROM events",
        "notify_all": "SELECT 'lineitem' AS table_name, 'Pass' AS count_result, (SELECT '{\"business_ts\": \"' || "
        + _py_ts("business_ts") + " || '\", \"delivery_ts\": \"' || " + _py_ts("delivery_ts") + " || '\", "
        f"\"source_system\": \"{DB_NAME}\", \"table_name\": \"lineitem\", \"count_result\": \"Pass\"}}' "
        "FROM (SELECT o_orderdate + to_seconds(o_custkey) AS business_ts, "
        "CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderdate + to_seconds(o_orderkey) END AS delivery_ts "
        "FROM orders WHERE CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) = 20010601) c "
        "ORDER BY business_ts DESC NULLS LAST, delivery_ts DESC NULLS LAST LIMIT 1) AS message "
        "UNION ALL SELECT 'events', 'Pass', CAST(NULL AS VARCHAR)",
        "csv_relay": "SELECT CAST(c_custkey AS INTEGER) AS code, c_name AS name, c_acctbal AS bal, "
        "c_mktsegment AS seg FROM customer",
        "csv_relay_raw": "SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS code, '  ' || c_name AS name, "
        "CAST(c_acctbal AS VARCHAR) AS bal, c_mktsegment || ' ' || chr(9) AS seg FROM customer",
        "control_rows_all": f"WITH c AS (SELECT business_ts, delivery_ts FROM {_CONTROL} x WHERE cda_date >= 20010601) "
        "SELECT business_ts, delivery_ts, 'lineitem' AS table_name, 'Pass' AS count_result, DATE '2001-06-01' AS cda_date, "
        "CAST(NULL AS VARCHAR) AS message FROM c UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, m FROM (SELECT '{\"business_ts\": \"' || "
        + _py_ts("business_ts") + " || '\", \"delivery_ts\": \"' || " + _py_ts("delivery_ts") + " || '\", "
        f"\"source_system\": \"{DB_NAME}\", \"table_name\": \"lineitem\", \"count_result\": \"Pass\"}}' AS m "
        "FROM c ORDER BY business_ts DESC NULLS LAST, delivery_ts DESC NULLS LAST LIMIT 1)",
        "utf8_payload": "SELECT doc_id, hex(encode(text)) AS payload FROM documents",
        "split_list": "SELECT doc_id, array_to_string([trim(x) FOR x IN string_split(trim(text), ',') IF trim(x) <> ''], '|') AS items "
        "FROM documents",
        "table_sizes": _SIZES + "SELECT table_name, bytes, bytes * 0.000000001::DOUBLE AS size_gb FROM s",
        "table_sizes_total": _SIZES + "SELECT count(*) AS tables, sum(bytes)::DOUBLE * 0.000000001::DOUBLE AS total_gb FROM s",
        "json_documents": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    }
