"""Control lookups (P8, L1, A4) and the notify tail with a control reader."""

import datetime as dt
import json

from pyspark.sql import functions as F

from conftest import SF001
from tablesync import FixedClock, MessageSink, Notify, Replication, replicate_and_notify, resolve_run_mode
from tablesync.plans.notify import lookup_all, lookup_control
from tablesync.session import fresh_database, shared_root

T = dt.datetime
SCHEMA = "source_table string, target_db string, cda_date int, business_ts timestamp_ntz, delivery_ts timestamp_ntz"
ROWS = [
    # key a: the newest business_ts wins
    ("a", "db", 1, T(2024, 1, 1, 8), T(2024, 1, 1, 9)),
    ("a", "db", 1, T(2024, 1, 1, 10), None),
    # key b: equal business_ts, the newest delivery_ts wins, NULL last
    ("b", "db", 1, T(2024, 1, 1, 8), None),
    ("b", "db", 1, T(2024, 1, 1, 8), T(2024, 1, 1, 7)),
    # key c: NULL business_ts only if nothing else
    ("c", "db", 1, None, T(2024, 1, 1, 1)),
    ("c", "db", 1, T(2023, 12, 31, 23), None),
    # key d: only NULLs
    ("d", "db", 1, None, None),
]
EXPECTED = {
    "a": (T(2024, 1, 1, 10), None),
    "b": (T(2024, 1, 1, 8), T(2024, 1, 1, 7)),
    "c": (T(2023, 12, 31, 23), None),
    "d": (None, None),
}


def test_single_key_and_all_keys_agree(spark):
    control = spark.createDataFrame(ROWS, SCHEMA)
    for key, want in EXPECTED.items():
        got = lookup_control(control, key, "db", 1).collect()
        assert [tuple(r) for r in got] == [want]
    every = {r.source_table: (r.business_ts, r.delivery_ts) for r in lookup_all(control).collect()}
    assert every == EXPECTED
    assert lookup_control(control, "a", "db", 2).isEmpty()  # A4: no row for that day


def test_control_reader_callable(spark):
    """The template form: a reader per (table, database, day) returning the row."""
    db = fresh_database(spark)
    ev = spark.read.parquet(f"{SF001}/events.parquet").withColumns(
        {"cda_dt": F.col("ts").cast("date"), "cda_year": F.year("ts").cast("int")}
    )
    calls = []

    def reader(table, database, key):
        calls.append((table, database, key))
        return spark.createDataFrame([(T(2024, 1, 15, 6, 30), "late")], "business_ts timestamp_ntz, note string")

    path = f"{shared_root(spark)}/messages/{db}"
    job = Replication(
        spark, ["events"], db, "cda_dt", resolve_run_mode("2024-01-15"), load_source=lambda t: ev,
        database_name="src", clock=FixedClock(T(2024, 2, 1)),
    )
    replicate_and_notify(job, Notify(reader, sink=MessageSink("text", path)))
    assert calls == [("events", "src", 20240115)]
    [message] = [r.value for r in spark.read.text(path).collect()]
    assert json.loads(message) == {
        "business_ts": "2024-01-15 06:30:00",
        "note": "late",
        "source_system": "src",
        "table_name": "events",
        "count_result": "Pass",
    }
    assert message.startswith('{"business_ts": "2024-01-15 06:30:00", "note": "late", ')


def _newest_first(rows, width):
    """Brute force: sort each key's rows newest first, NULL last, column by column."""
    best = {}
    for r in rows:
        key, vals = r[:3], r[3:]
        rank = tuple((v is not None, v if v is not None else 0) for v in vals[:width])
        if key not in best or rank > best[key][0]:
            best[key] = (rank, vals[:width])
    return {k: v[1] for k, v in best.items()}


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_small = st.one_of(st.none(), st.integers(min_value=0, max_value=3))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), _small, _small, _small), max_size=25))
def test_lookup_all_matches_brute_force(spark, raw):
    rows = [(t, "db", 1, b, d, e) for t, b, d, e in raw]
    df = spark.createDataFrame(rows, "source_table string, target_db string, cda_date int, b int, d int, e int")
    got = {tuple(r[:3]): tuple(r[3:]) for r in lookup_all(df, ("b", "d", "e")).collect()}
    assert got == _newest_first(rows, 3)


def test_all_control_rows_are_reported_and_the_last_is_published(spark):
    from tablesync.plans.notify import last_row

    db = fresh_database(spark)
    day = dt.date(2024, 1, 15)
    src = spark.createDataFrame([(1, 2024, day)], "id long, cda_year int, cda_dt date")
    rows = [("r2", T(2024, 1, 2)), ("r3", None), ("r1", T(2024, 1, 9)), ("r3", T(2024, 1, 1)), (None, T(2030, 1, 1))]
    control = spark.createDataFrame(rows, "batch string, business_ts timestamp_ntz")
    path = f"{shared_root(spark)}/messages/{db}"
    job = Replication(spark, ["events"], db, "cda_dt", resolve_run_mode("2024-01-15"), load_source=lambda t: src, database_name="d")
    notify = Notify(lambda t, d, k: control, process_table=f"{db}.process", sink=MessageSink("text", path))
    assert replicate_and_notify(job, notify).first().count_result == "Pass"
    got = spark.table(f"{db}.process").select("batch", "business_ts").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, rows))
    messages = [json.loads(r.value) for r in spark.read.text(path).collect()]
    assert [(m["batch"], m["business_ts"]) for m in messages] == [("r3", "2024-01-01 00:00:00")]
    assert last_row(control.where("false")).count() == 0
    odd = spark.createDataFrame([({"k": 1}, 1), ({"k": 2}, 5)], "m map<string,int>, `a.b` int")
    assert [r["a.b"] for r in last_row(odd).collect()] == [5]
