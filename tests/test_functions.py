"""Scalar functions: F1-F13 and run-mode resolution."""

import datetime as dt
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablesync.functions.dates import FixedClock, check_iso_date, date_key_of, year_of
from tablesync.functions.message import json_quote, status_messages
from tablesync.functions.runtime import runtime_text, runtime_text_of_seconds
from tablesync.functions.status import pass_fail, verdict
from tablesync.functions.text import fill_template, split_list
from tablesync.functions.units import bytes_to_gb
from tablesync.plans.runmode import resolve_run_mode


def test_year_and_date_key():
    assert year_of("1998-06-15") == 1998
    assert year_of("0000-01-01") == 0
    assert date_key_of("2022-09-28") == 20220928
    with pytest.raises(ValueError):
        check_iso_date("2022-13-01")
    with pytest.raises(ValueError):
        check_iso_date("28.09.2022")


def test_run_mode():
    clock = FixedClock(dt.datetime(2024, 3, 5, 1, 2, 3))
    assert resolve_run_mode("NONE", clock).date == "2024-03-05"
    assert not resolve_run_mode("NONE", clock).history
    assert resolve_run_mode("0000-01-01").history
    assert resolve_run_mode(" 1998-06-15 ").date == "1998-06-15"
    assert resolve_run_mode("1998-06-15").day_slice().kind == "day"
    assert resolve_run_mode("1998-06-15").open_slice().kind == "from"
    assert resolve_run_mode("0000-01-01").open_slice().kind == "history"
    with pytest.raises(KeyError):
        resolve_run_mode(None)


def test_split_list_and_template():
    assert split_list(" a,b , c ") == ["a", "b", "c"]
    assert split_list("a,,b") == ["a", "b"]
    with pytest.raises(KeyError):
        split_list(None)
    sql = "select 1 from t where source_table = <SOURCE_TABLE> and cda_date = <CDATE>"
    assert fill_template(sql, {"SOURCE_TABLE": "o'brien", "CDATE": 20240101}) == (
        "select 1 from t where source_table = 'o''brien' and cda_date = 20240101"
    )


def _expected_runtime(seconds: float) -> str:
    """The runtime text rule, written out plainly for the test."""
    if seconds < 60:
        return f"{int(seconds)} seconds"
    minutes, rest = divmod(seconds, 60)
    return f"{int(minutes)} minutes {int(rest)} seconds"


@pytest.mark.parametrize(
    "secs,text",
    [
        (0.0, "0 seconds"),
        (59.999, "59 seconds"),
        (60.0, "1 minutes 0 seconds"),
        (61.5, "1 minutes 1 seconds"),
        (3725.0, "62 minutes 5 seconds"),
        (-5.5, "-5 seconds"),
    ],
)
def test_runtime_text_cases(spark, secs, text):
    got = spark.range(1).select(runtime_text_of_seconds(F.lit(secs)).alias("t")).first()["t"]
    assert got == text


@settings(max_examples=40, deadline=None)
@given(st.integers(min_value=0, max_value=10 * 86400 * 1_000_000))
def test_runtime_text_matches_rule(spark, micros):
    start = dt.datetime(2024, 1, 1, 0, 0, 0)
    end = start + dt.timedelta(microseconds=micros)
    df = spark.createDataFrame([(start, end)], "s timestamp_ntz, e timestamp_ntz")
    got = df.select(runtime_text("s", "e").alias("t")).first()["t"]
    assert got == _expected_runtime((end - start).total_seconds())


def test_pass_fail(spark):
    df = spark.createDataFrame([("1", "1"), ("1", "2"), (None, "1"), (None, None)], "s string, t string")
    got = [r[0] for r in df.select(pass_fail("s", "t")).collect()]
    assert got == ["Pass", "Fail", "Fail", "Pass"]
    assert verdict("0", "0") == "Pass" and verdict("5", None) == "Fail"


def test_bytes_to_gb(spark):
    assert spark.range(1).select(bytes_to_gb(F.lit(2_500_000_000))).first()[0] == pytest.approx(2.5)


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=30))
def test_json_quote_equals_python(spark, text):
    got = spark.createDataFrame([(text,)], "v string").select(json_quote("v")).first()[0]
    assert got == json.dumps(text)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 300), st.sampled_from(["", "\u00fc", "u00FC", '"', "\u007f", "\n", "\U0001f600AB", "a"])), max_size=8))
def test_json_quote_after_any_run_of_backslashes(spark, parts):
    text = "".join("\\" * n + tail for n, tail in parts)
    got = spark.createDataFrame([(text,)], "v string").select(json_quote("v")).first()[0]
    assert got == json.dumps(text)


def test_template_values_stay_values():
    values = {"T": "o'x\\' or 1=1 --<D>", "D": 20240101, "TT": "plain"}
    quoted = "'o''x\\'' or 1=1 --<D>'"
    assert fill_template("a = <T> and d = <D>", values) == f"a = {quoted} and d = 20240101"
    assert fill_template("a = '<T>' and d = '<D>'", values) == f"a = {quoted} and d = '20240101'"
    assert fill_template("a = 'x <TT>''<TT>' and b = <TT>", values) == "a = 'x plain''plain' and b = 'plain'"
    assert fill_template("a = <OTHER>", values) == "a = <OTHER>"
    assert fill_template("a = <T>", {}) == "a = <T>"


def test_status_message_equals_python(spark):
    rows = [
        (dt.datetime(2022, 9, 28, 19, 10, 36, 120000), None, "Zürich \"x\"", True, 7, 1.5),
        (dt.datetime(2022, 9, 28, 19, 10, 36), dt.datetime(2022, 9, 29, 1, 2, 3, 4), "a\\u00e9\n", False, None, None),
    ]
    schema = "business_ts timestamp_ntz, delivery_ts timestamp_ntz, note string, flag boolean, n int, x double"
    df = spark.createDataFrame(rows, schema)
    got = sorted(r[0] for r in status_messages(df, "db", "t1", "Pass").collect())
    expected = []
    for r in rows:
        d = {k: str(v) for k, v in zip(["business_ts", "delivery_ts", "note", "flag", "n", "x"], r, strict=True)}
        d.update(source_system="db", table_name="t1", count_result="Pass")
        expected.append(json.dumps(d))
    assert got == sorted(expected)


def test_message_literal_overwrites_in_place(spark):
    df = spark.createDataFrame([("x", 1)], "table_name string, k int")
    got = status_messages(df, "db", "t1", "Fail").first()[0]
    assert got == json.dumps({"table_name": "t1", "k": "1", "source_system": "db", "count_result": "Fail"})


def test_json_quote_hard_cases(spark):
    text = "".join(chr(i) for i in range(0x20)) + '\x7f\x80é 😀 \\u00AB \\\\u00ab "q" /'
    got = spark.createDataFrame([(text,)], "v string").select(json_quote("v")).first()[0]
    assert got == json.dumps(text)


def test_split_list_col(spark):
    from tablesync.functions.text import split_list_col

    df = spark.createDataFrame([(" a, b ,,c ",)], "v string")
    assert df.select(split_list_col("v")).first()[0] == ["a", "b", "c"]


def test_message_sink_needs_a_destination(spark):
    import pytest

    from tablesync import MessageSink

    df = spark.createDataFrame([("m",)], "value string")
    with pytest.raises(ValueError):
        MessageSink("kafka").publish(df)
    with pytest.raises(ValueError):
        MessageSink("text").publish(df)
