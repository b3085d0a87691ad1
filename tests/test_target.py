"""Target writes (K1-K4), reads (S4, S5, S9) and the replace traps."""

import datetime as dt
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablesync import DayTarget, SliceSpec, survivors
from tablesync.session import fresh_database

SCHEMA = "id long, v string, cda_year int, cda_dt date"


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _row(i, day, v="old"):
    return (i, v, day.year if day else 2024, day)


def _bag(df):
    return Counter(tuple(r) for r in df.select("id", "v", "cda_year", "cda_dt").collect())


D = dt.date


def test_replace_day_keeps_other_days_and_nulls(spark):
    db = fresh_database(spark)
    t = DayTarget(spark, f"{db}.t", "cda_dt")
    t.append(_frame(spark, [_row(1, D(2024, 1, 1)), _row(2, D(2024, 1, 2)), _row(3, None)]))
    res = t.replace(_frame(spark, [_row(4, D(2024, 1, 2), "new")]), SliceSpec.day("2024-01-02").replace_predicate("cda_dt"))
    assert res.rows == 1
    got = _bag(spark.table(f"{db}.t"))
    assert got == Counter([(1, "old", 2024, D(2024, 1, 1)), (4, "new", 2024, D(2024, 1, 2)), (3, "old", 2024, None)])


def test_replace_twice_equals_once(spark):
    db = fresh_database(spark)
    t = DayTarget(spark, f"{db}.t", "cda_dt")
    t.append(_frame(spark, [_row(1, D(2024, 1, 1)), _row(2, D(2024, 1, 2))]))
    new = _frame(spark, [_row(5, D(2024, 1, 2), "new"), _row(6, D(2024, 1, 2), "new")])
    pred = SliceSpec.day("2024-01-02").replace_predicate("cda_dt")
    t.replace(new, pred)
    once = _bag(spark.table(f"{db}.t"))
    t.replace(new, pred)
    assert _bag(spark.table(f"{db}.t")) == once


def test_empty_slice_changes_nothing(spark):
    """An empty slice neither deletes nor writes."""
    db = fresh_database(spark)
    t = DayTarget(spark, f"{db}.t", "cda_dt")
    t.append(_frame(spark, [_row(1, D(2024, 1, 1))]))
    res = t.replace(_frame(spark, []), SliceSpec.from_date("2023-01-01").replace_predicate("cda_dt"))
    assert res.rows == 0
    assert spark.table(f"{db}.t").count() == 1


def test_replace_from_drops_stale_days(spark):
    """Days >= d that the new slice lacks disappear; older days and NULL days stay."""
    db = fresh_database(spark)
    t = DayTarget(spark, f"{db}.t", "cda_dt")
    t.append(_frame(spark, [_row(1, D(2024, 1, 1)), _row(2, D(2024, 1, 5)), _row(3, D(2099, 1, 1)), _row(4, None)]))
    res = t.replace(_frame(spark, [_row(9, D(2024, 1, 5), "new")]), SliceSpec.from_date("2024-01-03").replace_predicate("cda_dt"))
    assert (2099, D(2099, 1, 1)) in res.dropped
    got = _bag(spark.table(f"{db}.t"))
    assert got == Counter([(1, "old", 2024, D(2024, 1, 1)), (9, "new", 2024, D(2024, 1, 5)), (4, "old", 2024, None)])


def test_day_replace_clears_wrong_year_partition(spark):
    """The day delete has no year test, so a row filed under another year goes too."""
    db = fresh_database(spark)
    t = DayTarget(spark, f"{db}.t", "cda_dt")
    t.append(_frame(spark, [(1, "old", 1999, D(1998, 6, 15)), (2, "old", 1998, D(1998, 6, 15))]))
    t.replace(_frame(spark, [(3, "new", 1998, D(1998, 6, 15))]), SliceSpec.day("1998-06-15").replace_predicate("cda_dt"))
    assert _bag(spark.table(f"{db}.t")) == Counter([(3, "new", 1998, D(1998, 6, 15))])
    # the same through the narrowed partition listing of a day replace
    t.append(_frame(spark, [(4, "old", 1999, D(1998, 6, 15)), (5, "old", 1998, D(1998, 6, 16))]))
    res = t.replace(_frame(spark, [(6, "new", 1998, D(1998, 6, 15))]), SliceSpec.day("1998-06-15").replace_predicate("cda_dt"), day="1998-06-15")
    assert res.dropped == ((1999, D(1998, 6, 15)),)
    assert _bag(spark.table(f"{db}.t")) == Counter([(6, "new", 1998, D(1998, 6, 15)), (5, "old", 1998, D(1998, 6, 16))])


def test_field_addition_and_missing_columns(spark):
    """K1: a new source column is added to the target; a missing one is written as NULL."""
    db = fresh_database(spark)
    t = DayTarget(spark, f"{db}.t", "cda_dt")
    t.append(spark.createDataFrame([(1, 2024, D(2024, 1, 1))], "id long, cda_year int, cda_dt date"))
    t.append(spark.createDataFrame([(2, "x", 2024, D(2024, 1, 2))], "id long, extra string, cda_year int, cda_dt date"))
    t.append(spark.createDataFrame([(3, 2024, D(2024, 1, 3))], "id long, cda_year int, cda_dt date"))
    rows = {r["id"]: r["extra"] for r in spark.table(f"{db}.t").collect()}
    assert rows == {1: None, 2: "x", 3: None}
    assert spark.table(f"{db}.t").columns == ["id", "extra", "cda_year", "cda_dt"]


def test_create_empty_keeps_schema_and_nested_types(spark):
    """K4 with a nested column."""
    db = fresh_database(spark)
    t = DayTarget(spark, f"{db}.t", "cda_dt")
    schema = spark.createDataFrame([], "id long, vec array<float>, m map<string,int>, s struct<`a b`: int>, cda_year int, cda_dt date").schema
    assert t.create_empty(schema)
    assert not t.create_empty(schema)
    assert spark.table(f"{db}.t").schema == schema
    assert spark.table(f"{db}.t").count() == 0


def test_counts_and_missing_target(spark):
    """A missing target counts as NULL, not an error."""
    db = fresh_database(spark)
    t = DayTarget(spark, f"{db}.t", "cda_dt")
    assert not t.exists()
    assert t.count(SliceSpec.day("2024-01-01").target_filter("cda_dt")) is None
    assert t.count_frame(SliceSpec.day("2024-01-01").target_filter("cda_dt")).first()["size"] is None
    t.append(_frame(spark, [_row(1, D(2024, 1, 1)), _row(2, D(2024, 1, 1)), _row(3, D(2024, 1, 2))]))
    assert t.count(SliceSpec.day("2024-01-01").target_filter("cda_dt")) == "2"
    assert t.count_frame(SliceSpec.from_date("2024-01-02").target_filter("cda_dt")).first()["size"] == "1"


def test_history_floor_counts_year_zero_at_source_only(spark):
    """The source takes year 0, the target re-count starts at year 1."""
    df = spark.sql("SELECT DATE'0000-06-01' AS cda_dt UNION ALL SELECT DATE'2000-01-01' UNION ALL SELECT CAST(NULL AS DATE)")
    spec = SliceSpec.history()
    assert df.where(spec.source_filter("cda_dt", None)).count() == 2
    assert df.where(spec.target_filter("cda_dt", None)).count() == 1


def test_day_slice_prunes_partitions(spark):
    """P2 on a partitioned table becomes partition filters, not a scan of everything."""
    db = fresh_database(spark)
    t = DayTarget(spark, f"{db}.t", "cda_dt")
    t.append(_frame(spark, [_row(1, D(2024, 1, 1)), _row(2, D(2024, 1, 2))]))
    plan = t.read(SliceSpec.day("2024-01-02").target_filter("cda_dt"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "cda_dt" in plan


DAYS = [D(2024, 1, d) for d in range(1, 8)] + [None]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    old=st.lists(st.sampled_from(DAYS), max_size=12),
    new=st.lists(st.sampled_from(DAYS[:-1]), max_size=8),
    cut=st.integers(min_value=1, max_value=7),
)
def test_replace_from_is_survivors_plus_slice(spark, old, new, cut):
    """Property: after replace-from, target == survivors(old) + slice, as a bag."""
    d = f"2024-01-0{cut}"
    spec = SliceSpec.from_date(d)
    db = fresh_database(spark)
    t = DayTarget(spark, f"{db}.t", "cda_dt")
    old_df = _frame(spark, [_row(i, day) for i, day in enumerate(old)])
    t.create_empty(old_df.schema)
    t.append(old_df)
    source = _frame(spark, [_row(100 + i, day, "new") for i, day in enumerate(new)])
    sliced = source.where(spec.source_filter("cda_dt", None))
    t.replace(sliced, spec.replace_predicate("cda_dt"))
    expected = _bag(old_df.where(survivors(spec.replace_predicate("cda_dt")))) + _bag(sliced)
    if sliced.count() == 0:
        expected = _bag(old_df)  # T3: an empty slice deletes nothing
    assert _bag(spark.table(f"{db}.t")) == expected


def test_without_aqe_writes_from_scan_splits(spark):
    """With AQE off there is no rebalance shuffle (a hot day would land in one task)."""
    db = fresh_database(spark)
    t = DayTarget(spark, f"{db}.t", "cda_dt")
    df = _frame(spark, [_row(i, D(2024, 1, 1 + i % 3)) for i in range(30)])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = t._layout(df, ["cda_year", "cda_dt"])._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        res = t.replace(df, SliceSpec.from_date("2024-01-01").replace_predicate("cda_dt"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert res.rows == 30 and spark.table(f"{db}.t").count() == 30
    plan = t._layout(df, ["cda_year", "cda_dt"])._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


def test_day_column_must_be_a_date(spark):
    import pytest

    db = fresh_database(spark)
    t = DayTarget(spark, f"{db}.t", "cda_dt")
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 10, 0))], "id long, cda_dt timestamp")
    with pytest.raises(ValueError, match="must be DATE"):
        t.append(df)
    assert not t.exists()


def test_replace_refuses_rows_outside_the_range(spark):
    import pytest

    db = fresh_database(spark)
    t = DayTarget(spark, f"{db}.t", "cda_dt")
    t.append(_frame(spark, [_row(1, D(2024, 1, 1)), _row(2, D(2024, 1, 5))]))
    bad = _frame(spark, [_row(3, D(2024, 1, 5), "new"), _row(4, D(2024, 1, 1), "new")])
    with pytest.raises(Exception, match="outside the replaced range"):
        t.replace(bad, SliceSpec.from_date("2024-01-03").replace_predicate("cda_dt"))
    assert _bag(spark.table(f"{db}.t")) == Counter([(1, "old", 2024, D(2024, 1, 1)), (2, "old", 2024, D(2024, 1, 5))])


def test_nested_values_survive_and_nested_columns_can_be_added(spark):
    db = fresh_database(spark)
    t = DayTarget(spark, f"{db}.t", "cda_dt")
    first = spark.createDataFrame(
        [(1, [1.5, None], {"a": 1}, 2024, D(2024, 1, 1))],
        "id long, arr array<double>, m map<string,int>, cda_year int, cda_dt date",
    )
    t.append(first)
    second = spark.createDataFrame(
        [(2, [2.0], {"b": 2}, (7, ["x"]), 2024, D(2024, 1, 2))],
        "id long, arr array<double>, m map<string,int>, s struct<`odd name`: int, tags: array<string>>, cda_year int, cda_dt date",
    )
    t.append(second)
    rows = {r["id"]: r for r in spark.table(f"{db}.t").collect()}
    assert rows[1]["arr"] == [1.5, None] and rows[1]["m"] == {"a": 1} and rows[1]["s"] is None
    assert rows[2]["s"]["odd name"] == 7 and rows[2]["s"]["tags"] == ["x"] and rows[2]["m"] == {"b": 2}


def test_replace_into_a_table_created_elsewhere_keeps_other_days(spark):
    """A table without the dynamic option: the write still swaps only its days,
    and the session setting is restored afterwards."""
    db = fresh_database(spark)
    spark.sql(f"CREATE TABLE {db}.t (id long, v string, cda_year int, cda_dt date) USING parquet PARTITIONED BY (cda_year, cda_dt)")
    spark.sql(f"INSERT INTO {db}.t VALUES (1, 'old', 2024, DATE'2024-01-01'), (2, 'old', 2024, DATE'2024-01-02')")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    t = DayTarget(spark, f"{db}.t", "cda_dt")
    t.replace(_frame(spark, [_row(3, D(2024, 1, 2), "new")]), SliceSpec.day("2024-01-02").replace_predicate("cda_dt"))
    assert _bag(spark.table(f"{db}.t")) == Counter([(1, "old", 2024, D(2024, 1, 1)), (3, "new", 2024, D(2024, 1, 2))])
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before


def test_null_year_partition_is_dropped_for_both_slices(spark):
    for spec, year in ((SliceSpec.day("2024-01-02"), 2024), (SliceSpec.day("2024-01-02"), None), (SliceSpec.from_date("2024-01-02"), None)):
        db = fresh_database(spark)
        t = DayTarget(spark, f"{db}.t", "cda_dt")
        t.append(_frame(spark, [(1, "old", None, D(2024, 1, 2)), (2, "old", 2024, D(2024, 1, 2)), (3, "old", None, D(2024, 1, 1)), (4, "old", None, None)]))
        new = _frame(spark, [(5, "new", 2024, D(2024, 1, 2))])
        day = spec.date if spec.kind == "day" else None
        first = t.replace(new, spec.replace_predicate("cda_dt"), day, year)
        assert first.dropped == ((None, D(2024, 1, 2)),)
        want = Counter([(5, "new", 2024, D(2024, 1, 2)), (3, "old", None, D(2024, 1, 1)), (4, "old", None, None)])
        assert _bag(spark.table(f"{db}.t")) == want
        assert t.replace(new, spec.replace_predicate("cda_dt"), day, year).dropped == ()
        assert _bag(spark.table(f"{db}.t")) == want


def test_replace_within_a_year_refuses_rows_of_another(spark):
    import pytest

    db = fresh_database(spark)
    t = DayTarget(spark, f"{db}.t", "cda_dt")
    t.append(_frame(spark, [_row(1, D(2024, 1, 2))]))
    spec = SliceSpec.day("2024-01-02")
    for year in (2023, None):
        with pytest.raises(Exception, match="outside the replaced range"):
            t.replace(_frame(spark, [(2, "new", year, D(2024, 1, 2))]), spec.replace_predicate("cda_dt"), spec.date, 2024)
    assert t.replace(_frame(spark, []), spec.replace_predicate("cda_dt"), spec.date, 2024).rows == 0
    assert _bag(spark.table(f"{db}.t")) == Counter([(1, "old", 2024, D(2024, 1, 2))])


def test_foreign_table_is_overwritten_dynamically_without_touching_the_session(spark):
    db = fresh_database(spark)
    df = _frame(spark, [_row(1, D(2024, 1, 1)), _row(2, D(2024, 1, 2))])
    df.write.partitionBy("cda_year", "cda_dt").saveAsTable(f"{db}.t")
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    seen = []

    class Watched(DayTarget):
        def _overwrite_elsewhere(self, *args):
            seen.append(spark.conf.get(key))
            super()._overwrite_elsewhere(*args)
            seen.append(spark.conf.get(key))

    t = Watched(spark, f"{db}.t", "cda_dt")
    res = t.replace(_frame(spark, [_row(3, D(2024, 1, 2), "new")]), SliceSpec.day("2024-01-02").replace_predicate("cda_dt"), "2024-01-02")
    assert res.rows == 1 and seen == [before, before] and before.lower() == "static"
    assert _bag(spark.table(f"{db}.t")) == Counter([(1, "old", 2024, D(2024, 1, 1)), (3, "new", 2024, D(2024, 1, 2))])
    assert not [v for v in spark.catalog.listTables("global_temp") if v.name.startswith("tsync_")]


def test_empty_slice_does_not_widen_the_table(spark):
    from pyspark.sql import functions as F

    db = fresh_database(spark)
    t = DayTarget(spark, f"{db}.t", "cda_dt")
    t.append(_frame(spark, [_row(1, D(2024, 1, 1))]))
    empty = _frame(spark, []).withColumn("more", F.lit(1))
    assert t.append(empty).rows == 0
    assert t.replace(empty, SliceSpec.from_date("2024-01-01").replace_predicate("cda_dt")).rows == 0
    assert spark.table(f"{db}.t").columns == ["id", "v", "cda_year", "cda_dt"] and spark.table(f"{db}.t").count() == 1


def test_missing_metric_is_not_an_empty_write(spark):
    import pytest

    from tablesync.operators.target import _metric

    class Lost:
        get = {}

    with pytest.raises(RuntimeError, match="rows"):
        _metric(Lost(), "rows")
