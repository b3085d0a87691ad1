"""Registered queries against their DuckDB oracles (the cheaper ones, sf0.01)."""

import datetime as dt
import math
import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF01

CHEAP = [
    "slice_day",
    "slice_from",
    "slice_history",
    "delete_survivors",
    "replace_from_nulls",
    "append_twice",
    "nested_passthrough",
    "empty_slice_keeps_target",
    "created_target_columns",
    "target_count",
    "target_reread",
    "validation_report",
    "error_rows",
    "runtime_text",
    "date_key",
    "control_lookup",
    "status_message",
    "notify_all",
    "csv_relay",
    "csv_relay_raw",
    "replace_from_extra_partition",
    "append_dotted_column",
    "control_rows_all",
    "utf8_payload",
    "split_list",
    "table_sizes",
    "table_sizes_total",
    "append_path_new_column",
    "replace_from_path",
    "replace_stopped_then_empty",
    "target_filter_required",
    "recount_together",
]


def _norm(v):
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else "nan"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in E.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(E._own_queries()) == set(E._own_oracle_sql())


def test_entry_without_the_optional_subpackage(tmp_path):
    """Its folders and the pipeline may be removed; the other queries stay."""
    for name in ("__spark_entry__.py", "tablesync"):
        source = os.path.join(os.path.dirname(E.__file__), name)
        if os.path.isdir(source):
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    code = "import __spark_entry__ as e; print(sorted(e.queries()) == sorted(e.oracle_sql()) == sorted(e._own_queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert out.stdout.strip() == "True"


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0].count_result == "Pass"


@pytest.mark.parametrize("name", CHEAP)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF01)
    res = duck.execute(E.oracle_sql()[name])
    got = _bag(df.columns, [tuple(r) for r in df.collect()])
    want = _bag([d[0] for d in res.description], res.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]
