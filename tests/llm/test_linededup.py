from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import DOCS, SF, same_as_sql, write_tables
from tablesync.llm import linededup

BLANK = " \t\n\x0b\x0c\r"


def brute(texts, min_docs, min_chars):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANK))

    docs = [(t or "").split("\n") for t in texts]
    seen = Counter(k for d in docs for k in {key(x) for x in d} if len(k) >= min_chars)
    return ["\n".join(x for x in d if seen[key(x)] < min_docs) for d in docs]


def test_whole_table(spark):
    assert same_as_sql(linededup.op7_line_dedup(spark, SF), linededup.OP7_SQL)


@pytest.mark.parametrize("most", [200_000, 0])
def test_odd_rows(spark, monkeypatch, most):
    monkeypatch.setattr(linededup, "BROADCAST_LINES", most)  # both joins
    texts = ["Hot LINE\nown 1\n\n", " hot line\t\nÉ\nown 2", None, "", "hot line", "é\nhot line\nhot line", "x \nhot line", "É" * 200_000]
    texts += ["same\nhot line"] * 3 + [" \nhot line \x1c"]
    rows = [(None if i == 4 else 7 if i in (8, 9, 10) else i, t, None, "s", 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"n_lines": F.lit("old"), "drop": F.lit(3), "line": F.lit("q")})
    for min_docs, min_chars in ((3, 1), (2, 1), (2, 0), (3, 5)):
        out = linededup.dedup_lines(docs, min_docs, min_chars)
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "drop", "line", "n_lines", "n_dropped"]
        got = sorted(((r.doc_id is None, r.doc_id), r.text, r.n_lines, r.n_dropped) for r in out.collect())
        kept = brute(texts, min_docs, min_chars)
        lines = [len((t or "").split("\n")) for t in texts]
        want = []
        for r, t, n in zip(rows, kept, lines, strict=True):
            want.append(((r[0] is None, r[0]), t, n))
        assert [g[:3] for g in got] == sorted(want), (min_docs, min_chars)


def test_empty_table(spark, tmp_path):
    assert linededup.op7_line_dedup(spark, write_tables(spark, tmp_path)).count() == 0


def test_few_rows_at_a_time(spark, monkeypatch):
    """Lines are counted 256 rows at a time, whatever the session's batches are; these stay as they are."""
    keys_of, key = linededup._keys_of, "spark.sql.execution.arrow.maxRecordsPerBatch"

    def checked(min_chars):
        run = keys_of(min_chars)

        def few(batches):
            for batch in batches:
                assert len(batch) <= 256
                yield batch

        return lambda batches: run(few(batches))

    monkeypatch.setattr(linededup, "_keys_of", checked)
    before = spark.conf.get(key)
    docs = spark.range(1000).selectExpr("id AS doc_id", "concat('Hot\\nline ', id) AS text").repartition(1)
    out = linededup.dedup_lines(docs)
    assert out.sparkSession is docs.sparkSession and spark.conf.get(key) == before
    assert {(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()} == {(i, f"line {i}", 2, 1) for i in range(1000)}


def test_few_lines_leave_texts_in_place(spark):
    """Frequent lines that are few go to every task: no text is shuffled."""
    docs = spark.range(30).selectExpr("id AS doc_id", "concat('hot\\nline ', id) AS text")
    out = linededup.dedup_lines(docs)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.text for r in out.collect()) == sorted(f"line {i}" for i in range(30))


def test_texts_leave_in_parts(monkeypatch):
    """Of a batch of long texts, Python holds a few at a time."""
    monkeypatch.setattr(linededup, "EMIT_CHARS", 1000)
    texts, hot = [None, "x" * 5000, "hot\nown", *[f"own {i}\nhot\n" + "y" * 400 for i in range(6)], ""], linededup._hashes([b"hot"], 1)
    drops = [None if t is None else hot if "hot" in t else [] for t in texts]
    batch = pa.RecordBatch.from_arrays([pa.array(range(10)), pa.array(texts), pa.array(drops, pa.list_(pa.binary()))], names=["id", "text", "drop"])

    class Sent:
        value = b"".join(hot)

    for run, rows in ((linededup._cut(1, Sent()), batch.drop_columns(["drop"])), (linededup._cut(1), batch)):
        parts = list(run([rows]))
        assert [len(p) for p in parts] == [2, 4, 3, 1]
        assert [x for p in parts for x in p["id"].to_pylist()] == list(range(10))
        assert [x for p in parts for x in p["text"].to_pylist()] == brute([t or "" for t in texts], 7, 1)
        assert [x for p in parts for x in p["n_dropped"].to_pylist()] == [0, 0, *[1] * 7, 0]
