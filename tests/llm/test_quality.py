import math
import random
from collections import Counter

import numpy as np
from helpers import SF, duck, write_tables
from pyspark.sql import functions as F

from tablesync.llm import quality as Q
from tablesync.llm.common import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = " \t\n\x0b\x0c\r"


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text, counted plainly."""
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(SPACE):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def plain_estimate(seen, rules, rounds=Q.ROUNDS, balance=Q.BALANCE):
    """The same expectation-maximisation in numpy: rows of votes, their numbers."""
    votes, n = np.array([v for v, _ in seen]).reshape(-1, rules), np.array([c for _, c in seen], float)
    good, bad = (votes == 1).sum(1), (votes == -1).sum(1)
    p = (good + 1) / (good + bad + 2)
    for k in range(rounds + 1):
        right = ((votes == 1) * (n * p)[:, None] + (votes == -1) * (n * (1 - p))[:, None]).sum(0)
        accuracy = np.maximum(0.5, (right + Q.PRIOR_RIGHT) / (((votes != 0) * n[:, None]).sum(0) + Q.PRIOR_RIGHT + Q.PRIOR_WRONG))
        if k < rounds:
            p = 1 / (1 + np.exp(-(votes @ np.log(accuracy / (1 - accuracy)) + math.log(balance / (1 - balance)))))
    return accuracy


def test_given_table(spark):
    """Counts, failures and verdicts against plain Python over whole texts; quality against numpy's estimate."""
    rows = Q.op13_quality(spark, SF).collect()
    texts = dict(duck().execute("SELECT doc_id, text FROM documents").fetchall())
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    judged = Q.judge(Q.measure(table(spark, SF, "documents").select("doc_id", "text"))).select("doc_id", "votes").collect()
    votes = {r.doc_id: tuple(r.votes) for r in judged}
    rules = len(Q.default_rules())
    accuracy = plain_estimate(sorted(Counter(votes.values()).items()), rules)
    weight = np.log(accuracy / (1 - accuracy))
    for r in rows:
        want = counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        quality = 1 / (1 + math.exp(-float(np.array(votes[r.doc_id]) @ weight)))
        assert math.isclose(r.quality, quality, rel_tol=1e-9)
        assert (r.base_failed, r.kept) == (failed, not failed and quality >= Q.THRESHOLD)


def test_verdicts_agree_with_labels(spark):
    """Nobody shows it a label; of the documents that pass the base rules it tells the labelled ones apart."""
    sf = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in Q.op13_quality(spark, sf).collect()}
    labels = duck(sf).execute("SELECT doc_id, min(quality) FROM labels GROUP BY 1").fetchall()
    judged = [(found[i].kept, q == 1) for i, q in labels if i in found and not found[i].base_failed]
    assert len(judged) > 200
    assert np.mean([a == b for a, b in judged]) > 0.97
    assert np.mean([a for a, b in judged if b]) > 0.98


def test_estimate_finds_accuracies(spark):
    """Votes drawn with known accuracies: the estimate comes near them, and equals numpy's."""
    rnd, right, shown = random.Random(8), (0.95, 0.9, 0.8, 0.7, 0.85), (0.9, 0.7, 0.8, 0.6, 0.3)
    seen = Counter()
    for _ in range(20_000):
        good = rnd.random() < 0.6
        seen[tuple(0 if rnd.random() > s else (1 if (rnd.random() < a) == good else -1) for a, s in zip(right, shown))] += 1
    rows = sorted(seen.items())
    df = spark.createDataFrame([(list(v), n) for v, n in rows], "votes array<int>, n long")
    got = Q.estimate(df, 5).first().accuracy
    assert np.allclose(got, plain_estimate(rows, 5), rtol=1e-9)
    assert np.allclose(got, right, atol=0.03)
    assert Q.estimate(df.limit(0), 5).first().accuracy == [0.8] * 5


def test_odd_documents(spark, tmp_path):
    rnd = random.Random(6)
    texts = [None, "", " \t\n", "a b c a b c", "x\n x\nx\n\n\nx ", "#*$%&|<> <>", "a b \x1c c", "\U0001f600 é \x0b\x0c z", "w " * 70_000]
    texts += [" ".join(rnd.choice("abcd") for _ in range(rnd.randrange(60))) + "\n" * rnd.randrange(3) for _ in range(60)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(None, "same here")] * 3
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in docs], DOCS)
    got = Q.op13_quality(spark, write_tables(spark, tmp_path / "a", documents=df)).collect()
    key = lambda t: (t[0] is not None, *map(lambda x: x or 0, t))
    want = sorted(((i, *counts(t)) for i, t in docs), key=key)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got), key=key) == want
    clash = df.withColumns({"row": F.lit("r"), "words": F.lit(1), "votes": F.lit(2), "quality": F.lit(3), "n_words": F.lit(4), "a.b c": F.lit(5), "hashes": F.lit(6)})
    out = Q.judge(Q.measure(clash))
    assert out.columns == [*df.columns, "row", "words", "a.b c", "hashes", *Q.COUNTS, "votes", "quality", "good"]
    assert {(r.row, r.words, r["a.b c"], r.hashes) for r in out.collect()} == {("r", 1, 5, 6)}
    empty = Q.op13_quality(spark, write_tables(spark, tmp_path / "b"))
    assert empty.collect() == [] and empty.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def test_rules_are_a_parameter(spark):
    df = spark.createDataFrame([(1, 5), (2, -5), (3, None)], "id long, x int")
    rules = {"sign": (F.col("x") > 0, F.col("x") < 0), "size": (F.col("x") > 4, F.col("x") < -4)}
    got = {r.id: (list(r.votes), r.good) for r in Q.judge(df, rules).collect()}
    assert got == {1: ([1, 1], True), 2: ([-1, -1], False), 3: ([0, 0], True)}


def test_plan_has_no_python(spark):
    plan = Q.op13_quality(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
