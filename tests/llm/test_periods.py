import hashlib
import random
import zlib

import pyarrow as pa
from helpers import SF, same_as_sql, write_tables
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablesync.llm import periods as P

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def brute(words, min_words=6, min_periods=4):
    """Every period at every place, extended word by word; of a stretch's periods the smallest."""
    found = {}
    for p in range(1, len(words) // min_periods + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j > i and j + p - i >= max(min_words, min_periods * p):
                found.setdefault((i, j + p - i), p)
            i = max(j, i + 1)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def plant(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = plant(doc_id, (text or "").encode().split())
    runs = brute(words)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(((-n, s, p) for s, n, p in runs), default=None)
    best = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, hashlib.sha256(lines).hexdigest(), hashlib.sha256(kept).hexdigest())


def check(df, docs):
    assert df.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(repr, (tuple(r) for r in df.collect()))) == sorted(repr(expected(i, t)) for i, t in docs)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40), st.integers(0, 20), st.integers(1, 12), st.sampled_from([(6, 4), (2, 2), (4, 2), (9, 3)]))
def test_runs_of_short_texts(words, a, p, least):
    words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    words = [w if w is not None else 0 for w in words]
    assert P.runs_of(words, *least) == brute(words, *least)


def test_stretches_lose_no_run():
    """Whole texts against brute force, with runs at their ends and next to one another."""
    rnd = random.Random(2)
    texts = []
    for _ in range(300):
        words = []
        for _ in range(rnd.randrange(6)):
            root = [rnd.choice("abcdefgh") for _ in range(rnd.randrange(1, 9))]
            words += (root * rnd.randrange(1, 9))[: rnd.randrange(1, 60)]
            words += [f"w{rnd.randrange(400)}" for _ in range(rnd.randrange(30))]
        texts.append(" ".join(words))
    got = P._scan(pa.array([*texts, None, "", " \n"]), 6, 4).to_pylist()
    for text, r in zip([*texts, "", "", ""], got, strict=True):
        assert [(x["start"], x["length"], x["period"]) for x in r["runs"]] == brute(text.split())
        assert r["n_words"] == len(text.split())


def test_suffix_tree_against_sorting():
    rnd = random.Random(4)
    for _ in range(60):
        words = [rnd.randrange(3) for _ in range(rnd.randrange(1, 40))]
        n, tree = len(words), P.SuffixTree(words)
        for sign, rank in zip((1, -1), tree.ranks(), strict=True):
            order = sorted(range(n + 1), key=lambda i: [sign * w for w in words[i:]])
            assert [rank[i] for i in order] == list(range(n + 1))
        i, j = (P.np.array([rnd.randrange(n + 1) for _ in range(50)]) for _ in range(2))
        for a, b, got in zip(i.tolist(), j.tolist(), tree.lce(i, j).tolist(), strict=True):
            want = 0
            while max(a, b) + want < n and words[a + want] == words[b + want]:
                want += 1
            assert got == want


def test_given_table_in_sql(spark):
    assert same_as_sql(P.op12_periods(spark, SF), P.OP12_SQL)


def test_odd_documents(spark, tmp_path):
    rnd = random.Random(1)
    docs = [(None, "x y " * 9), (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "a b " * 7), (6, "a\x1cb " * 7), (7, "\n".join("ab" * 9))]
    docs += [(i, " ".join(f"w{rnd.randrange(9)}" for _ in range(rnd.randrange(90)))) for i in range(8, 200)]
    docs += [(500, "same words " * 8)] * 3 + [(501, "long " * 50_000), (502, " ".join(f"v{i % 1777}" for i in range(30_000)))]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], DOCS)
    clash = df.withColumns({"runs": F.lit(1), "collapsed": F.lit("x"), "row": F.lit("r"), "found": F.lit(2), "a b": F.lit(3), "x.y": F.lit(4)})
    kept = P.find_runs(clash)
    assert kept.columns == [*df.columns, "row", "found", "a b", "x.y", "n_words", "runs", "collapsed"]
    assert {(r.row, r.found, r["a b"], r["x.y"]) for r in kept.collect()} == {("r", 2, 3, 4)}
    short = [d for d in docs if d[0] not in (501, 502)]
    sf = write_tables(spark, tmp_path / "a", documents=df.where("doc_id IS NULL OR doc_id NOT IN (501, 502)"))
    check(P.op12_periods(spark, sf), short)
    long = {r.doc_id: [tuple(x) for x in r.runs] for r in P.find_runs(df.where("doc_id IN (501, 502)")).collect()}
    assert long == {501: [(0, 50_000, 1)], 502: [(0, 30_000, 1777)]}
    check(P.op12_periods(spark, write_tables(spark, tmp_path / "b")), [])
