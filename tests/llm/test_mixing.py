import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import DOCS, SF, duck
from tablesync.llm import mixing


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Water-filling by rounds, as the contract words it."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(w[s] for s in open_)
        full = [s for s in open_ if left * w[s] / total > most * sizes[s] or sizes[s] == 0]
        if not full:
            out |= {s: left * w[s] / total for s in open_}
            break
        for s in full:
            out[s] = most * sizes[s]
            open_.discard(s)
        left -= sum(out[s] for s in full)
    return out


def check(rows, sizes_of=None):
    size = defaultdict(int)
    by = defaultdict(int)
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size
        by[r.source_size, round(r.target, 6)] += r.taken
    return by


def test_targets_and_taken_on_the_given_table(spark):
    rows = mixing.op1_mixing(spark, SF).collect()
    docs = duck().execute("SELECT doc_id, source, text FROM documents").fetchall()
    size = {i: len((t or "").replace("\x0b", " ").split()) for i, _, t in docs}
    source = {i: s for i, s, _ in docs}
    total = Counter()
    for i, s in source.items():
        total[s] += size[i]
    want = targets(dict(total))
    taken = Counter()
    for r in rows:
        assert r.source_size == total[source[r.doc_id]]
        assert math.isclose(r.target, want[source[r.doc_id]], rel_tol=1e-9)
        assert 0 <= r.taken <= 2 * r["size"]
        taken[source[r.doc_id]] += r.taken
    assert len(rows) == len(docs)
    assert all(taken[s] == math.floor(want[s] + 0.5) for s in want)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.op1_mixing(spark, SF).collect()))


def test_odd_rows(spark, tmp_path):
    rows = [(1, "a b c", "en", None, 1), (1, "a b c", "en", None, 1), (None, "x " * 5000, None, "s", 2), (3, None, "en", "s", 0)]
    rows += [(4, "", "en", "empty", 0), (5, "one", "en", "é", 3), (6, "two words", "en", "Z", 3)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"shard": F.lit("x"), "row": F.lit(0), "take": F.lit(1)})
    sized = docs.withColumn("size", mixing.word_count("text"))
    drawn = mixing.draw(sized, [3, 1, 2]).collect()
    assert len(drawn) == 2 * len(rows)
    taken, size = Counter(), Counter()
    for r in drawn:
        taken[r.source] += r["take"]
        assert (r.shard is None) == (r["take"] == 0)
    want = targets({None: 6, "s": 5000, "empty": 0, "é": 1, "Z": 2})
    assert {s: taken[s] for s in want} == {s: math.floor(x + 0.5) for s, x in want.items()}
    mixed = mixing.mix(docs, [3, 1, 2])
    assert mixed.columns == [*[c for c in docs.columns if c != "shard"], "shard", "position"]
    words = Counter()
    for r in mixed.collect():
        words[r.source] += len(r.text.split())
    assert {s: n for s, n in words.items()} == {s: n for s, n in taken.items() if n}
    none = spark.createDataFrame([], DOCS)
    assert mixing.mix(none, [3, 1, 2]).count() == 0


def test_shards_hold_every_source_in_proportion_and_each_block_once(spark):
    sources = spark.createDataFrame([(0, 4000), (1, 1000), (2, 0), (3, 37)], "rank int, blocks long")
    parts = mixing.splitting_tree(sources, 16, seed=3).collect()
    for rank, blocks in ((0, 4000), (1, 1000), (2, 0), (3, 37)):
        mine = sorted((r["first"], r["count"]) for r in parts if r["rank"] == rank)
        assert len(mine) == 16 and sum(c for _, c in mine) == blocks
        at = 0
        for first, count in mine:
            assert first == at and count >= 0
            at += count
    shard = Counter()
    for r in parts:
        shard[r["shard"]] += r["count"]
    assert max(shard.values()) - min(shard.values()) <= 1
    assert all(abs(r["count"] - 250) < 60 for r in parts if r["rank"] == 0)


def test_draws_follow_the_hypergeometric_distribution(spark):
    n, good, drawn, trials = 60, 25, 20, 4000
    got = spark.range(trials).select(mixing.hypergeometric(F.lit(good), F.lit(n), F.lit(drawn), F.rand(5)).alias("x"))
    found = {r["x"]: r["count"] for r in got.groupBy("x").count().collect()}
    for k in range(3, 15):
        p = math.comb(good, k) * math.comb(n - good, drawn - k) / math.comb(n, drawn)
        assert abs(found.get(k, 0) / trials - p) < 0.03


@pytest.mark.parametrize("n", [1, 2, 37, 1000])
def test_permutation(spark, n):
    got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(9)).alias("p")).collect()
    assert sorted(r.p for r in got) == list(range(n))


def test_large_draws_keep_to_the_mean(spark):
    x = mixing.hypergeometric(F.lit(10**7), F.lit(3 * 10**7), F.lit(10**7), F.rand(2))
    mean = spark.range(20).select(x.alias("x")).agg(F.avg("x")).first()[0]
    assert abs(mean - 10**7 / 3) < 3000


def test_user_columns_stay_and_order_does_not_matter(spark):
    """Rows of equal doc_id and size but other text, in three orders; columns named like the operator's own."""
    rows = [(k % 4, " ".join(f"t{k}w{i}" for i in range(30)), "en", "s" if k % 3 else None, k) for k in range(60)]
    clash = {"size": F.col("n_chars") + 100, "_text": F.lit("keep"), "_key": F.lit(1), "_hash": F.lit("h"), "text_hash": F.lit(2), "given": F.lit(3), "doc": F.lit(4), "a b.c": F.lit(5)}
    found = []
    for seed in (None, 1, 2):
        docs = spark.createDataFrame(rows, DOCS).withColumns(clash)
        docs = docs if seed is None else docs.orderBy(F.rand(seed)).repartition(1 + seed)
        mixed = mixing.mix(docs, [3, 1, 2])
        assert mixed.columns == [*docs.columns, "shard", "position"]
        got = mixed.collect()
        assert all(r["size"] == r.n_chars + 100 and (r["_text"], r["_key"], r["_hash"], r.text_hash, r.given, r.doc, r["a b.c"]) == ("keep", 1, "h", 2, 3, 4, 5) for r in got)
        found.append(sorted((r.doc_id, r.source or "", r.text, r.shard, r.position) for r in got))
    assert found[0] == found[1] == found[2] and len(found[0]) > 20
    sized = spark.createDataFrame(rows, DOCS).withColumns({"size": mixing.word_count("text"), "_x": F.lit(1)})
    assert mixing.draw(sized, [3, 1, 2]).columns == [*sized.columns, "source_size", "target", "row", "copy", "take", "shard"]
