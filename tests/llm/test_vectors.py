import numpy as np
from pyspark.sql import functions as F

from helpers import SF, classes, duck, write_tables
from tablesync.llm import forest, pivots

ROWS = "vec_id long, embedding array<float>, label int"


def given(sf=SF):
    return duck(sf).execute("SELECT vec_id, embedding, label FROM embeddings ORDER BY 1").fetchall()


def brute_nearest(rows, k, every):
    ids = np.array([r[0] for r in rows])
    v = np.array([r[1] for r in rows], np.float64)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        score = v @ v[i]
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[i]][:k]
        out[ids[i]] = [(ids[j], score[j]) for j in order]
    return out


def test_recall_and_scores(spark):
    sf = "/root/testdata/sf0.01"
    rows = given(sf)
    want = brute_nearest(rows, 20, 20)
    got = {}
    for r in forest.op8_forest(spark, sf).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(want)
    v = {r[0]: np.array(r[1], np.float64) for r in rows}
    hits = 0
    for q, found in got.items():
        assert [r for r, _, _ in found] == list(range(1, 21))
        assert all(abs(s - v[q] @ v[i]) < 1e-12 for _, i, s in found)
        assert found == sorted(found, key=lambda x: (-x[2], x[1]))
        hits += len({i for _, i, _ in found} & {i for i, _ in want[q]})
    assert hits >= 0.9 * 20 * len(want)


def test_all_rows_are_found_if_the_ascent_goes_to_the_top(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=8) * rng.uniform(0.2, 5)).astype("f4").tolist(), 0) for i in range(300)]
    df = spark.createDataFrame(rows, ROWS)
    got = forest.nearest_neighbours(df, F.col("vec_id") % 10 == 0, k=7, share=1e9, trees=3, shard_rows=64)
    found = {}
    for r in got.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    want = brute_nearest([(i, np.array(v, "f4"), 0) for i, v, _ in rows], 7, 10)
    assert found == {q: [i for i, _ in x] for q, x in want.items()}


def test_ties_go_to_the_smaller_ids(spark):
    rng = np.random.default_rng(7)
    v = np.unique(rng.integers(0, 2, size=(900, 12)), axis=0)
    v = rng.permutation(v[v.any(axis=1)])
    rows = [(i, x.astype("f4").tolist(), 0) for i, x in enumerate(v)]
    got = forest.nearest_neighbours(spark.createDataFrame(rows, ROWS), F.col("vec_id") % 10 == 0, k=5, share=1e9, trees=3)
    found = {}
    for r in got.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert found == {q: [i for i, _ in x] for q, x in brute_nearest(rows, 5, 10).items()}


def test_stretches_are_longest_prefixes():
    rng = np.random.default_rng(4)
    f = forest.Forest(rng.normal(size=(200, 6)), trees=4, bits=12)
    queries = rng.normal(size=(15, 6))
    strings = f._strings(np.column_stack([queries, np.zeros(15)]))
    for enough in (1, 7, 40, 200, 800, 5000):
        begin, end = f.stretches(queries, enough)
        for q in range(15):
            lengths = []
            for t in range(4):
                shared = [12 - int(s ^ strings[t, q]).bit_length() for s in f.sorted[t]]
                inside = shared[begin[t, q] : end[t, q]]
                outside = shared[: begin[t, q]] + shared[end[t, q] :]
                assert min(inside, default=13) > max(outside, default=-1) or not inside
                lengths.append(len(inside))
            assert sum(lengths) >= min(enough, 800)


def test_odd_vectors_of_the_search(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 0), (20, [1.0, 0.0], 0), (40, [2.0, 0.0], None), (1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (60, None, 0)]
    rows += [(80, [0.0, -0.0], 0), (100, [nan, 1.0], 0), (120, [inf, 1.0], 0), (140, [None, 1.0], 0), (None, [9.0, 9.0], 0), (160, [], 0)]
    rows += [(180, [1.0, 0.0, 0.0], 0), (3, [-1.0, 0.5], 0)]
    df = spark.createDataFrame(rows, ROWS).withColumns({"cls": F.lit(1), "rank": F.lit("x")})
    got = {}
    for r in forest.nearest_neighbours(df, F.col("vec_id") % 20 == 0, k=3).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == {0: [(40, 2.0), (1, 1.0), (20, 1.0)], 20: [(40, 2.0), (0, 1.0), (1, 1.0)], 40: [(0, 2.0), (1, 2.0), (20, 2.0)]}
    assert forest.op8_forest(spark, write_tables(spark, tmp_path)).count() == 0


def brute_links(rows, similarity):
    ids, links = [r[0] for r in rows], []
    for i, (_, v, a) in enumerate(rows):
        for j in range(i):
            w, b = rows[j][1], rows[j][2]
            if a is not None and a == b and len(v) == len(w):
                x, y = np.array(v, "f4").astype(float), np.array(w, "f4").astype(float)
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= similarity:
                    links.append((i, j))
    root = classes(links, range(len(rows)))
    least = {}
    for i, r in root.items():
        least[r] = min(ids[i], least.get(r, ids[i]))
    degree = [0] * len(rows)
    for i, j in links:
        degree[i] += 1
        degree[j] += 1
    return sorted((ids[i], degree[i], least[root[i]], least[root[i]] == ids[i]) for i in range(len(rows)))


def clusters(n, each, noise, seed=1, dim=16):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        x = rng.normal(size=dim)
        for _ in range(each):
            rows.append((len(rows), (x + noise * rng.normal(size=dim)).astype("f4").tolist(), int(rng.integers(0, 2))))
    return rows


def test_links_against_brute_force(spark, monkeypatch):
    rows = clusters(30, 12, 0.15)
    for i in range(100):  # one hot vector, and copies of it under other ids
        rows.append((1000 + i, rows[0][1], 0))
    for block in (2048, 16):
        monkeypatch.setattr(pivots, "BLOCK_ROWS", block)
        got = pivots.near_vectors(spark.createDataFrame(rows, ROWS), entered_in=12, shared=1)
        assert sorted(map(tuple, got.collect())) == brute_links(rows, 0.93)


def test_recall_of_the_lists(spark):
    rows = clusters(150, 6, 0.25, dim=64)
    want = brute_links(rows, 0.93)
    got = sorted(map(tuple, pivots.near_vectors(spark.createDataFrame(rows, ROWS)).collect()))
    assert sum(r[1] for r in got) >= 0.97 * sum(r[1] for r in want) > 0
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))


def test_a_third_of_the_vectors_in_one_dense_group(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(1500, 64))
    v[:500] = v[0] + 0.25 * rng.normal(size=(500, 64))
    v = v.astype("f4")
    unit = v.astype(float) / np.linalg.norm(v.astype(float), axis=1)[:, None]
    want = (unit @ unit.T >= 0.93).sum(axis=1) - 1
    rows = [(i, x.tolist(), 0) for i, x in enumerate(v)]
    links = {r.vec_id: r.n_links for r in pivots.near_vectors(spark.createDataFrame(rows, ROWS)).collect()}
    got = np.array([links[i] for i in range(1500)])
    assert (got <= want).all() and got.sum() >= 0.99 * want.sum() > 0


def test_pivots_follow_the_rows(spark):
    """More reference points make shorter lists and lose no more links."""
    assert [pivots.pivots_for(n) for n in (0, 1, 1000, 4096, 1 << 16, 1 << 18, 10**12)] == [128, 128, 128, 256, 1024, 2048, 2048]
    rng = np.random.default_rng(6)
    v = rng.normal(size=(3000, 64))
    v[1500:] = v[:1500] + 0.36 * rng.normal(size=(1500, 64))  # cosines around the threshold
    v = v.astype("f4")
    unit = v.astype(float) / np.linalg.norm(v.astype(float), axis=1)[:, None]
    want = (unit @ unit.T >= 0.93).sum(axis=1) - 1
    df = spark.createDataFrame([(i, x.tolist(), 0) for i, x in enumerate(v)], ROWS).cache()
    for count in (512, 2048):
        links = {r.vec_id: r.n_links for r in pivots.near_vectors(df, pivots=count).collect()}
        got = np.array([links[i] for i in range(3000)])
        assert (got <= want).all() and got.sum() >= 0.98 * want.sum() > 500
    df.unpersist()


def test_whole_table(spark):
    got = sorted(map(tuple, pivots.op10_pivots(spark, SF).collect()))
    assert got == brute_links(given(), 0.93)


def test_odd_vectors_of_the_links(spark, tmp_path):
    nan = float("nan")
    rows = [(5, [1.0, 0.0], 1), (4, [2.0, 0.0], 1), (4, [2.0, 0.0], 1), (6, [1.0, 0.0], None), (7, [nan, 0.0], 1), (8, [0.0, 0.0], 1)]
    rows += [(9, None, 1), (10, [1.0, 0.0], 2), (None, [3.0, 0.1], 1), (11, [], 1), (12, [None, 1.0], 1), (13, [1.0, 0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, ROWS).withColumns({"node": F.lit(1), "copies": F.lit("x"), "links": F.lit(3)})
    got = sorted(map(str, map(tuple, pivots.near_vectors(df).collect())))
    alone = [(i, 0, i, True) for i in (6, 7, 8, 9, 10, 11, 12, 13)]
    assert got == sorted(map(str, [(5, 3, 4, False), (4, 3, 4, True), (4, 3, 4, True), (None, 3, 4, False), *alone]))
    assert pivots.op10_pivots(spark, write_tables(spark, tmp_path)).count() == 0
