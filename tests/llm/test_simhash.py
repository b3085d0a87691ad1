import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from helpers import DOCS, SF, classes, duck, write_tables
from tablesync.llm import simhash
from tablesync.llm.common import components


def brute_print(text, words=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(found[i : i + words]) for i in range(len(found) - words + 1)] or [" ".join(found)] * bool(found)
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints, distance):
    links = [(a, b) for i, a in enumerate(prints) for b in prints[:i] if (a ^ b).bit_count() <= distance]
    return classes(links, prints)


def test_whole_table(spark):
    docs = duck().execute("SELECT doc_id, text FROM documents").fetchall()
    prints = {i: brute_print(t) for i, t in docs}
    root = brute_classes(sorted(set(prints.values())), 4)
    least = {}
    for i, p in prints.items():
        least[root[p]] = min(i, least.get(root[p], i))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op5_simhash(spark, SF).collect()}
    assert got == {i: (f"{p:016x}", least[root[p]]) for i, p in prints.items()}


def test_spark_hash_of_a_shingle_is_the_same(spark):
    text = "É words here okay"
    one = spark.createDataFrame([(text,)], "t string").select(F.xxhash64("t")).first()[0] % (1 << 64)
    assert one == xxhash.xxh64_intdigest(text.encode(), 42)


@pytest.mark.parametrize(("distance", "cell_rows"), [(4, 4096), (4, 8), (3, 50), (1, 4096), (0, 16)])
def test_links_against_brute_force(spark, monkeypatch, distance, cell_rows):
    monkeypatch.setattr(simhash, "CELL_ROWS", cell_rows)  # small blocks: a hot cell is cut
    rng = random.Random(distance)
    prints = {0, 1, (1 << 64) - 1, 1 << 63}
    for _ in range(20):
        p = rng.getrandbits(64)
        for _ in range(30):  # a cluster around p, and chains leading away from it
            prints.add(p)
            for b in rng.sample(range(64), rng.randint(1, 5)):
                p ^= 1 << b
    prints |= {0xABCD << 20 | x for x in range(200)}  # all in a few cells
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.near_links(spark.createDataFrame([(p,) for p in signed], "fp long"), distance)
    got = classes([(r.a, r.b) for r in links.collect()], signed)
    want = classes(
        [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) % (1 << 64)).bit_count() <= distance], signed
    )
    assert got == want
    assert links.count() < 15 * len(prints)


def test_components_of_long_chains_and_stars(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, i) for i in range(1001, 1400)] + [(5000, 5000), (7, 3)]
    edges += [(rng.randrange(6000, 6400), rng.randrange(6000, 6400)) for _ in range(300)]
    rng.shuffle(edges)
    nodes = {n for e in edges for n in e}
    want = classes(edges, nodes)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: r for n, r in want.items() if n != 5000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_odd_rows(spark):
    words = " ".join(f"w{i}" for i in range(50_000))
    rows = [(9, None, "en", "s", 0), (3, "", "en", "s", 0), (None, " \t\n", "en", "s", 0), (4, "A b", "en", "s", 0), (4, "A b", "en", "s", 0)]
    rows += [(5, "a\x0bB", "en", "s", 0), (6, words, "en", "s", 0), (8, words.upper() + " \n", "en", "s", 0), (None, "lonely one here now", "x", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"fp": F.lit(1), "component": F.lit("x"), "root": F.lit(2)})
    got = simhash.near_duplicates(docs, 4, 4).collect()
    assert len(got) == len(rows)
    found = sorted((str(r.doc_id), str(r.component_id)) for r in got)
    assert found == sorted((i, str(c)) for i, c in [("9", 3), ("3", 3), ("None", 3), ("4", 4), ("4", 4), ("5", 4), ("6", 6), ("8", 6), ("None", None)])
    kept = simhash.drop_near_duplicates(docs, 4, 4)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted([("3", ""), ("4", "A b"), ("6", words), ("None", "lonely one here now")])


def test_grid_lower_bound():
    rng = np.random.default_rng(1)
    low = simhash._LOW_BITS
    for a, b in rng.integers(0, 1 << 63, (500, 2)).tolist():
        x, y = (((v & v >> 1 & low) << 1) | ((v ^ v >> 1) & low) for v in (a, b))
        gap = sum(abs((x >> s & 3) - (y >> s & 3)) for s in range(0, 64, 2))
        z = x ^ y
        assert gap == (z & low).bit_count() + 2 * (z >> 1 & ~z & low).bit_count() <= (a ^ b).bit_count()


def test_empty_table(spark, tmp_path):
    assert simhash.op5_simhash(spark, write_tables(spark, tmp_path)).count() == 0
