import zlib
from collections import Counter

import corpus_pipeline as cp
from helpers import DOCS, SF, duck, write_tables
from tablesync.llm import simhash
from tablesync.llm.common import saved, table
from test_linededup import brute as brute_lines
from test_mixing import targets
from test_packing import check
from test_simhash import brute_classes, brute_print


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    names, out = docs.columns, {}
    for name, stage in cp.STAGES:
        docs = saved(stage(spark, docs, SF), "test-stage")
        out[name] = docs
        if name != "packing":
            assert docs.columns == names
    given = duck().execute("SELECT doc_id, text, source FROM documents ORDER BY doc_id").fetchall()
    first = {r.doc_id: r.text for r in out["language_id"].collect()}
    assert first == {i: t for i, t, _ in given if t and any(map(str.isalpha, t))}
    ids = sorted(first)
    lines = dict(zip(ids, brute_lines([first[i] for i in ids], 10, 1), strict=True))
    assert {r.doc_id: r.text for r in out["line_dedup"].collect()} == lines
    assert all(r.n_chars == len(r.text) for r in out["line_dedup"].collect())
    prints = {i: brute_print(t) for i, t in lines.items()}
    root = brute_classes(sorted(set(prints.values())), 4)
    least = {}
    for i in ids:
        least.setdefault(root[prints[i]], i)
    kept = {r.doc_id: r for r in out["simhash_dedup"].collect()}
    assert set(kept) == set(least.values())
    size, taken = Counter(), Counter()
    for r in kept.values():
        size[r.source] += len(r.text.split())
    for r in out["mixing"].collect():
        taken[r.source] += len(r.text.split())
        assert r.text == kept[r.doc_id].text or r.text.split() == kept[r.doc_id].text.split()[: len(r.text.split())]
    want = targets(dict(size))
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    texts = {}
    for r in out["mixing"].collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    check(out["packing"].collect(), texts)


def test_run_gives_the_stages_rows(spark):
    rows = cp.run(spark, SF)
    assert rows.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert rows.count() > 0


def test_odd_and_empty_documents(spark, tmp_path):
    docs = [(None, "some words for a document here", None, None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "99 !", "en", "s", 4)]
    docs += [(4, "the same text again and again", "en", "s", 1)] * 2 + [(5, "the same text again and again", "en", "t", 1)]
    sf = write_tables(spark, tmp_path / "a", documents=spark.createDataFrame(docs, DOCS))
    first = cp.language_id(spark, table(spark, sf, "documents"), sf).collect()
    assert Counter((r.doc_id, r.text) for r in first) == Counter((i, t) for i, t, *_ in docs if i not in (1, 2, 3))
    # Of the copies the smallest doc_id stays, null before it; the other text is a document of its own.
    alone = simhash.drop_near_duplicates(table(spark, sf, "documents").where("doc_id IS NULL OR doc_id > 3"), words=4, distance=4)
    assert {r.doc_id for r in cp.run(spark, sf).collect()} == {r.doc_id for r in alone.collect()}
    assert cp.run(spark, write_tables(spark, tmp_path / "b")).count() == 0


def test_documents_without_any_label_stay(spark, tmp_path):
    docs = [(i, f"document{i} has words{i} and letters{i} of its{i} own{i}", None, "s", 0) for i in range(20)]
    docs += [(20, None, None, "s", 0), (21, "", None, "s", 0), (22, "99 !", None, "s", 0), (None, "日本 words", None, "s", 0)]
    sf = write_tables(spark, tmp_path, documents=spark.createDataFrame(docs, DOCS))
    first = cp.language_id(spark, table(spark, sf, "documents"), sf)
    assert first.columns == table(spark, sf, "documents").columns
    assert {r.doc_id for r in first.collect()} == {*range(20), None}
    assert {r.doc_id for r in cp.run(spark, sf).collect()} == {*range(20), None}


def test_language_stage_uses_its_prediction(spark, tmp_path):
    """A null label is filled, a contradicted one corrected, every other document keeps its own; nothing with letters goes."""
    given = [tuple(r) for r in table(spark, SF, "documents").select(*[c.split()[0] for c in DOCS.split(", ")]).collect()]
    # Held out, so no wrong label is learnt from.
    known = [g for g in given if g[1] and g[2] and len(g[1].split()) >= 80 and zlib.crc32(str(g[0]).encode()) % 5 == 0]
    changed = {g[0]: None if k % 2 else next(x for x in ("en", "fr", "de", "es") if x != g[2]) for k, g in enumerate(known)}
    rows = [(*g[:2], changed.get(g[0], g[2]), *g[3:]) for g in given] + [(-1, "4711 !", "en", "s", 6), (-2, None, None, "s", 0)]
    sf = write_tables(spark, tmp_path, documents=spark.createDataFrame(rows, DOCS))
    out = cp.language_id(spark, table(spark, sf, "documents"), sf)
    assert out.columns == table(spark, sf, "documents").columns
    after = {r.doc_id: r.lang for r in out.collect()}
    assert sorted(after) == sorted(g[0] for g in given if g[1] and any(map(str.isalpha, g[1])))
    right = {g[0]: g[2] for g in given}
    assert len(changed) > 10 and sum(after[i] == right[i] for i in changed) >= 0.9 * len(changed)
    assert sum(after[i] != right[i] for i in after if right[i] and i not in changed) <= 0.02 * len(after)
