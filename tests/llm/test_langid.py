import tracemalloc
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
import pytest
from pyspark.sql import functions as F

from helpers import DOCS, write_tables
from tablesync.llm import langid

MODEL = [("aa", "the cat sat on the mat. The dog!"), ("bb", "der hund und die katze, él ü"), ("cc", "zz top")]
PARSER = langid.Parser(MODEL)


def letters(text):
    out = ""
    for c in text:
        c = (c.lower() if len(c.lower()) == 1 else c) if c.isalpha() else " "
        if c != " " or not out.endswith(" "):
            out += c
    return out


def brute(train, text, segment):
    """Phrases by substring search."""
    train, text, n = letters(train), letters(text), 0
    for a in range(0, len(text), segment):
        part, i = text[a : a + segment], 0
        while i < len(part):
            j = i
            while j < len(part) and part[i : j + 1] in train:
                j += 1
            if j < len(part) and part[j] not in train:
                j += 1
            n, i = n + 1, j
    return n


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="thecatdogsunz é.ÜXñ!\n", max_size=80), min_size=1, max_size=6))
def test_parse_equals_substring_search(texts):
    got = PARSER.phrases(texts)
    assert got.tolist() == [[brute(t, x, langid.SEGMENT) for _, t in MODEL] for x in texts]


def test_segments_and_batches(monkeypatch):
    monkeypatch.setattr(langid, "SEGMENT", 7)
    monkeypatch.setattr(langid, "LANES", 3)
    texts = ["the cat sat on the dog " * 9, "", "der hund", "q" * 50]
    # A text is read in stretches of SEGMENT * LANES characters, each folded on its own.
    want = [[sum(brute(t, x[a : a + 21], 7) for a in range(0, len(x), 21)) for _, t in MODEL] for x in texts]
    assert PARSER.phrases(texts).tolist() == want


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    rows = langid.op9_language_id(spark, sf).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    test = [r for r in rows if r.held_out and lang[r.doc_id] is not None]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in test]) > 0.97


def test_odd_rows(spark, tmp_path):
    rows = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "123 !?", "en", "s", 0), (None, "the cat the dog", None, "s", 0)]
    rows += [(5, "the mat " * 100_000, "de", "s", 0), (5, "the mat " * 100_000, "de", "s", 0), (6, "日本", "en", "s", 0), (7, "und die", None, None, 0)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"score": F.lit("x"), "_found": F.lit(1), "found": F.lit(2), "row": F.lit(3), "a b.c": F.lit(4)})
    out = langid.identify(docs, MODEL)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "_found", "found", "row", "a b.c", "lang_pred", "score"]
    assert {(r["_found"], r["found"], r["row"], r["a b.c"]) for r in out.collect()} == {(1, 2, 3, 4)}
    got = sorted((str(r.doc_id), r.lang_pred) for r in out.collect())
    assert [g for g in got if g[0] != "6"] == sorted(
        [("1", "und"), ("2", "und"), ("3", "und"), ("None", "aa"), ("5", "aa"), ("5", "aa"), ("7", "bb")]
    )
    assert {r.lang_pred for r in langid.identify(docs, []).collect()} == {"und"}
    one = langid.identify(docs, MODEL[:1]).where("doc_id = 7").first()
    assert (one.lang_pred, one.score) == ("aa", 1.0)
    assert langid.op9_language_id(spark, write_tables(spark, tmp_path)).count() == 0


def test_only_other_rows_are_learnt_from(spark):
    rows = [(i, f"secret{i} words", "en" if i % 2 else None, "s", 0) for i in range(60)] + [(None, "null id", "fr", "s", 0)]
    model = dict(langid.learn(spark.createDataFrame(rows, DOCS)))
    assert set(model) == {"en", "fr"}
    for i in range(60):
        assert (f"secret{i} " in model["en"]) == (i % 2 == 1 and zlib.crc32(str(i).encode()) % 5 != 0)
    small = langid.learn(spark.createDataFrame(rows, DOCS), rows_per_language=3, windows=1, window_chars=4)
    assert all(len(t) <= 3 * 4 + 2 for _, t in small)


def test_copies_take_one_place_of_the_sample(spark):
    texts = spark.createDataFrame([(f"word{i} of text{i}",) for i in range(200)], "text string")
    hashed = [r.text for r in texts.orderBy(F.xxhash64("text")).collect()]
    rows = [("en", t) for t in hashed] + [("en", hashed[0])] * 500 + [("de", hashed[3])] * 70 + [("de", "eins")]
    model = dict(langid.training_text(spark.createDataFrame(rows, "lang string, text string")))
    assert model["en"] == " ".join(hashed[:64])
    assert sorted(model["de"].split()) == sorted(f"{hashed[3]} eins".split())


def test_memory_follows_the_text_whatever_the_alphabet():
    rng = np.random.default_rng(3)
    wide = "".join(map(chr, rng.integers(0x4E00, 0x4E00 + 3300, 6000)))
    model = [("zh", wide)] + [(f"l{k}", "".join(rng.choice(list("abcdefgh "), 6000))) for k in range(4)]
    tracemalloc.start()
    parser = langid.Parser(model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6
    texts = [wide[70:300] + "abc", model[2][1][:400], "abba 日本 cab", wide[9:40:3], "xyz"]
    assert parser.phrases(texts).tolist() == [[brute(t, x, langid.SEGMENT) for _, t in model] for x in texts]


def test_windows_reach_over_whole_texts(spark):
    long = "begin " + "x " * 5000 + "middle " + "x " * 5000 + "end"
    rows = spark.createDataFrame([("en", long), ("de", "kurz")], "lang string, text string")
    model = dict(langid.training_text(rows, windows=3, window_chars=9))
    assert model["en"].startswith("begin ") and "middle" in model["en"] and model["en"].endswith("end") and len(model["en"]) == 3 * 9 + 2
    assert model["de"] == "kurz"


def test_too_many_languages_are_an_error(spark):
    rows = spark.range(100_000).select(F.concat(F.lit("l"), "id").alias("lang"), F.lit("some text").alias("text"))
    with pytest.raises(ValueError, match="more than 256"):
        langid.training_text(rows)
    assert len(langid.training_text(rows.where("id < 256"))) == 256
