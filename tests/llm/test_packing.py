import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helpers import DOCS, SF, duck, write_tables
from tablesync.llm import packing

FILE = open(packing.public_vocabulary(), encoding="utf-8").read()
PLAIN = Tokenizer.from_str(FILE)
ENCODER = packing.Encoder(FILE)


def ids(text):
    return [*PLAIN.encode(text or "", add_special_tokens=False).ids, 1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=12) | st.sampled_from(["don't", "İ", "Σας", "e\u0301té", "a,b", "<|endoftext|>", "x'LL", "½", "ǅ", "naïve.,", "12a"]), max_size=8))
def test_encoder_equals_the_tokenizer(words):
    text = " ".join(words)
    assert np.frombuffer(ENCODER.encode([text])[0], "<u4").tolist() == PLAIN.encode(text, add_special_tokens=False).ids


def test_every_letter_before_a_mark():
    """All code points below U+30000 as a word, alone, behind a letter and before marks; the tokenizer is the file's, untouched."""
    for words in (lambda c: c, lambda c: c + ".", lambda c: "A" + c + ",."):
        texts = [words(chr(c)) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
        want = [x.ids for x in PLAIN.encode_batch_fast(texts, add_special_tokens=False)]
        encoder = packing.Encoder(FILE)
        got = [x for k in range(0, len(texts), 4096) for x in encoder.encode(texts[k : k + 4096])]
        assert [t for t, g, w in zip(texts, got, want, strict=True) if np.frombuffer(g, "<u4").tolist() != w] == []


def test_special_tokens():
    for text in ("hello <|endoftext|> world", "a<|endoftext|>b", "<|startoftext|>. TARİHİ. <|endoftext|>,", "<|endoftext|"):
        assert np.frombuffer(ENCODER.encode([text])[0], "<u4").tolist() == PLAIN.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ENCODER.encode(["hello <|endoftext|> world"])[0], "<u4").tolist() == [3306, 49407, 1002]
    plain = Tokenizer.from_str(FILE)
    plain.encode_special_tokens = True
    as_text = packing.Encoder(FILE, special_as_text=True).encode(["hello <|endoftext|> world"])[0]
    assert np.frombuffer(as_text, "<u4").tolist() == plain.encode("hello <|endoftext|> world", add_special_tokens=False).ids


def test_full_tables_become_old_ones(monkeypatch):
    monkeypatch.setattr(packing, "MAX_STRINGS", 3)
    monkeypatch.setattr(packing, "MAX_WORDS", 3)
    encoder = packing.Encoder(FILE)
    for texts in (["nine a b", "", "c\x1cd", "b"], ["a c", "é, é"], ["b"], ["nine c, d"]):
        want = [PLAIN.encode(t, add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want
    for text in ("one two three four five", "six, seven one two", "five four. one", "nine ten one", "six, a b c one", "d e f, two"):
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == PLAIN.encode(text, add_special_tokens=False).ids


def brute_first_fit(sizes, capacity):
    room, out = [], [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        for b, r in enumerate(room):
            if r >= sizes[k]:
                break
        else:
            b = len(room)
            room.append(capacity)
        room[b] -= sizes[k]
        out[k] = b
    return out


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=60))
def test_tournament_tree_is_first_fit_decreasing(sizes):
    assert packing.first_fit_decreasing(np.array(sizes), 20).tolist() == brute_first_fit(sizes, 20)


def check(rows, texts, length=2048):
    """Every id in exactly one piece, sequences without gaps."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    for doc_id, pieces in docs.items():
        want = sorted(
            (s, len(x), zlib.crc32(np.array(x, "<u4").tobytes()), len(t))
            for t in map(ids, texts[doc_id])
            for s in range(0, len(t), length)
            for x in [t[s : s + length]]
        )
        assert sorted(pieces) == want
    assert set(docs) == set(texts)
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    return sequences


def test_whole_table(spark):
    texts = defaultdict(list)
    for i, t in duck().execute("SELECT doc_id, text FROM documents").fetchall():
        texts[i].append(t)
    sequences = check(packing.op3_packing(spark, SF).collect(), texts)
    tokens = sum(size for parts in sequences.values() for _, size in parts)
    assert tokens > 0.98 * 2048 * len(sequences)


def test_odd_rows(spark):
    rows = [(None, "null id", None, None, 0), ((1 << 60) + 1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "same text", "en", "s", 0)]
    rows += [(3, "same text", "en", "s", 0), (4, "word, " * 40_000, "en", "s", 0), (5, "x" * 30_000, "en", "s", 0)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({"row": F.lit(1), "start": F.lit("x"), "group": F.lit(2)})
    texts = defaultdict(list)
    for r in rows:
        texts[r[0]].append(r[1])
    check(packing.pack(docs, packing.public_vocabulary()).collect(), texts)
    few = packing.pack(docs, packing.public_vocabulary(), length=64, group_docs=2, with_ids=True).collect()
    check(few, texts, length=64)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length for r in few)


def test_few_rows_at_a_time(spark, monkeypatch):
    """A worker gets 256 rows at most, whatever the session's batches are; these stay as they are."""
    cut, key = packing._cut, "spark.sql.execution.arrow.maxRecordsPerBatch"

    def checked(*args):
        run = cut(*args)

        def few(batches):
            for batch in batches:
                assert len(batch) <= 256
                yield batch

        return lambda batches: run(few(batches))

    monkeypatch.setattr(packing, "_cut", checked)
    before = spark.conf.get(key)
    docs = spark.range(1000).selectExpr("id AS doc_id", "concat('text ', id) AS text").repartition(1)
    packed = packing.pack(docs, packing.public_vocabulary())
    assert packed.count() == 1000 and packed.sparkSession is docs.sparkSession and spark.conf.get(key) == before


def test_empty_table(spark, tmp_path):
    assert packing.op3_packing(spark, write_tables(spark, tmp_path)).count() == 0
