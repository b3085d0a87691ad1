"""Packing: documents' tokens into sequences of one length, first-fit decreasing.

A document's ids, closed by an end id, are cut at multiples of the sequence length; the
pieces are dealt out to randomised groups, and each group is packed on its own: longest
piece first, into the first sequence that has room. A tournament tree over the sequences'
free room finds that sequence in a logarithm of their number.

The tokenizer is a public vocabulary file, which reaches the workers as a broadcast (its
size is a property of the file, not of the data). White-space separated strings are
encoded once per worker and looked up from then on.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.session import in_session, small_batches_session

from .common import saved, scattered, table, worker_keeps

LENGTH = 2048
END_ID = 1
#: Documents in a group, on average, and the largest file taken for a vocabulary.
GROUP_DOCS = 4096
MAX_VOCABULARY_BYTES = 64 << 20
#: Entries that a worker keeps, in two generations: a full young table becomes the old one.
MAX_STRINGS, MAX_WORDS = 160_000, 300_000

#: Rows that a worker gets, and encodes, at a time.
BATCH_ROWS = 256

#: Marks that pre-tokenisation takes as one further piece behind a word's letters.
MARKS = ".,;:!?$%&#*"
#: White space to Python but not to the tokenizer's pattern.
_SEPARATORS = re.compile("[\x1c-\x1f]")


# ------------------------------------------------------------------------------- tokenizer
class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers, equal to the tokenizer's own.

    For tokenizers that drop white space, never join across it, and end a word with a
    marked token, as ``word_bpe_49k.json`` does. The string of a special token in a text is
    that token, as the tokenizer has it, or ordinary text if ``special_as_text``.
    """

    def __init__(self, file: str, special_as_text: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(file)
        self.tokenizer.encode_special_tokens = special_as_text
        vocabulary = self.tokenizer.get_vocab()
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Strings that may hold an added token, or be cut by one, go to the tokenizer as they are.
        self.whole_only = any(any(map(str.isspace, t)) for t in added)
        self.added = [t for t in added if all(c.isalpha() or c in MARKS for c in t)]
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.strings: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.old_strings: dict[str, bytes] = {}
        self.old_words: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.strings) > MAX_STRINGS:
            self.old_strings, self.strings = self.strings, {}
        known, lists = self.strings, [None if self.whole_only or _SEPARATORS.search(t) else t.split() for t in texts]
        self._learn({s for strings in lists if strings for s in strings if s not in known})
        ids = known.__getitem__
        return [self._whole([t])[0] if strings is None else b"".join(map(ids, strings)) for t, strings in zip(texts, lists, strict=True)]

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _learn(self, strings: set[str]) -> None:
        if len(self.words) > MAX_WORDS:
            self.old_words, self.words = self.words, {}
        known, old, words = self.strings, self.old_strings, self.words
        other, new, plain, lower, marks = [], {}, [], [], []
        for s in strings:
            if s in old:
                known[s] = old[s]
                continue
            letters = s.rstrip(MARKS)
            mark, low = s[len(letters) :], letters.lower()
            # Lower case may bring a combining mark, which a mark behind the word would join.
            simple = letters.isascii() or "Σ" not in letters and low.isalpha() and unicodedata.is_normalized("NFC", letters)
            if letters.isalpha() and simple and not any(t in s for t in self.added):
                letters = low
                plain.append(s)
                lower.append(letters)
                marks.append(mark)
                if letters not in words:
                    new[letters] = None
                if mark and mark not in words:
                    new[mark] = None
            else:
                other.append(s)
        for w in list(new):
            if (ids := self.old_words.get(w)) is not None:
                words[w] = ids
                del new[w]
        if new:
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(new)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            if len(ends) == len(new):
                data, ends = ids.tobytes(), (ends * 4).tolist()
                words.update(zip(new, (data[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)), strict=True))
            else:  # some word is several to the tokenizer
                words.update(zip(new, self._whole(list(new)), strict=True))
        for s, letters, mark in zip(plain, lower, marks, strict=True):
            known[s] = words[letters] + words[mark] if mark else words[letters]
        if other:
            known.update(zip(other, self._whole(other), strict=True))


# ---------------------------------------------------------------------------------- pieces
def _cut(file, length: int, end_id: int, with_ids: bool, special_as_text: bool):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("has_id", pa.bool_()), ("row", pa.int64()), ("start", pa.int64()), ("length", pa.int64())]
        + [("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
        + [("ids", pa.list_(pa.int32()))] * with_ids
    )
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, row = worker_keeps(("encoder", special_as_text, file.value), lambda: Encoder(file.value, special_as_text)), 0
        for batch in batches:
            for part in _parts(batch):
                rows = []
                doc_ids, has_ids, texts = (part[c].to_pylist() for c in ("doc_id", "has_id", "text"))
                encoded = encoder.encode([t or "" for t in texts])
                for doc_id, has_id, data in zip(doc_ids, has_ids, encoded, strict=True):
                    data += end
                    total, row = len(data) // 4, row + 1
                    for start in range(0, total, length):
                        ids = data[4 * start : 4 * (start + length)]
                        piece = [doc_id, has_id, row, start, len(ids) // 4, zlib.crc32(ids), total]
                        rows.append([*piece, np.frombuffer(ids, "<i4")] if with_ids else piece)
                yield _batch(rows, schema)

    return run


def _parts(batch: pa.RecordBatch, rows: int = BATCH_ROWS, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in parts of few rows, and of one row where the texts are long."""
    step = max(1, min(rows, len(batch) * size // max(1, batch["text"].nbytes)))
    for at in range(0, len(batch), step):
        yield batch.slice(at, step)


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


# --------------------------------------------------------------------------------- packing
def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each size: longest first, ties in the given order, each into the first bin with room."""
    n = len(sizes)
    leaves = 1 << max(0, n - 1).bit_length()
    best = [capacity] * (2 * leaves)  # of each node: the most room in a bin below it
    bins = np.zeros(n, np.int64)
    for k in np.argsort(-sizes, kind="stable").tolist():
        size, node = int(sizes[k]), 1
        while node < leaves:
            node *= 2
            if best[node] < size:
                node += 1
        bins[k] = node - leaves
        best[node] -= size
        while node > 1:
            node //= 2
            best[node] = max(best[2 * node], best[2 * node + 1])
    return bins


def _pack_group(length: int):
    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        pieces = pieces.sort_values(["length", "doc_id", "row", "start"], ascending=[False, True, True, True], kind="stable")
        bins = pd.Series(first_fit_decreasing(pieces["length"].to_numpy(), length), index=pieces.index)
        offset = pieces["length"].groupby(bins).cumsum() - pieces["length"]
        out = pieces.assign(sequence_id=pieces["group"].astype("int64") * (1 << 32) + bins, offset=offset)
        return out.drop(columns=["group", "row"])

    return run


def pack(
    docs: DataFrame,
    vocabulary: str,
    length: int = LENGTH,
    end_id: int = END_ID,
    group_docs: int = GROUP_DOCS,
    with_ids: bool = False,
    special_as_text: bool = False,
) -> DataFrame:
    """A row for each piece of each document: where it starts there, and where it lies in a sequence.

    ``vocabulary`` is the path of the tokenizer's file on the driver. The string of a special
    token is that token, or ordinary text if ``special_as_text``. Columns doc_id,
    start, length, ids_crc32, doc_tokens (the end id included), sequence_id, offset and, if
    asked for, ids. A null or empty text is the end id alone; rows that repeat are packed
    each; a null doc_id is kept; an empty table has no pieces. Other columns are not used.

    The groups are fixed by writing the pieces to the shared folder, so a task that runs
    again deals no piece out otherwise.
    """
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as f:
        file = f.read(MAX_VOCABULARY_BYTES + 1)
    if len(file) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{vocabulary} is larger than a vocabulary ({MAX_VOCABULARY_BYTES} bytes)")
    shape = "doc_id long, has_id boolean, row long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids
    # Groups go through pandas, where a null would make a column's ids inexact.
    has_id = F.col("doc_id").isNotNull().alias("has_id")
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"), has_id, "text")
    # Ten thousand long texts at a time, Spark's default, would lie in the executor's memory and in the worker's.
    rows = in_session(small_batches_session(spark, BATCH_ROWS), rows)
    pieces = rows.mapInArrow(_cut(spark.sparkContext.broadcast(file), length, end_id, with_ids, special_as_text), shape)
    pieces = in_session(spark, saved(pieces, "pieces"))
    n = pieces.where("start = 0").count()
    pieces = pieces.withColumn("group", scattered("doc_id", "has_id", "row", parts=max(1, -(-n // group_docs))))
    packed = ", ".join(x for x in shape.split(", ") if x != "row long") + ", sequence_id long, offset long"
    out = pieces.groupBy("group").applyInPandas(_pack_group(length), packed)
    return out.withColumn("doc_id", F.when(F.col("has_id"), F.col("doc_id"))).drop("has_id")


# --------------------------------------------------------------------------------- queries
def public_vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_packing(spark, sf_dir: str) -> DataFrame:
    """Every piece of every document, and where it is packed."""
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"), public_vocabulary())
