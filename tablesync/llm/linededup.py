"""Line dedup: lines that many documents share go, whole corpus, whole texts.

Every text is split into lines; a line's key is hashed (128 bits); each document gives
its distinct hashes once, which are counted per hash. Hashes over the threshold are sent to
every task if they are few, else joined back to the documents that have them, and each
document is put together again from the lines that stay, in their order.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.session import in_session, small_batches_session

from .common import saved, scattered, shuffle_partitions, table, worker_keeps

#: ASCII white space, stripped at both ends of a line.
BLANK = b" \t\n\x0b\x0c\r"
#: Bytes of a line's hash.
HASH_BYTES = 16
#: Frequent lines, of 16 bytes each, that are few enough to broadcast.
BROADCAST_LINES = 200_000
#: Texts that a worker gets at a time to count their lines.
BATCH_ROWS = 256
#: Rows of a batch that Python emits at a time.
EMIT = 100_000
#: Code points of text that Python emits at a time, but for a longer text.
EMIT_CHARS = 4 << 20


def line_key(line: bytes) -> bytes:
    """A line without white space at its ends, A-Z in lower case; other letters stay."""
    return line.strip(BLANK).lower()


def text_lines(text: str | None) -> list[bytes]:
    """The lines of a text; a null or empty text has one, which is empty."""
    return (text or "").encode("utf-8").split(b"\n")


def _hashes(lines: list[bytes], min_chars: int) -> list[bytes | None]:
    """A hash per line, None for keys too short to count."""
    out = []
    for line in lines:
        key = line_key(line)
        short = len(key) < min_chars or len(key) < 4 * min_chars and len(key.decode("utf-8")) < min_chars
        out.append(None if short else xxhash.xxh3_128_digest(key))
    return out


def _keys_of(min_chars: int):
    """The distinct line hashes of each text, beside its id and hash, in batches of bounded size."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("line", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_keeps()  # nothing of an earlier stage
        for batch in batches:
            at, lines = [], []
            for k, text in enumerate(batch["text"]):
                found = {h for h in _hashes(text_lines(text.as_py()), min_chars) if h}
                at += [k] * len(found)
                lines += found
                if len(lines) >= EMIT or k + 1 == len(batch):
                    rows = [batch[c].take(pa.array(at, pa.int64())) for c in ("doc_id", "text_hash")]
                    yield pa.RecordBatch.from_arrays([*rows, pa.array(lines, pa.binary())], schema=schema)
                    at, lines = [], []

    return run


def _cut(min_chars: int, often=None):
    """Column text without the lines whose hashes are in ``often``; adds the two counts.

    ``often`` is a broadcast of hashes, one behind the other; without it, each row has its
    own in column drop. A batch leaves in parts of bounded size.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_keeps()  # nothing of an earlier stage
        every = often and frozenset(often.value[i : i + HASH_BYTES] for i in range(0, len(often.value), HASH_BYTES))
        for batch in batches:
            start, size, texts, n_lines, n_dropped = 0, 0, [], [], []
            names = [c for c in batch.schema.names if c not in ("text", "drop")]
            for k, text in enumerate(batch["text"]):
                text = text.as_py() or ""
                drop = set(batch["drop"][k].as_py() or ()) if every is None else every
                lines = text_lines(text)
                n_lines.append(len(lines))
                if drop:
                    kept = [x for x, h in zip(lines, _hashes(lines, min_chars), strict=True) if h not in drop]
                    n_dropped.append(len(lines) - len(kept))
                    if n_dropped[-1]:
                        text = b"\n".join(kept).decode("utf-8")
                else:
                    n_dropped.append(0)
                texts.append(text)
                size += len(text)
                if size >= EMIT_CHARS or k + 1 == len(batch):
                    part = batch.slice(start, k + 1 - start)
                    arrays = [part[c] for c in names] + [pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
                    yield pa.RecordBatch.from_arrays(arrays, names=[*names, "text", "n_lines", "n_dropped"])
                    start, size, texts, n_lines, n_dropped = k + 1, 0, [], [], []

    return run


def _keys(docs: DataFrame, min_chars: int) -> DataFrame:
    return docs.select("doc_id", "text_hash", "text").mapInArrow(_keys_of(min_chars), "doc_id long, text_hash long, line binary")


def frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """The line hashes that ``min_docs`` rows or more have, once each, as column line.

    ``docs`` has doc_id, text_hash and text.
    """
    spark = docs.sparkSession
    # Ten thousand long texts at a time, Spark's default, would lie in the executor's memory and in the worker's.
    keys = _keys(in_session(small_batches_session(spark, BATCH_ROWS), docs), min_chars)
    often = keys.groupBy("line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs)
    # Of the lines that were counted these are few, so they are written to fewer files.
    often = often.select("line").repartition(max(1, shuffle_partitions(spark) // 4))
    return in_session(spark, saved(often, "frequent-lines"))


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` without lines whose key is in ``min_docs`` documents or more.

    Keys shorter than ``min_chars`` code points never count. Adds n_lines (before) and
    n_dropped; input columns of these names are replaced. Each row is a document, so rows
    that repeat a doc_id count each; a null doc_id is kept; a null text becomes empty. An
    empty table stays empty. Other columns are untouched.
    """
    docs = docs.drop("n_lines", "n_dropped")
    others = [c for c in docs.columns if c != "text"]
    # What a document loses follows from its text; the id keeps copies of a text apart.
    rows = docs.select(
        F.struct(*others).alias("rest"),
        "text",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("doc_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
    )
    often = frequent_lines(rows, min_docs, min_chars)
    if often.count() <= BROADCAST_LINES:
        # Few enough to be sent to every task; no text is shuffled then.
        hashes = b"".join(often.toArrow()["line"].to_pylist())
        cut, rows = _cut(min_chars, docs.sparkSession.sparkContext.broadcast(hashes)), rows.select("rest", "text")
    else:
        # A line may be in any part of all documents: its rows are dealt out over more tasks.
        often = often.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(15)))).hint("merge")
        keys = _keys(rows, min_chars).withColumn("_part", scattered("doc_id", "text_hash", parts=16))
        drops = keys.join(often, ["line", "_part"], "left_semi").groupBy("doc_id", "text_hash").agg(F.collect_set("line").alias("drop"))
        cut, rows = _cut(min_chars), rows.join(drops, ["doc_id", "text_hash"], "left").select("rest", "text", "drop")
    rest = rows.schema["rest"].dataType.simpleString()
    out = rows.mapInArrow(cut, f"rest {rest}, text string, n_lines long, n_dropped long")
    return out.select(*["text" if c == "text" else f"rest.{c}" for c in docs.columns], "n_lines", "n_dropped")


# --------------------------------------------------------------------------------- queries
def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Counts of lines and a digest of what stays of every document."""
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


#: RE2 of DuckDB: white space at both ends; A-Z by translate, which leaves other letters.
OP7_SQL = r"""
WITH l AS (
  SELECT d.rid, d.doc_id, u.pos, u.line,
    translate(regexp_replace(u.line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents) d,
    LATERAL (SELECT unnest(string_split(d.text, chr(10))) AS line,
      generate_subscripts(string_split(d.text, chr(10)), 1) AS pos) u),
hot AS (SELECT k FROM l WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT rid) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE hot.k IS NOT NULL) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE hot.k IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN hot USING (k) GROUP BY rid, doc_id
"""
