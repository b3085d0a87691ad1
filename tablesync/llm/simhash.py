"""SimHash near-dedup by a segment-popcount embedding.

A 64-bit fingerprint is cut into 32 segments of two bits; their bit counts (0, 1 or 2)
embed it in a grid of 32 dimensions, where the Manhattan distance is at most the number of
differing bits. The 32 dimensions are divided into ``distance + SPARE`` sub-grids: if two
points are within ``distance``, at least ``SPARE`` sub-grids hold no difference, so the
points share a cell of some choice of ``SPARE`` sub-grids. Within a shared cell, the
Manhattan distance over all dimensions rules out most pairs and the bits decide the rest.

Only distinct fingerprints are compared. A cell's rows are compared in a sorted partition,
in numpy; what leaves a task are links that span what it found, never all pairs. Cells of
more than ``CELL_ROWS`` rows are cut into blocks, and each pair of blocks is a piece of
work of its own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, join_spread, saved, table, worker_keeps

#: Sub-grids that must agree. More make smaller cells and more of them: a choice of 2 among
#: 6 gives 15 rows per fingerprint, 4 among 8 would give 70.
SPARE = 2
CELL_ROWS = 4096
SEED = 42
_LOW_BITS = 0x5555555555555555
#: Shingles hashed at a time, for bounded memory on long texts.
_AT_ONCE = 1 << 16
_COLUMNS = ["choice", "cell", "one", "two"]


# ---------------------------------------------------------------------------- fingerprints
def fingerprint(text: str | None, words: int) -> int:
    """SimHash of a text's word shingles, unsigned; 0 if it has no word.

    A-Z are lower-cased; a text of fewer words is one shingle. A bit is set if it is set in
    over half of the shingles' hashes, repeated shingles counted each time.
    """
    found = (text or "").encode().lower().split()  # splits at ASCII white space only
    if not found:
        return 0
    joined = b" ".join(found)
    ends = list(accumulate(len(w) + 1 for w in found))
    starts = [0, *ends[:-1]]
    total, digest = max(1, len(found) - words + 1), xxhash.xxh64_intdigest
    ends = ends[words - 1 :] or ends[-1:]
    counts = np.zeros(64, np.int64)
    for at in range(0, total, _AT_ONCE):
        part = zip(starts[at : min(total, at + _AT_ONCE)], ends[at : at + _AT_ONCE], strict=False)
        hashes = np.array([digest(joined[a : b - 1], SEED) for a, b in part], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(text: str | Column, words: int) -> Column:
    """The fingerprint as a signed long."""

    def run(texts: pd.Series) -> pd.Series:
        worker_keeps()  # nothing of an earlier stage
        return pd.Series(np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64))

    return F.pandas_udf(run, "long")(text)


# ---------------------------------------------------------------------------- the grid join
def grid_choices(distance: int, spare: int = SPARE) -> list[int]:
    """Masks over the 32 two-bit segments: every choice of ``spare`` among the sub-grids."""
    grids = distance + spare
    if grids > 32:
        raise ValueError(f"distance {distance} leaves no sub-grids of 32 segments")
    bounds = [32 * k // grids for k in range(grids + 1)]
    masks = [sum(3 << 2 * s for s in range(a, b)) for a, b in zip(bounds, bounds[1:], strict=False)]
    return [sum(c) for c in combinations(masks, spare)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def segment_counts(fp: Column) -> Column:
    """The 32 bit counts of two-bit segments, packed in their places."""
    low = F.lit(_LOW_BITS)
    other = F.shiftrightunsigned(fp, 1)
    return F.shiftleft(fp.bitwiseAND(other).bitwiseAND(low), 1).bitwiseOR(fp.bitwiseXOR(other).bitwiseAND(low))


def near_links(prints: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that connect whatever is near.

    Two fingerprints are connected by links if and only if a chain of fingerprints within
    ``distance`` bits of the next joins them; each link is itself such a pair or joins two
    that a chain joins.
    """
    spots = segment_counts(F.col("fp"))
    cells = [F.struct(F.lit(k).alias("choice"), spots.bitwiseAND(F.lit(_signed(m))).alias("cell")) for k, m in enumerate(grid_choices(distance))]
    rows = prints.select("fp").distinct().select("fp", F.explode(F.array(*cells)).alias("c")).select("c.choice", "c.cell", "fp")
    crowded = rows.groupBy("choice", "cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CELL_ROWS)
    crowded = saved(crowded.select("choice", "cell", F.ceil(F.col("n") / CELL_ROWS).cast("int").alias("blocks")), "crowded-cells")
    rows = rows.join(crowded, ["choice", "cell"], "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("choice", "cell", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "fp")
    rows = rows.repartition(*_COLUMNS).sortWithinPartitions(*_COLUMNS)
    return rows.mapInArrow(_links_within(distance), "a long, b long").distinct()


def _links_within(distance: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last key's rows, which may go on in the next batch
        for batch in batches:
            rows = np.stack([batch[c].to_numpy().astype(np.int64) for c in [*_COLUMNS, "fp"]])
            rows = rows if held is None else np.concatenate([held, rows], axis=1)
            if rows.shape[1] == 0:
                continue
            last = (rows[:4] == rows[:4, -1:]).all(axis=0)
            cut = rows.shape[1] if not last.any() else int(last.argmax())
            yield _spanning(rows[:, :cut], distance)
            held = rows[:, cut:]
        if held is not None:
            yield _spanning(held, distance)

    return run


def _spanning(rows: np.ndarray, distance: int) -> pa.RecordBatch:
    """Links of rows sorted by key: each row with those behind it that have its key."""
    n = rows.shape[1]
    fp, root = rows[4].view(np.uint64), np.arange(n)
    low, one = np.uint64(_LOW_BITS), np.uint64(1)
    spots = ((fp & (fp >> one) & low) << one) | ((fp ^ (fp >> one)) & low)
    change = np.ones(n, bool)
    change[1:] = (rows[:4, 1:] != rows[:4, :-1]).any(axis=0)
    key = np.cumsum(change)
    left, step = np.arange(n), 0
    while len(left):
        step += 1
        left = left[left + step < n]
        left = left[key[left] == key[left + step]]
        right = left + step
        x = spots[left] ^ spots[right]
        gap = np.bitwise_count(x & low) + 2 * np.bitwise_count((x >> one) & ~x & low)
        a, b = left[gap <= distance], right[gap <= distance]
        near = np.bitwise_count(fp[a] ^ fp[b]) <= distance
        _unite(root, a[near], b[near])
    child = np.flatnonzero(root != np.arange(n))
    return pa.RecordBatch.from_arrays([pa.array(rows[4][child]), pa.array(rows[4][root[child]])], names=["a", "b"])


def _unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of a[i] and b[i]; ``root`` points to the smallest index of each set."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root[:] = root[root]


# ---------------------------------------------------------------------------- the operator
def near_duplicates(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """Rows (doc_id, text_hash, fp, component, component_id), one for each row of ``docs``.

    ``component`` is the smallest fingerprint reachable over pairs that differ in at most
    ``distance`` bits, ``component_id`` the smallest doc_id there. A null text and one
    without words have fingerprint 0, which links like any other. A null doc_id is linked
    but never a component_id, unless all of its component are null: then that is null. Rows
    that repeat are each returned; an empty table gives an empty result.
    """
    prints = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), fingerprints("text", words).alias("fp"))
    prints = saved(prints, "fingerprints")
    found = components(near_links(prints, distance), "simhash")
    found = found.select(F.col("node").alias("fp"), F.col("root"))
    rows = join_spread(prints, found, "fp", "doc_id").withColumn("component", F.coalesce("root", "fp")).drop("root")
    rows = saved(rows, "simhash-components")
    least = rows.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return join_spread(rows, least, "component", "doc_id").select("doc_id", "text_hash", "fp", "component", "component_id")


def drop_near_duplicates(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """One row of ``docs`` for each component: that with its smallest doc_id, null last."""
    found = near_duplicates(docs, words, distance)
    best = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("best"))
    key = [F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.col("doc_id").isNull()).alias("_id"), F.col("text_hash").alias("_hash")]
    best = best.select("best.*").select(*key)
    rows = docs.select(F.struct("*").alias("doc"), "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    rows = rows.select("doc", *key)
    rows = rows.join(best, ["_id", "_hash"], "left_semi").dropDuplicates(["_id", "_hash"])
    return rows.select("doc.*")


# --------------------------------------------------------------------------------- queries
def op5_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), words=4, distance=4)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")
