"""Approximate nearest neighbours by a forest of hash prefixes.

Random hyperplanes give every vector a long string of bits in each tree; a tree is the
array of its strings in sorted order. A query descends in every tree to the longest prefix
that it shares with some string there, then ascends in all trees at once, a bit at a time:
each step widens a tree's stretch of the array to all strings that share one bit less,
tree after tree, until the stretches hold enough rows. Those rows are compared exactly.

For the largest inner product, vectors are first lifted to one length by a further
component, which queries have as zero.

Rows are dealt out to shards of bounded size, each with a forest of its own, and the query
set goes to the shards in blocks; a shard returns only its best rows for each query. Equal
vectors are one entry with their smallest ids.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import join_spread, saved, scattered, table
from .vectors import matrix, same_vector, usable

TREES, BITS = 16, 32
#: Rows that the stretches of all trees hold before the ascent ends, as a part of the
#: shard's rows (a row may be in several trees' stretches).
SHARE = 1.8
SHARD_ROWS, QUERY_ROWS = 8192, 8192
SEED = 11
#: Scores held at a time.
_AT_ONCE = 1 << 22


class Forest:
    def __init__(self, vectors: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = SEED, longest: float | None = None):
        n, dim = vectors.shape
        self.bits, self.vectors = bits, vectors
        norms = np.linalg.norm(vectors, axis=1)
        longest = max(longest or 0.0, float(norms.max(initial=0.0))) or 1.0
        lift = np.sqrt(np.maximum(0.0, 1 - (norms / longest) ** 2))
        self.planes = np.random.default_rng([seed, dim]).normal(size=(trees, dim + 1, bits))
        strings = self._strings(np.column_stack([vectors / longest, lift]))
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=1)

    def _strings(self, lifted: np.ndarray) -> np.ndarray:
        """A string per tree and row, as a number with the first bit on top."""
        weights = 1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64)
        return np.stack([((lifted @ p) > 0) @ weights for p in self.planes])

    def stretches(self, queries: np.ndarray, enough: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end, per tree and query, of the stretch where the ascent stops.

        That is when all stretches together hold ``enough`` rows and one of them ``least``,
        so that as many different rows are found.
        """
        strings = self._strings(np.column_stack([queries, np.zeros(len(queries))]))
        trees, q = strings.shape
        begin, end = np.zeros((self.bits + 1, trees, q), np.int64), np.zeros((self.bits + 1, trees, q), np.int64)
        for length in range(self.bits + 1):  # prefix lengths; all rows share the empty one
            free = self.bits - length
            low = strings >> free << free
            for t in range(trees):
                begin[length, t] = np.searchsorted(self.sorted[t], low[t], side="left")
                end[length, t] = np.searchsorted(self.sorted[t], low[t] + (1 << free), side="left")
        # One step of the ascent shortens the prefix of one tree by a bit; the trees take turns.
        sizes = (end - begin)[::-1].transpose(2, 0, 1).reshape(q, -1)
        wider = np.diff(sizes.reshape(q, self.bits + 1, trees), axis=1, prepend=0).reshape(q, -1)
        held = np.cumsum(wider, axis=1)
        longest = np.maximum.accumulate(sizes, axis=1)
        short = (held < enough) | (longest < min(least, len(self.vectors)))
        step = np.minimum(short.sum(axis=1), held.shape[1] - 1)
        level, turn = step // trees, step % trees
        length = self.bits - level[None, :] + (np.arange(trees)[:, None] > turn[None, :])
        length = np.minimum(length, self.bits)
        empty = (np.arange(trees)[:, None] > turn[None, :]) & (level[None, :] == 0)
        t, k = np.arange(trees)[:, None], np.arange(q)[None, :]
        begin, end = begin[length, t, k], end[length, t, k]
        return begin, np.where(empty, begin, end)

    def nearest(self, queries: np.ndarray, enough: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, row): for each query the ``most`` best rows of each tree's stretch, distinct.

        Where more rows tie for the last place, the first ``most`` of those rows come, too.
        """
        begin, end = self.stretches(queries, enough, most)
        # Equal products may differ by this much in a matrix product.
        slack = 1e-12 * np.linalg.norm(queries, axis=1) * np.linalg.norm(self.vectors, axis=1).max(initial=0.0)
        found = []
        for t, order in enumerate(self.order):
            vectors = self.vectors[order]
            spans, which = np.unique(np.stack([begin[t], end[t]]), axis=1, return_inverse=True)
            for s, (a, b) in enumerate(spans.T.tolist()):
                if a == b:
                    continue
                same = np.flatnonzero(which.ravel() == s)
                step = max(1, _AT_ONCE // (b - a))
                for part in (same[i : i + step] for i in range(0, len(same), step)):
                    scores = queries[part] @ vectors[a:b].T
                    if b - a > most:
                        best = np.argpartition(-scores, most - 1, axis=1)[:, :most]
                        last, off = np.take_along_axis(scores, best[:, -1:], axis=1), slack[part, None]
                        for i in np.flatnonzero((scores >= last - off).sum(axis=1) > most):
                            ties = np.sort(order[a + np.flatnonzero(np.abs(scores[i] - last[i]) <= off[i])])[:most]
                            found.append(np.stack([np.full(len(ties), part[i]), ties]))
                    else:
                        best = np.broadcast_to(np.arange(b - a), scores.shape)
                    found.append(np.stack([np.repeat(part, best.shape[1]), order[a + best].ravel()]))
        pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
        return pairs[0], pairs[1]


def _search(most: int, share: float, trees: int, bits: int, longest: float) -> Callable:
    def run(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or queries.empty:
            return pd.DataFrame({"q": pd.Series(dtype=str), "c": pd.Series(dtype=str), "score": pd.Series(dtype=float)})
        rows = rows.sort_values("least", kind="stable")  # the first of tied rows have the smallest ids
        v, q = matrix(rows["vector"]), matrix(queries["q_vector"])
        forest = Forest(v, trees, bits, longest=longest)
        # A few more than asked for, as sums in another order may tie otherwise; then exactly.
        k, r = forest.nearest(q, math.ceil(share * len(v)), most + 8)
        scores = np.einsum("ij,ij->i", q[k], v[r])
        order = np.lexsort((rows["least"].to_numpy()[r], -scores, k))
        k, r, scores = k[order], r[order], scores[order]
        keep = np.arange(len(k)) - np.searchsorted(k, k, side="left") < most
        return pd.DataFrame({
            "q": queries["q_cls"].to_numpy()[k[keep]], "c": rows["cls"].to_numpy()[r[keep]], "score": scores[keep]
        })

    return run


def nearest_neighbours(
    rows: DataFrame,
    is_query: Column,
    k: int = 20,
    share: float = SHARE,
    trees: int = TREES,
    bits: int = BITS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score) for the rows of ``rows`` (vec_id, embedding) where ``is_query``.

    The ``k`` nearest found, by inner product in double precision, ties to the smaller
    vec_id, without rows of the query's own vec_id; fewer if there are fewer. Vectors that
    are null, empty, zero or hold null or non-finite components and rows without a vec_id
    take no part; vectors of another length than the query's are not compared. Rows that
    repeat count once. Other columns are not used.
    """
    rows = rows.where(usable("embedding") & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), is_query.alias("asks"), "embedding"
    )
    rows = rows.withColumn("cls", same_vector("embedding"))
    # Enough of a class's members for any query, its own id left out; cut in each task first.
    order = W.partitionBy("cls").orderBy("vec_id")
    members = rows.withColumn("n", F.dense_rank().over(order)).where(F.col("n") <= k + 1)
    entries = members.groupBy("cls").agg(
        F.array_sort(F.collect_set("vec_id")).alias("members"), F.min("vec_id").alias("least"), F.first("embedding").alias("vector")
    )
    entries = saved(entries.withColumn("dim", F.size("vector")), "forest-entries")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    longest, n = entries.agg(F.max(norm), F.count(F.lit(1))).first()
    asking = saved(rows.where("asks").select("vec_id", "cls").distinct(), "forest-queries")
    vectors = entries.join(asking.select("cls").distinct(), "cls", "left_semi").select("cls", "vector", "dim")
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-asking.count() // QUERY_ROWS))
    every = [F.explode(F.sequence(F.lit(0), F.lit(m - 1))) for m in (blocks, shards)]
    left = entries.select("cls", "least", "vector", "dim", scattered("cls", parts=shards).alias("shard"), every[0].alias("block"))
    right = vectors.select(
        *[F.col(c).alias(f"q_{c}") for c in ("cls", "vector", "dim")],
        scattered(F.lit(1), "cls", parts=blocks).alias("q_block"),
        every[1].alias("q_shard"),
    )
    search = _search(k + 1, share, trees, bits, longest or 1.0)
    groups = left.groupBy("dim", "shard", "block").cogroup(right.groupBy("q_dim", "q_shard", "q_block"))
    found = groups.applyInPandas(search, "q string, c string, score double")

    best = W.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    found = join_spread(found, entries.select(F.col("cls").alias("c"), "members"), "c", "q")
    found = found.select("q", "score", F.explode("members").alias("vec_id"))
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
    lists = found.groupBy(F.col("q").alias("cls")).agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("found"))
    answers = join_spread(asking, lists, "cls", "vec_id")
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("vec_id")), 1, k)
    answers = answers.select(F.col("vec_id").alias("query_id"), F.posexplode(others).alias("rank", "x"))
    return answers.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")


# --------------------------------------------------------------------------------- queries
def op8_forest(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest found for every vector whose id is divisible by 20."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest_neighbours(rows, F.col("vec_id") % 20 == 0, k=20)
