"""Embedding near-dedup by a pivot-permutation index.

A vector is described by its nearest reference points (pivots), in order. Each vector is
entered in the inverted lists of its first few pivots; vectors that meet in a list and
share enough pivots among all that describe them are compared exactly. A pair that meets
in several lists counts in the first of them only.

Equal vectors of a label are one entry with a count. A long list is cut into blocks and
each pair of blocks is a piece of work of its own; tasks return, per entry, how many rows
it links to, and links that span what they found, never all pairs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, join_spread, saved, table
from .simhash import _unite
from .vectors import in_blocks, matrix, usable

#: The fewest and the most reference points.
PIVOTS, MOST_PIVOTS = 128, 2048
#: How many of ``PIVOTS`` describe a vector, in how many lists it is entered, how many a pair must share.
DESCRIBED_BY, ENTERED_IN, SHARED = 12, 5, 4
#: No two reference points have a cosine of this or more; candidates for them, and components of those in all.
APART, CANDIDATES, COMPONENTS = 0.8, 4096, 1 << 20
BLOCK_ROWS = 2048
#: Cells of the arrays that rows of a list are compared with, at a time.
BATCH = 1 << 20
SIMILARITY = 0.93


def pivots_for(entries: int) -> int:
    """About four times the square root of the number of a label's entries, a power of two.

    A list then holds about the square root of the entries, so pairs that meet are a falling
    share of all pairs, and describing a vector costs as much as comparing it.
    """
    wanted = 4 * max(1, entries) ** 0.5
    return min(MOST_PIVOTS, max(PIVOTS, 1 << round(np.log2(wanted))))


def choose_pivots(entries: DataFrame, pivots: int) -> dict[int, np.ndarray]:
    """Reference points per vector length: entries in hashed order, less those near an earlier one; bounded.

    A dense group gets one or a few of them whatever its share of the entries: among many
    that are almost equally near, noise would rank them and true pairs would share too few.
    With fewer than ``pivots`` points that far apart, there are fewer; so there are beyond
    ``PIVOTS`` of them if they had more than ``COMPONENTS`` components in all.
    """
    found = {}
    for dim in [r[0] for r in entries.select("dim").distinct().collect()]:
        few = min(pivots, max(PIVOTS, COMPONENTS // dim))
        most = max(few, min(CANDIDATES, COMPONENTS // dim))
        rows = entries.where(F.col("dim") == dim).orderBy(F.xxhash64(F.lit(5), "node"), "node").limit(most)
        points = np.array([r["vector"] for r in rows.select("vector").collect()], dtype=np.float64)
        found[dim] = _apart(points / np.linalg.norm(points, axis=1)[:, None], few)
    return found


def _apart(points: np.ndarray, most: int) -> np.ndarray:
    """The first ``most`` unit vectors that have a cosine below ``APART`` to all taken before them."""
    taken, nearest = [], np.full(len(points), -np.inf)
    for k in range(len(points)):
        if nearest[k] < APART:
            taken.append(k)
            nearest = np.maximum(nearest, points @ points[k])
            if len(taken) == most:
                break
    return points[taken]


def _described(pivots: dict[int, np.ndarray], described_by: int):
    """Numbers of a vector's nearest pivots, nearest first."""

    def run(vectors: pd.Series) -> pd.Series:
        out = [None] * len(vectors)
        sizes = vectors.map(len)
        for dim, points in pivots.items():
            at = np.flatnonzero(sizes == dim)
            if len(at):
                away = -(matrix(vectors.iloc[at]) @ points.T)
                most = min(described_by, len(points))
                first = np.sort(np.argpartition(away, most - 1, axis=1)[:, :most], axis=1)
                order = np.argsort(np.take_along_axis(away, first, axis=1), axis=1, kind="stable")
                for k, row in zip(at, np.take_along_axis(first, order, axis=1), strict=True):
                    out[k] = row.astype(np.int32)
        return pd.Series(out)

    return F.pandas_udf(run, "array<int>")


def _compare(similarity: float, entered_in: int, shared: int, pivots: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["own", "node"], kind="stable")
        n, one, two = len(rows), rows["one"].iloc[0], rows["two"].iloc[0]
        own, node, copies = rows["own"].to_numpy(), rows["node"].to_numpy(), rows["copies"].to_numpy()
        v = matrix(rows["vector"])
        v /= np.linalg.norm(v, axis=1)[:, None]
        near = np.stack(rows["near"].to_list())
        every, lists = _inverted(near, pivots), _inverted(near[:, :entered_in], pivots)
        least, pivot = min(shared, near.shape[1]), rows["pivot"].iloc[0]
        links, root = np.zeros(n, np.int64), np.arange(n)
        # Rows are sorted by block: a row of the first block meets the second one, or those behind it.
        firsts = n if one == two else int((own == one).sum())
        many = max(1, BATCH // (n * near.shape[1]))
        for at in range(0, firsts, many):
            mine = np.arange(at, min(at + many, firsts))
            begin = at + 1 if one == two else firsts
            common = every[near[mine], begin:].sum(axis=1, dtype=np.uint8)
            i, j = np.nonzero(common >= least)
            i, j = mine[i], begin + j
            i, j = i[j > i], j[j > i]
            lists_of = near[i, :entered_in]
            met = ((lists_of < pivot) & (lists[lists_of, j[:, None]] > 0)).any(axis=1)
            i, j = i[~met], j[~met]
            links_here = _cosines(v, i, j) >= similarity
            i, j = i[links_here], j[links_here]
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            _unite(root, i, j)
        some = np.flatnonzero(links)
        return pd.DataFrame({"a": node[some], "b": node[root[some]], "links": links[some]})

    return run


def _cosines(v: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of the rows i and j, some at a time."""
    out, some = np.empty(len(i)), max(1, BATCH // v.shape[1])
    for k in range(0, len(i), some):
        out[k : k + some] = np.einsum("ij,ij->i", v[i[k : k + some]], v[j[k : k + some]])
    return out


def _inverted(near: np.ndarray, pivots: int) -> np.ndarray:
    """A row per pivot: 1 where the vector of that column has the pivot among its own."""
    out = np.zeros((pivots, len(near)), np.uint8)
    out[near.T, np.arange(len(near))] = 1
    return out


def near_vectors(
    rows: DataFrame,
    similarity: float = SIMILARITY,
    pivots: int | None = None,
    described_by: int | None = None,
    entered_in: int | None = None,
    shared: int = SHARED,
) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one for each row of ``rows`` (vec_id, embedding, label).

    Pairs of one label and one vector length are linked if they are found and their cosine
    in double precision is at least ``similarity``; n_links counts the other rows linked
    directly, component_id is the smallest vec_id reachable. Rows with a null label or a
    vector that is null, empty, zero or holds null or non-finite components link with
    nothing. Rows that repeat are rows of their own and link. A null vec_id is never a
    component_id unless all of its component are null; such rows are not kept. An empty
    table gives an empty result. Other columns are not used.

    ``pivots`` follows the number of different vectors of the largest label if it is not given, and the other two
    grow a little with each doubling of it, as a vector's order of many pivots is less stable.
    """
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    fit = usable("embedding") & F.col("label").isNotNull()
    rows = rows.withColumn("node", F.when(fit, F.xxhash64(F.lit(3), F.col("label").cast("string"), "embedding")))
    entries = rows.where("node IS NOT NULL").groupBy("node").agg(
        F.first("label").alias("label"), F.first("embedding").alias("vector"), F.count(F.lit(1)).alias("copies")
    )
    entries = saved(entries.withColumn("dim", F.size("vector")), "pivot-entries")
    if pivots is None:
        pivots = pivots_for(entries.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0)
    doubled = max(0, round(np.log2(pivots / PIVOTS)))
    described_by = described_by or DESCRIBED_BY + 2 * doubled
    entered_in = entered_in or ENTERED_IN + (doubled + 1) // 2
    describe = _described(choose_pivots(entries, pivots), described_by)
    entered = entries.withColumn("near", describe("vector"))
    entered = entered.withColumn("pivot", F.explode(F.slice("near", 1, entered_in)))
    key = ["label", "dim", "pivot"]
    work = in_blocks(entered, key, "node", BLOCK_ROWS)
    compare = _compare(similarity, entered_in, shared, pivots)
    found = work.groupBy(*key, "one", "two").applyInPandas(compare, "a long, b long, links long")
    found = saved(found, "pivot-links")
    linked = components(found.select("a", "b"), "pivot-components").select("node", "root")
    degree = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    entries = entries.select("node", "copies").join(degree, "node", "left").join(linked, "node", "left")
    entries = entries.select(
        "node", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("root")
    )
    rows = join_spread(rows.select("vec_id", "node"), entries, "node", "vec_id")
    rows = saved(rows.select("vec_id", "n_links", "root"), "pivot-rows")
    least = rows.where("root IS NOT NULL").groupBy("root").agg(F.min("vec_id").alias("least"))
    rows = join_spread(rows, least, "root", "vec_id")
    own = F.when(F.col("root").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    rows = rows.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"))
    return rows.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


# --------------------------------------------------------------------------------- queries
def op10_pivots(spark, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
