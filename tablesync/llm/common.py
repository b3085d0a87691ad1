"""Helpers shared by the operators: written intermediates, joins on hot keys, components."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.session import shared_root

#: A word is a run of anything but ASCII white space (fixed by the queries' contracts).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, kind: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{shared_root(spark)}/llm/{kind}-{uuid.uuid4().hex}"


def saved(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again.

    Cuts the lineage: whatever executor is lost later, the rows are not computed anew.
    """
    path = shared_path(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scattered(*cols: str | Column, parts: int) -> Column:
    """A number from 0 to ``parts - 1``, by a hash of the columns."""
    return F.pmod(F.xxhash64(*cols), F.lit(parts)).cast("int")


def join_spread(left: DataFrame, right: DataFrame, key: str, by: str, parts: int = 16) -> DataFrame:
    """Left join on ``key`` where any key may be hot on the left and is unique on the right.

    The right rows are repeated ``parts`` times and the left rows are dealt over the
    copies by a hash of ``by``, so that a hot key goes to ``parts`` tasks. Null keys match
    nothing. Both sides are shuffled: a file's size says little about its repeated rows, so
    they are not left to an automatic broadcast.
    """
    part = "_part"
    while part in left.columns or part in right.columns:
        part += "_"
    spread = right.withColumn(part, F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).hint("merge")
    return left.withColumn(part, scattered(by, parts=parts)).join(spread, [key, part], "left").drop(part)


def worker_keeps(key: object = None, make: Callable | None = None) -> object:
    """What ``make`` gave in this Python worker, for tasks with the same ``key``.

    A worker keeps the last such object only: another key, or none, lets go of it first.
    """
    kept = sys.modules.setdefault("_tablesync_llm_kept", types.ModuleType("_tablesync_llm_kept"))
    if getattr(kept, "key", None) != key:
        kept.key = kept.value = None
        kept.value = make() if make else None
        kept.key = key
    return getattr(kept, "value", None)


def components(edges: DataFrame, kind: str = "components", rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph: rows (node, root), root the smallest node.

    ``edges`` has long columns a and b. Alternates large-star and small-star steps, each
    one aggregation and one join whose output is no longer than its input, and writes the
    edges after each step. Nothing but the number of changed edges reaches the driver.
    Loops, repeated edges and empty input are fine; nodes without an edge to another node
    are absent.
    """
    links = saved(edges.select("a", "b").where("a <> b").distinct(), kind)
    for _ in range(rounds):
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = _spread_pairs(both, least).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = large.where("a <> b").distinct()  # each edge points to the smaller node
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        moved = _spread_pairs(down, least)
        small = (
            moved.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct()
        )
        after = saved(small, kind)
        same = after.count() == links.count() and after.exceptAll(links).isEmpty()
        links = after
        if same:
            break
    else:
        raise RuntimeError(f"components: no fixed point after {rounds} rounds")
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(links.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()


def _spread_pairs(pairs: DataFrame, least: DataFrame) -> DataFrame:
    return join_spread(pairs, least, "a", "b", parts=8)
