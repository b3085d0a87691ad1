"""Mixing sources to target weights, with DataFrame and SQL functions only.

A source's documents are laid out in a hashed order on a line of words; the mix takes a
stretch of that line, twice round at most, so a source gives exactly its target and only
the document at the end of the stretch is cut. The stretch is divided into blocks of equal
length. A splitting tree deals the blocks out to the shards: each node draws, for its two
halves, how many blocks of each source go left, by multivariate hypergeometric sampling,
so every shard gets a random mix while every source's quota is kept exactly. Within a
source, a keyed permutation of the block numbers says which blocks a shard's quota means,
and each shard orders its documents by a hash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import WORD, saved, shuffle_partitions, table

#: Weights of the sources in code point order, repeated (fixed by the query's contract).
WEIGHTS = [3, 1, 2]


def word_count(text: str | Column) -> Column:
    """Number of words as a long; 0 for null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: list[int], share: float, most: float) -> DataFrame:
    """Targets of sources: rows (source, size) get ``rank`` and ``target``.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share``
    times all sizes; a target stops at ``most`` times its source's size and the excess is
    shared again by weight. That ends where every target is the smaller of its limit and
    one common multiple of its weight, which sorting by limit over weight gives directly.
    One row per source meets in one task here: names of sources, never documents.
    """
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumns({"w": w, "limit": F.col("size") * F.lit(float(most))})
    order = W.orderBy(F.col("limit") / F.col("w"), "rank")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    after = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    rest = F.lit(float(share)) * F.sum("size").over(W.partitionBy()) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    level = F.greatest(rest, F.lit(0.0)) / F.sum("w").over(after)
    # The first source, in that order, whose limit is above the level, sets the level for all after it.
    ranked = ranked.withColumn("level", F.when(F.col("limit") > level * F.col("w"), level))
    ranked = ranked.withColumn("level", F.first("level", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0)))
    target = F.when(F.col("level").isNull(), F.col("limit")).otherwise(F.least("limit", F.col("level") * F.col("w")))
    return ranked.select("source", "size", "rank", target.alias("target"))


def draw(
    docs: DataFrame,
    weights: list[int],
    share: float = 1.5,
    most: float = 2.0,
    block_words: int = 256,
    shard_words: int = 1 << 20,
    seed: int = 7,
) -> DataFrame:
    """What the mix takes of each row of ``docs`` (doc_id, source, size and any others).

    Returns, for each row and each of its ``most`` possible copies, the row's columns with
    source_size, target, ``row`` (numbers the input rows), ``copy``, ``take`` (words taken
    of that copy, 0 if it is not drawn, less than ``size`` only for the last of a source)
    and ``shard`` (null where nothing is taken). The number of shards follows the words.

    A null source is a source; rows that are equal in all columns are rows of their own;
    rows without a word are never drawn; an empty table gives an empty result. Input
    columns named like the added ones are replaced, no other is touched. What is taken
    follows from the rows and not from their order, so all columns must be orderable.
    """
    added = ("source_size", "target", "row", "copy", "take", "shard")
    given = [c for c in docs.columns if c not in added]
    docs = docs.select(F.struct(*[F.col(_quoted(c)).alias(c) for c in given]).alias("given"), "doc_id", "source", "size")
    docs = docs.withColumn("_key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    bits = max(1, (shuffle_partitions(docs.sparkSession) - 1).bit_length())
    # The line follows the hash, so cutting it by the hash's leading bits keeps its order
    # whatever the number of chunks, and spreads a source over all tasks.
    docs = docs.withColumn("_hash", F.xxhash64(F.lit(seed), "doc_id"))
    docs = saved(docs.withColumn("_chunk", F.shiftright("_hash", 64 - bits)), "mix-sizes")
    chunks = docs.groupBy("_key", "_chunk").agg(F.first("source").alias("source"), F.sum("size").alias("words"))
    sources = chunks.groupBy("_key").agg(F.first("source").alias("source"), F.sum("words").alias("size"))
    sources = source_targets(sources, weights, share, most).withColumns(
        {"_key": F.coalesce(F.concat(F.lit("="), "source"), F.lit("")), "quota": F.round("target").cast("long")}
    )
    sources = sources.withColumn("blocks", F.ceil(F.col("quota") / block_words))
    sources = saved(sources.select("_key", "rank", F.col("size").alias("source_size"), "target", "quota", "blocks"), "mix-sources")
    taken = sources.agg(F.sum("quota")).first()[0] or 0
    shards = max(1, -(-taken // shard_words))

    prior = W.partitionBy("_key").orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    chunks = chunks.select("_key", "_chunk", F.coalesce(F.sum("words").over(prior), F.lit(0)).alias("_offset"))
    chunks = chunks.join(sources, "_key")
    within = W.partitionBy("_key", "_chunk").orderBy("_hash", "given")
    so_far = F.sum("size").over(within.rowsBetween(W.unboundedPreceding, W.currentRow))
    line = docs.withColumns({"_start": so_far - F.col("size"), "_row": F.row_number().over(within)})
    line = line.join(chunks, ["_key", "_chunk"])
    copies = line.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(math.ceil(most) - 1))))
    copies = copies.withColumn("_at", F.col("_start") + F.col("_offset") + F.col("copy") * F.col("source_size"))
    copies = copies.withColumn(
        "take", F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("quota") - F.col("_at")))
    )
    block = F.floor(F.col("_at") / block_words)
    copies = copies.withColumn("_draw", F.when(F.col("take") > 0, permuted(block, F.col("blocks"), F.lit(seed), F.col("rank"))))
    width = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("blocks") / shards))
    copies = copies.withColumn("_cell", F.floor(F.col("_draw") / width))

    # A shard's part of a source is a stretch of the permuted blocks; it is listed under
    # each cell, as wide as a mean part, that it touches, so that equal cells find it.
    parts = splitting_tree(sources, shards, seed).join(sources.select("rank", "blocks"), "rank")
    last = F.col("first") + F.col("count") - 1
    parts = parts.where("count > 0").select(
        "rank", "shard", "first", last.alias("_last"),
        F.explode(F.sequence(F.floor(F.col("first") / width), F.floor(last / width))).alias("_cell"),
    )
    found = copies.alias("c").join(
        parts.alias("p"),
        (F.col("c.rank") == F.col("p.rank"))
        & (F.col("c._cell") == F.col("p._cell"))
        & F.col("c._draw").between(F.col("p.first"), F.col("p._last")),
        "left",
    )
    row = F.struct(F.col("c._key"), F.col("c._chunk"), F.col("c._row"))
    return found.select(
        *[F.col("c.given")[c].alias(c) for c in given], "c.source_size", "c.target", row.alias("row"), "c.copy", "c.take", "p.shard"
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def mix(docs: DataFrame, weights: list[int], seed: int = 7, **options) -> DataFrame:
    """The mix itself: a row of ``docs`` for each copy drawn, with ``shard`` and ``position``.

    Rows alike in doc_id, source and text stand for each other. A cut copy's text is its
    first words joined by spaces. ``position`` numbers a shard's rows in a hashed order.
    Input columns shard and position are replaced, no other is touched; all columns must be
    orderable. The result does not depend on the order of the rows.
    """
    given = [c for c in docs.columns if c not in ("shard", "position")]
    whole = F.struct(*[F.col(_quoted(c)).alias(c) for c in given])
    keyed = docs.select(whole.alias("doc"), "doc_id", "source", F.xxhash64("text").alias("text_hash"), word_count("text").alias("size"))
    key = ["doc_id", "source", "text_hash", "size"]
    drawn = draw(keyed.select(*key), weights, seed=seed, **options).where("take > 0")
    rows = keyed.groupBy(*key).agg(F.min("doc").alias("doc"))
    same = (
        F.col("r.doc_id").eqNullSafe(F.col("d.doc_id"))
        & F.col("r.source").eqNullSafe(F.col("d.source"))
        & (F.col("r.text_hash") == F.col("d.text_hash"))
        & (F.col("r.size") == F.col("d.size"))
    )
    out = rows.alias("r").join(drawn.alias("d"), same).select("r.doc", "d.size", "d.take", "d.shard", "d.copy", "d.row")
    text = F.col("doc")["text"]
    words = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), 0), 1, F.col("take").cast("int")), " ")
    text = F.when(F.col("take") < F.col("size"), words).otherwise(text)
    local = W.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "copy", "row"), "copy", "row")
    out = out.withColumns({"position": F.row_number().over(local) - 1, "text": text})
    return out.select(*[(F.col("text") if c == "text" else F.col("doc")[c]).alias(c) for c in given], "shard", "position")


# ------------------------------------------------------------------------------- the tree
def splitting_tree(sources: DataFrame, shards: int, seed: int) -> DataFrame:
    """Rows (rank, shard, first, count): the stretch of each source's permuted blocks per shard.

    ``sources`` has one row per source, with rank and blocks. A node's row holds a number
    per source; each level halves every node.
    """
    listed = F.transform(F.array_sort(F.collect_list(F.struct("rank", "blocks"))), lambda x: x["blocks"])
    node = sources.agg(listed.alias("counts")).select(
        F.lit(0).cast("long").alias("lo"),
        F.lit(shards).cast("long").alias("hi"),
        "counts",
        F.transform("counts", lambda x: F.lit(0).cast("long")).alias("starts"),
    )
    spark = sources.sparkSession
    for level in range((shards - 1).bit_length()):
        if level == 6:  # from here on there are nodes for many tasks
            node = node.repartition(shuffle_partitions(spark), "lo")
        node = _halves(node, seed)
    node = saved(node, "mix-tree")
    return node.select(F.col("lo").alias("shard"), F.posexplode(F.arrays_zip("counts", "starts")).alias("rank", "x")).select(
        F.col("rank").cast("int").alias("rank"), "shard", F.col("x.starts").alias("first"), F.col("x.counts").alias("count")
    )


def _halves(node: DataFrame, seed: int) -> DataFrame:
    """Each node [lo, hi) of shards becomes two; a node of one shard keeps itself and an empty one, which goes."""
    node = node.withColumn("mid", F.floor((F.col("lo") + F.col("hi")) / 2))
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
    node = node.withColumn("total", total)
    go_left = F.floor(F.col("total") * (F.col("mid") - F.col("lo")) / (F.col("hi") - F.col("lo")))

    def one_source(state: Column, i: Column) -> Column:
        good = F.get("counts", i)
        uniform = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "lo", "hi", i), 11) / F.lit(float(1 << 53))
        drawn = hypergeometric(good, state["rest"], state["draws"], uniform)
        return _let(
            drawn,
            lambda x: F.struct(
                (state["rest"] - good).alias("rest"),
                (state["draws"] - x).alias("draws"),
                F.concat(state["left"], F.array(x)).alias("left"),
            ),
        )

    none = F.array().cast("array<bigint>")
    start = F.struct(F.col("total").alias("rest"), go_left.alias("draws"), none.alias("left"))
    each = F.when(F.size("counts") > 0, F.sequence(F.lit(0), F.size("counts") - 1)).otherwise(F.array().cast("array<int>"))
    node = node.withColumn("left", F.aggregate(each, start, one_source, lambda s: s["left"]))
    left = F.struct("lo", F.col("mid").alias("hi"), F.col("left").alias("counts"), "starts")
    right = F.struct(
        F.col("mid").alias("lo"),
        "hi",
        F.zip_with("counts", "left", lambda a, b: a - b).alias("counts"),
        F.zip_with("starts", "left", lambda a, b: a + b).alias("starts"),
    )
    return node.select(F.explode(F.array(left, right)).alias("n")).select("n.*").where("lo < hi")


# ------------------------------------------------------------------- numbers, as expressions
def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def permuted(x: Column, n: Column, *key: Column, rounds: int = 24) -> Column:
    """A keyed permutation of 0 .. n-1, of any n: the swap-or-not shuffle.

    Each round pairs x with (k - x) mod n and swaps the pair or not by a hashed bit that
    both of the pair agree on.
    """

    def swap(v: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, r), n) - v, n)
        return _let(
            other,
            lambda o: F.when(F.pmod(F.xxhash64(*key, r, F.greatest(v, o)), F.lit(2)) == 1, o).otherwise(v),
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), x.cast("long"), swap)


def _ln_factorial(x: Column) -> Column:
    """ln(x!): looked up below 16; beyond, Stirling's series is exact to double precision."""
    small = F.array(*[F.lit(math.lgamma(n + 1)) for n in range(16)])
    series = x * F.log(x) - x + F.log(x * (2 * math.pi)) / 2 + 1 / (x * 12) - 1 / (x * x * x * 360) + 1 / (x * x * x * x * x * 1260)
    return F.when(x < 16, F.get(small, x.cast("int"))).otherwise(series)


def hypergeometric(good: Column, total: Column, drawn: Column, uniform: Column) -> Column:
    """How many of ``good`` among ``total`` things are in a random draw of ``drawn``.

    Inverts the distribution at ``uniform``, adding up probabilities outwards from the
    mode; what lies beyond ten standard deviations is below a double's precision.
    """

    def invert(s: Column) -> Column:
        g, n, d, m = s["g"], s["n"], s["d"], s["m"]
        ln_p = _ln_factorial(g) + _ln_factorial(n - g) + _ln_factorial(d) + _ln_factorial(n - d) - _ln_factorial(n)
        ln_p = ln_p - _ln_factorial(m) - _ln_factorial(g - m) - _ln_factorial(d - m) - _ln_factorial(n - g - d + m)
        sd = F.sqrt(d * (g / n) * ((n - g) / n) * ((n - d) / F.greatest(n - 1, F.lit(1.0))))

        def step(a: Column, i: Column) -> Column:
            k, j = m + i - 1, m - i + 1
            up = a["up"] * (g - k) * (d - k) / ((k + 1) * (n - g - d + k + 1))
            down = a["down"] * j * (n - g - d + j) / ((g - j + 1) * (d - j + 1))
            return _let(
                F.struct(up.alias("up"), down.alias("down")),
                lambda p: F.struct(
                    p["up"].alias("up"),
                    p["down"].alias("down"),
                    (a["rest"] - p["up"] - p["down"]).alias("rest"),
                    F.coalesce(
                        a["hit"], F.when(a["rest"] < p["up"], m + i), F.when(a["rest"] < p["up"] + p["down"], m - i)
                    ).alias("hit"),
                ),
            )

        start = _let(
            F.exp(ln_p),
            lambda p: F.struct(
                p.alias("up"),
                p.alias("down"),
                (s["u"] - p).alias("rest"),
                F.when(s["u"] < p, m).alias("hit"),
            ),
        )
        steps = F.sequence(F.lit(1), F.ceil(sd * 10 + 20).cast("int"))
        return F.aggregate(steps, start, step, lambda a: F.coalesce(a["hit"], m).cast("long"))

    g, n, d = (c.cast("double") for c in (good, total, drawn))
    mode = F.floor((d + 1) * (g + 1) / (n + 2)).cast("double")
    drawn_of = F.when((g <= 0) | (d <= 0), F.lit(0).cast("long")).when(g >= n, drawn).when(d >= n, good)
    args = F.struct(g.alias("g"), n.alias("n"), d.alias("d"), uniform.alias("u"), mode.alias("m"))
    return drawn_of.otherwise(_let(args, invert))


# --------------------------------------------------------------------------------- queries
def op1_mixing(spark, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count("text").alias("size"))
    drawn = draw(docs, WEIGHTS)
    return drawn.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("size").alias("size"),
        F.first("source_size").alias("source_size"),
        F.first("target").alias("target"),
        F.sum("take").alias("taken"),
        F.min("shard").alias("first_shard"),
    ).drop("row")
