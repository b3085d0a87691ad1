"""Periodic run detection: stretches of words that repeat with a period, by suffix trees.

For every document, Ukkonen's algorithm builds the suffix tree of its words and that of
their reversal. An Euler tour of a tree turns the longest common extension of two places
(LCE) into the least string depth between their leaves on the tour, the depth of their
lowest common ancestor, which a sparse table answers in constant time. Every run contains
the longest Lyndon word from some place, of words in order or in reverse order, as its
period (a Lyndon root); so there are two candidates a place. Each is extended both ways by
an LCE, forward in the tree and backward in that of the reversal.

A document is text in one row, so documents are on their own and nothing is shuffled.
Words of a run recur in it: stretches whose word sequences of a certain length do not recur
hold no run and get no tree (``_stretches``), which loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, table, worker_keeps

#: A run has at least so many words and so many periods (fixed by the query's contract).
MIN_WORDS, MIN_PERIODS = 6, 4
#: Bytes of text that are looked at at a time; a longer text is a part of its own.
PART_BYTES = 2 << 20

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


# ------------------------------------------------------------------------------ suffix tree
class SuffixTree:
    """Suffix tree of ``words`` (numbers from 0) and an end mark that sorts before them.

    ``lce`` answers many longest common extensions at a time. ``ranks`` gives the places of
    the suffixes in order, of words and of words in reverse order; in both a suffix comes
    before those that it begins.
    """

    def __init__(self, words: list[int]):
        self.n = len(words)
        self.starts, self.ends, edges, self.width = _ukkonen(words)
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        self.children = np.fromiter(edges.values(), np.int64, len(edges))
        self.parents, self.first = keys // self.width, keys % self.width
        self._tour()

    def _ordered(self, first: np.ndarray) -> list[list[int]]:
        """Each node's children in the order of ``first``."""
        by = np.lexsort((first, self.parents))
        begin = np.searchsorted(self.parents[by], np.arange(len(self.starts) + 1)).tolist()
        listed = self.children[by].tolist()
        return [listed[a:b] for a, b in zip(begin[:-1], begin[1:], strict=True)]

    def _tour(self) -> None:
        """String depths along the Euler tour, and the place of each suffix's leaf on it."""
        starts, ends, whole = self.starts, self.ends, self.n + 1
        children = self._ordered(self.first)
        tour, leaves, at = [0], [], []
        depth, waiting, stack = 0, iter(children[0]), []
        while True:
            for node in waiting:
                end = ends[node]
                if end >= 0:
                    stack.append((waiting, depth))
                    depth += end - starts[node]
                    tour.append(depth)
                    waiting = iter(children[node])
                    break
                suffix = starts[node] - depth  # a leaf: its edge begins as deep as its parent is
                leaves.append(suffix)
                at.append(len(tour))
                tour += (whole - suffix, depth)
            else:
                if not stack:
                    break
                waiting, depth = stack.pop()
                tour.append(depth)
        self.tour, self.at = np.array(tour, np.int64), np.empty(whole, np.int64)
        self.at[leaves] = at

    def ranks(self) -> tuple[list[int], list[int]]:
        starts, ends = self.starts, self.ends
        children = self._ordered(np.where(self.first, self.width - self.first, 0))
        rank = np.empty(self.n + 1, np.int64)
        rank[np.argsort(self.at)] = np.arange(self.n + 1)
        leaves, depth, waiting, stack = [], 0, iter(children[0]), []
        while True:
            for node in waiting:
                end = ends[node]
                if end >= 0:
                    stack.append((waiting, depth))
                    depth += end - starts[node]
                    waiting = iter(children[node])
                    break
                leaves.append(starts[node] - depth)
            else:
                if not stack:
                    break
                waiting, depth = stack.pop()
        reverse = np.empty(self.n + 1, np.int64)
        reverse[leaves] = np.arange(self.n + 1)
        return rank.tolist(), reverse.tolist()

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common words from places i and from places j on; a place may be the end, n."""
        a, b = self.at[i], self.at[j]
        low, high = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp(high - low + 1)[1] - 1  # two overlapping stretches of 2 ** level
        out = np.zeros(len(i), np.int64)
        least = self.tour
        for k in range(int(level.max(initial=0)) + 1):  # the sparse table, a level at a time
            if k:
                half = 1 << (k - 1)
                least = np.minimum(least[:-half], least[half:])
            mine = np.flatnonzero(level == k)
            out[mine] = np.minimum(least[low[mine]], least[high[mine] - (1 << k) + 1])
        same = a == b
        out[same] = self.n - i[same]
        return out


def _ukkonen(words: list[int]) -> tuple[list[int], list[int], dict[int, int], int]:
    """Nodes' edge starts and ends (-1: a leaf's, at the text's end) and the edges, by parent and first symbol.

    The text is ``words``, each one higher, and the end mark 0. Edge ``p * width + c`` leads
    from node p by symbol c. Online: each symbol adds the suffixes that are not there yet,
    found from one another by suffix links.
    """
    text = [w + 1 for w in words]
    text.append(0)
    width = max(text) + 1
    starts, ends, links, edges = [0], [0], [0], {}
    node = length = waiting = first = 0
    find = edges.get
    for i, c in enumerate(text):
        waiting += 1
        made = 0
        while waiting:
            if not length:
                first = i
            key = node * width + text[first]
            child = find(key)
            if child is None:
                edges[key] = len(starts)
                starts.append(i)
                ends.append(-1)
                links.append(0)
                if made:
                    links[made] = node
                    made = 0
            else:
                start, end = starts[child], ends[child]
                size = (i + 1 if end < 0 else end) - start
                if length >= size:
                    first += size
                    length -= size
                    node = child
                    continue
                seen = text[start + length]
                if seen == c:
                    length += 1
                    if made:
                        links[made] = node
                    break
                split = len(starts)
                starts += (start, i)
                ends += (start + length, -1)
                links += (0, 0)
                edges[key] = split
                starts[child] = start + length
                edges[split * width + seen] = child
                edges[split * width + c] = split + 1
                if made:
                    links[made] = split
                made = split
            waiting -= 1
            if node:
                node = links[node]
            elif length:
                length -= 1
                first = i - waiting + 1
    return starts, ends, edges, width


# ------------------------------------------------------------------------------------- runs
def _next_smaller(rank: list[int], n: int) -> np.ndarray:
    """For each place, the next one whose suffix sorts before its own (n if none): where its longest Lyndon word ends."""
    out, stack = [n] * n, []
    for i in range(n - 1, -1, -1):
        r = rank[i]
        while stack and rank[stack[-1]] > r:
            stack.pop()
        if stack:
            out[i] = stack[-1]
        stack.append(i)
    return np.array(out, np.int64)


def runs_of(words: list[int], min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """All runs of ``words`` as (start, length, period), by start, then period."""
    n = len(words)
    if n < min_words:
        return []
    forward, backward = SuffixTree(words), SuffixTree(words[::-1])
    i = np.tile(np.arange(n), 2)
    j = np.concatenate([_next_smaller(rank, n) for rank in forward.ranks()])
    some = (j - i) * min_periods <= n
    i, j = i[some], j[some]
    period = j - i
    end = j + forward.lce(i, j)
    start = i - backward.lce(n - i, n - j)
    length = end - start
    good = length >= np.maximum(min_words, min_periods * period)
    found = np.unique(np.stack([start, period, length], axis=1)[good], axis=0)
    return [(s, size, p) for s, p, size in found.tolist()]


def gram_length(min_words: int, min_periods: int) -> int:
    """The longest word sequences that recur, each of them, inside every run.

    Of a run of L words with period q, a sequence of g words has another q before or after
    it inside the run if L >= 2 * q + g - 1.
    """
    return min(max(min_words, min_periods * q) - 2 * q + 1 for q in range(1, min_words + 1))


_MIX = np.random.default_rng(12).integers(1, 1 << 63, 64, np.uint64) | np.uint64(1)


def _covered(ids: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """Places in word sequences of ``size`` that recur in the same text; ``first`` numbers each word's text."""
    n = len(ids) - size + 1
    covered = np.zeros(len(ids), bool)
    if n < 2:
        return covered
    value = first[:n].astype(np.uint64) * _MIX[0]
    for k in range(size):
        value = value * _MIX[1] + (ids[k : k + n].astype(np.uint64) + np.uint64(1)) * _MIX[2 + k % 60]
    order = np.argsort(value)
    sorted_ = value[order]
    equal = sorted_[1:] == sorted_[:-1]
    recurs = np.zeros(n, bool)
    recurs[order[1:][equal]] = recurs[order[:-1][equal]] = True
    recurs &= first[:n] == first[size - 1 :]
    for k in range(size):
        covered[k : k + n] |= recurs
    return covered


def _stretches(ids: np.ndarray, text: np.ndarray, min_words: int, min_periods: int) -> Iterator[tuple[int, int]]:
    """Stretches (begin, end) of the texts' words that can hold a run, cut down as long as that helps.

    Equal sequences have equal hashes, so a clash only leaves a stretch too long.
    """
    size = gram_length(min_words, min_periods)
    waiting = [(0, len(ids), text)]
    while waiting:
        begin, end, first = waiting.pop()
        covered = _covered(ids[begin:end], first, size)
        covered = np.concatenate([[False], covered, [False]])
        change = np.flatnonzero((covered[1:] != covered[:-1]) | np.concatenate([[False], first[1:] != first[:-1], [False]]) & covered[1:])
        if len(change) == 2 and change[0] == 0 and change[1] == end - begin and (first == first[0]).all():
            yield begin, end
            continue
        for a, b in zip(change[:-1].tolist(), change[1:].tolist(), strict=True):
            if covered[a + 1] and b - a >= min_words:
                waiting.append((begin + a, begin + b, np.zeros(b - a, np.int64)))


# ---------------------------------------------------------------------------------- texts
def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in a row, and where each text's begin."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
    flat, ends = lists.flatten(), lists.offsets.to_numpy()
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)  # white space at a text's ends
    before = np.concatenate([[0], np.cumsum(real)])
    return flat.filter(pa.array(real)), before[ends - ends[0]]


def _scan(texts: pa.Array, min_words: int, min_periods: int) -> pa.StructArray:
    """Struct of the number of words, the runs and the collapsed text of each text."""
    words, begin = _words(texts)
    if len(words):
        ids = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    else:
        ids = np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(texts)), np.diff(begin))
    drop = np.zeros(len(ids), bool)
    found: dict[int, list[tuple[int, int, int]]] = {}
    for a, b in _stretches(ids, text, min_words, min_periods):
        _, local = np.unique(ids[a:b], return_inverse=True)
        runs = runs_of(local.tolist(), min_words, min_periods)
        if runs:
            k = int(text[a])
            at = a - int(begin[k])
            found.setdefault(k, []).extend((at + s, size, p) for s, size, p in runs)
            for s, size, p in runs:
                drop[a + s + p : a + s + size] = True
    kept = words.filter(pa.array(~drop)) if drop.any() else words
    kept_begin = np.concatenate([[0], np.cumsum(~drop)])[begin]
    collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept_begin, pa.int32()), kept), " ")
    runs = [sorted(found.get(k, ()), key=lambda r: (r[0], r[2])) for k in range(len(texts))]
    ends = np.cumsum([0] + [len(r) for r in runs])
    flat = np.array([x for r in runs for x in r], np.int64).reshape(-1, 3)
    each = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], ["start", "length", "period"])
    listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), each)
    return pa.StructArray.from_arrays([pa.array(np.diff(begin)), listed, collapsed], ["n_words", "runs", "collapsed"])


def _scanner(min_words: int, min_periods: int):
    def run(texts: pa.Array) -> pa.Array:
        worker_keeps()  # nothing of an earlier stage
        if not len(texts):
            return _scan(texts, min_words, min_periods)
        step = max(1, len(texts) * PART_BYTES // max(1, texts.nbytes))
        return pa.concat_arrays([_scan(texts.slice(k, step), min_words, min_periods) for k in range(0, len(texts), step)])

    return F.arrow_udf(run, f"n_words bigint, runs {RUNS}, collapsed string")


def find_runs(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> DataFrame:
    """Adds n_words, ``runs`` (start, length, period in words, by start and period) and ``collapsed``.

    Words are runs without ASCII white space. A run is a stretch with smallest period q, of
    ``min_words`` words and ``min_periods`` periods or more, that no neighbouring word
    continues; ``collapsed`` is the text without the words that some run has after its first
    q, joined by one space. A null or empty text has no words, no runs and an empty
    ``collapsed``. Whole texts are scanned; a text whose words all repeat takes about 1 KB of
    memory a word for its trees. Every row is on its own, repeated rows agree, and an
    empty table stays empty. Input columns of the three names are replaced, no other is touched.
    """
    if min_periods < 2 or min_words < 1:
        raise ValueError("a run has at least two periods and a word")
    added = ("n_words", "runs", "collapsed")
    kept = [c for c in docs.columns if c not in added]
    quoted = {c: F.col("`" + c.replace("`", "``") + "`") for c in docs.columns}
    found = _scanner(min_words, min_periods)(quoted[text])
    out = docs.select(F.struct(*[quoted[c].alias(c) for c in kept]).alias("row"), found.alias("found"))
    return out.select(*[F.col("row")[c].alias(c) for c in kept], *[F.col("found")[c].alias(c) for c in added])


# --------------------------------------------------------------------------------- queries
def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Columns doc_id and text; in one document of ten the words from some place on repeat periodically.

    By the CRC of doc_id, as the query's contract has it; a null doc_id leaves its text as it is.
    """
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = docs.select("doc_id", "text", h.alias("h"))
    docs = docs.withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("words"))
    g = F.floor(F.col("h") / 10)
    a = (g % F.col("n")).cast("int")
    docs = docs.withColumns({"a": F.when(F.col("n") > 0, a), "g": g})
    p = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    docs = docs.withColumn("p", p)
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    repeated = F.transform("words", lambda w, i: F.get("words", place(i)))
    text = F.when(F.col("a").isNotNull(), F.array_join(repeated, " ")).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def op12_periods(spark, sf_dir: str) -> DataFrame:
    """The runs of every document, the longest of them, and a digest of what stays."""
    docs = with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = find_runs(docs)
    number = lambda r, *names: [r[n].cast("string") for n in names]
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", *number(r, "start", "length", "period")), F.lit("\n"))), "")
    key = F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("start"), r["period"].alias("period")))
    found = found.withColumn("best", F.array_min(key))
    length = -F.col("best")["l"]
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best")["start"].alias("start"),
        length.alias("length"),
        F.col("best")["period"].alias("period"),
        F.floor(1000 * length / F.col("best")["period"]).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


#: Runs as islands of equal words a period apart; of several periods of one stretch the smallest.
OP12_SQL = r"""
WITH tab AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256))::BIGINT AS i)),
split AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    xor(list_reduce(list_concat([4294967295::BIGINT], [ord(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')]),
      lambda c, x: xor(c >> 8, tab.t[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM documents, tab),
planted AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM (SELECT *, len(words) AS n, h // 10 AS g FROM split)),
periodic AS (SELECT rid, doc_id, words, a, 1 + (n - a) // (3 + g % 8) AS p, n FROM planted),
word AS (SELECT rid, n, i, words[CASE WHEN i >= a THEN a + (i - a) % p ELSE i END + 1] AS w
  FROM (SELECT rid, n, words, a, p, unnest(range(n)) AS i FROM periodic)),
matches AS (SELECT x.rid, x.i, y.i - x.i AS q FROM word x JOIN word y ON x.rid = y.rid AND x.w = y.w AND y.i > x.i AND y.i - x.i <= x.n // 4),
islands AS (SELECT rid, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM matches) GROUP BY rid, q, island),
runs AS (SELECT rid, start, length, min(q) AS period FROM islands WHERE length >= greatest(6, 4 * q) GROUP BY rid, start, length),
listed AS (SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
    first({'start': start, 'length': length, 'period': period} ORDER BY length DESC, start, period) AS best FROM runs GROUP BY rid),
gone AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT rid, string_agg(w, ' ' ORDER BY i) AS collapsed FROM word ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
  (1000 * best.length) // best.period AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM split LEFT JOIN listed USING (rid) LEFT JOIN kept USING (rid)
"""
