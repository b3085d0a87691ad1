"""Language ID by cross-parsing entropy.

A language's training text becomes a suffix automaton, which accepts exactly the strings
that occur in it. A text is parsed against each language: from where the last phrase
ended, take the longest match that the automaton has, count a phrase, go on behind it; a
character that the language lacks belongs to the phrase that it ends, or is one. The
better a language's text foretells another, the longer the matches and the fewer the
phrases. The language that needs the fewest phrases, normalised by the logarithm of its
training text's length, wins.

The automata's transitions are kept in one hash table, whose size follows the length of the
training text and not that of the alphabet. Many texts are parsed in step with one another
by numpy: a few array operations move every text and language on by a character.
Texts are parsed whole, in segments of ``SEGMENT`` letters and spaces that are side by side
in those arrays; a phrase ends where a segment ends.

The model is small text, learnt from a bounded sample: ``rows_per_language`` labelled rows
in a hashed order, of each ``windows`` windows of ``window_chars`` characters spread evenly
from its begin to its end, for ``max_languages`` languages at most. Workers build their
tables from it once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import saved, table, worker_keeps

SEGMENT = 2048
#: Segments parsed side by side, and characters of a text that are looked at at a time.
LANES = 2048
UNDETERMINED = "und"
_CODES, _SPACE = 0x110000, 32


# ------------------------------------------------------------------------------- the model
def held_out(doc_id: str | Column) -> Column:
    """True where crc32 of doc_id as text is divisible by 5; a null doc_id is not held out."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_text(
    labelled: DataFrame, rows_per_language: int = 64, windows: int = 4, window_chars: int = 150, max_languages: int = 256
) -> list[tuple[str, str]]:
    """Sample of (lang, text) rows, joined by language.

    Rows without text or lang are left out. Which rows: the first by a hash of the text, so
    copies of a text count once and the table's order doesn't matter. Of a text as long as
    all windows or shorter the sample has the whole. More than ``max_languages`` different
    values of lang are an error, raised before anything is gathered.
    """
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL AND length(text) > 0").withColumn("h", F.xxhash64("text"))
    hashes = rows.select("lang", "h").distinct()
    first = lambda *by: F.row_number().over(W.partitionBy(*by).orderBy("h"))
    # In two steps, so a language is cut down in many tasks before it meets in one.
    hashes = hashes.withColumn("salt", F.pmod("h", F.lit(64))).withColumn("n", first("lang", "salt")).where(F.col("n") <= rows_per_language)
    hashes = hashes.withColumn("n", first("lang")).where(F.col("n") <= rows_per_language).select("lang", "h")
    taken = saved(hashes, "language-sample")
    langs = len(taken.select("lang").distinct().take(max_languages + 1))
    if langs > max_languages:
        raise ValueError(f"more than {max_languages} different languages")
    # At most max_languages * rows_per_language rows.
    rows = rows.join(F.broadcast(taken), ["lang", "h"], "left_semi")
    last = F.length("text") - window_chars
    spread = [F.substring("text", F.floor(last * k / max(1, windows - 1)).cast("int") + 1, F.lit(window_chars)) for k in range(windows)]
    sample = F.when(F.length("text") <= windows * window_chars, F.col("text")).otherwise(F.concat_ws(" ", *spread))
    rows = rows.select("lang", "h", sample.alias("text")).distinct()
    found = rows.groupBy("lang").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("h", "text"))), lambda x: x["text"]), " ").alias("text"))
    return sorted((r["lang"], r["text"]) for r in found.collect())


def suffix_automaton(text: np.ndarray) -> list[dict[int, int]]:
    """Transitions of each state, state 0 first; every path spells a substring of ``text``."""
    links, lengths, steps = [-1], [0], [{}]
    last = 0
    for c in text.tolist():
        new = len(steps)
        steps.append({})
        lengths.append(lengths[last] + 1)
        links.append(0)
        p = last
        while p >= 0 and c not in steps[p]:
            steps[p][c] = new
            p = links[p]
        if p >= 0:
            q = steps[p][c]
            if lengths[q] == lengths[p] + 1:
                links[new] = q
            else:
                clone = len(steps)
                steps.append(dict(steps[q]))
                lengths.append(lengths[p] + 1)
                links.append(links[q])
                links[q] = links[new] = clone
                while p >= 0 and steps[p].get(c) == q:
                    steps[p][c] = clone
                    p = links[p]
        last = new
    return steps


class Parser:
    """The transitions of all languages in one hash table, and the parse.

    State ``s`` goes on by symbol ``c`` if slot ``base[s] + c`` belongs to ``s``: each state
    has a base for which its slots are its own, so one look tells.
    """

    def __init__(self, model: list[tuple[str, str]]):
        self.langs = [lang for lang, _ in model]
        self.fold = _fold()
        folded = [self._letters(text) for _, text in model]
        known = np.unique(np.concatenate(folded)) if folded else np.zeros(0, np.uint32)
        # Symbol 0: a character that no training text has.
        self.symbol = np.zeros(_CODES, np.uint16 if len(known) < 0xFFFF else np.int32)
        self.symbol[known] = np.arange(1, len(known) + 1)
        states, symbols, targets, self.roots, at = [], [], [], [], 0
        for text in folded:
            steps = suffix_automaton(np.searchsorted(known, text) + 1)
            states.append(np.repeat(np.arange(at, at + len(steps)), [len(out) for out in steps]))
            symbols.append(np.array([c for out in steps for c in out], np.int64))
            targets.append(np.array([at + to for out in steps for to in out.values()], np.int64))
            self.roots.append(at)
            at += len(steps)
        if folded:
            states, symbols, targets = np.concatenate(states), np.concatenate(symbols), np.concatenate(targets)
            self._place(at, states, symbols, targets, len(known) + 1)
        self.scale = np.array([np.log2(max(2, len(t))) for t in folded])

    def _place(self, n: int, states: np.ndarray, symbols: np.ndarray, targets: np.ndarray, width: int) -> None:
        """Bases by trial, those with many transitions first; the table grows if that takes too long."""
        slots = 1 << int(max(4 * len(states), width) - 1).bit_length()
        while not self._placed(n, states, symbols, targets, slots):
            slots *= 2

    def _placed(self, n: int, states: np.ndarray, symbols: np.ndarray, targets: np.ndarray, slots: int) -> bool:
        draw = np.random.default_rng(0)
        self.mask = np.int32(slots - 1)
        self.base, self.to = np.zeros(n, np.int32), np.zeros(slots, np.int32)
        self.owner, claim = np.full(slots, -1, np.int32), np.empty(slots, np.int32)
        size = np.frexp(np.bincount(states, minlength=n))[1][states]
        for k in range(size.max(initial=0), 0, -1):
            left = np.flatnonzero(size == k)
            for _ in range(200):
                if not len(left):
                    break
                s = states[left]  # in order, so a state's transitions are side by side
                group = np.cumsum(np.diff(s, prepend=s[0]) != 0)
                self.base[s] = draw.integers(0, slots, group[-1] + 1)[group]
                at = (self.base[s] + symbols[left]) & self.mask
                claim[at] = s
                good = (np.bincount(group, (self.owner[at] >= 0) | (claim[at] != s)) == 0)[group]
                self.owner[at[good]], self.to[at[good]] = s[good], targets[left[good]]
                left = left[~good]
            if len(left):
                return False
        return True

    def _letters(self, text: str) -> np.ndarray:
        """Letters in lower case; whatever stands between them becomes one space."""
        folded = self.fold[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
        again = folded == _SPACE
        again[1:] &= again[:-1].copy()
        again[:1] = False
        return folded[~again]

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases that each text (rows) needs in each language (columns)."""
        counts = np.zeros((len(texts), len(self.langs)), np.int64)
        owners, pieces = [], []
        for k, text in enumerate(texts):
            for at in range(0, len(text), SEGMENT * LANES):
                symbols = self.symbol[self._letters(text[at : at + SEGMENT * LANES])]
                cut = [symbols[i : i + SEGMENT] for i in range(0, len(symbols), SEGMENT)]
                pieces += cut
                owners += [k] * len(cut)
                if len(pieces) >= LANES:
                    self._parse(pieces, owners, counts)
                    owners, pieces = [], []
        self._parse(pieces, owners, counts)
        return counts

    def _parse(self, pieces: list[np.ndarray], owners: list[int], counts: np.ndarray) -> None:
        if not pieces or not self.langs:
            return
        lengths = np.array([len(p) for p in pieces])
        order = np.argsort(-lengths, kind="stable")
        lengths = lengths[order]
        lanes = np.zeros((len(pieces), lengths[0]), self.symbol.dtype)
        for lane, i in enumerate(order):
            lanes[lane, : len(pieces[i])] = pieces[i]
        grid = np.ascontiguousarray(lanes.T)  # a row holds one character of every piece
        roots = np.array(self.roots, np.int32)[:, None]
        state = np.repeat(roots, len(pieces), axis=1)
        found = np.zeros(state.shape, np.int32)
        alive = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # pieces longer than t
        for t, n in enumerate(alive.tolist()):
            old, symbols = state[:, :n], grid[t, :n].astype(np.int32)
            at = (self.base.take(old) + symbols) & self.mask
            new, miss = self.to.take(at), self.owner.take(at) != old
            found[:, :n] += miss
            # A phrase ended; the next one begins with this character, if the language has it.
            lang, lane = np.nonzero(miss)
            root = roots[lang, 0]
            at = (self.base[root] + symbols[lane]) & self.mask
            new[lang, lane] = np.where(self.owner[at] == root, self.to[at], root)
            state[:, :n] = new
        found += state != roots  # the phrase that was open at the end
        np.add.at(counts, np.asarray(owners)[order], found.T)


def _fold() -> np.ndarray:
    """Lower case for letters; a space for any other character."""
    out = np.full(_CODES, _SPACE, np.uint32)
    for c in range(_CODES):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


# ------------------------------------------------------------------------------ prediction
def best(parser: Parser, counts: np.ndarray) -> tuple[list[str | None], np.ndarray]:
    """The language with the fewest normalised phrases, and how far the next one is behind.

    The score is 1 - fewest / next fewest: 0 for a tie, near 1 if no other comes close,
    1 where there is one language only. Ties go to the first language in code point order.
    """
    cost = counts * parser.scale
    first = cost.argmin(axis=1)
    rows = np.arange(len(cost))
    least = cost[rows, first]
    if cost.shape[1] == 1:
        return [parser.langs[i] for i in first], np.ones(len(cost))
    cost[rows, first] = np.inf
    return [parser.langs[i] for i in first], 1 - least / np.maximum(cost.min(axis=1), 1e-12)


def _letters_in(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def has_letters(text: str) -> Column:
    """True where ``identify`` looks for a language; false for null."""

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(_letters_in).astype(bool)

    return F.pandas_udf(run, "boolean")(text)


def _predict(model: list[tuple[str, str]]):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        parser = worker_keeps(("languages", *model), lambda: Parser(model))
        for texts in batches:
            langs, scores = np.full(len(texts), UNDETERMINED, object), np.zeros(len(texts))
            use = np.flatnonzero([_letters_in(t) for t in texts]).tolist()
            if use and parser.langs:
                counts = parser.phrases([texts.iloc[i] for i in use])
                langs[use], scores[use] = best(parser, counts)
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    return run


def identify(docs: DataFrame, model: list[tuple[str, str]]) -> DataFrame:
    """Adds lang_pred and score (0 to 1) to every row of ``docs``; only text is looked at.

    ``und`` and 0 where text is null or has no letter, or the model has no language. Input
    columns of these names are replaced; every row is on its own, so repeated rows agree.
    """
    # Not to be moved or repeated: a filter on the prediction would else predict a second time.
    predict = F.pandas_udf(_predict(model), "lang_pred string, score double").asNondeterministic()
    found = "found"
    while found in docs.columns:
        found += "_"
    # Beside the given columns and not around them: the rows wait for Python, and a text is in them once.
    out = docs.drop("lang_pred", "score").withColumn(found, predict("text"))
    return out.withColumns({"lang_pred": F.col(found)["lang_pred"], "score": F.col(found)["score"]}).drop(found)


def learn(docs: DataFrame, **bounds: int) -> list[tuple[str, str]]:
    """The model, from the documents that are not held out."""
    return training_text(docs.where(~held_out("doc_id")).select("lang", "text"), **bounds)


# --------------------------------------------------------------------------------- queries
def op9_language_id(spark, sf_dir: str) -> DataFrame:
    """The language predicted for every document."""
    docs = table(spark, sf_dir, "documents")
    model = learn(docs.select("doc_id", "lang", "text"))
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
