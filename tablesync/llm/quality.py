"""Quality rules by weak supervision, with DataFrame and SQL functions only.

Each rule looks at a few counts of a document and votes good or bad, or abstains. Nobody
says how far a rule is to be trusted: expectation-maximisation estimates each rule's
accuracy from how the rules agree over all documents. A document is kept by its posterior
probability of being good, so one broken rule need not throw it out.

Documents meet the estimation only as counts of equal votes: at most ``3 ** rules`` rows,
whatever the corpus, summed map-side. All rounds run in one expression over those rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, table

#: ASCII white space, as the queries' contracts have it.
BLANK = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
#: Counts that ``measure`` adds.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_upper", "n_sentences", "n_shouts")

#: More rules than this have too many combinations of votes to broadcast (3 ** 10 = 59,049).
MAX_RULES = 10
#: Part of good documents that the posterior starts from, and the probability that is enough.
BALANCE, THRESHOLD = 0.5, 0.5
ROUNDS = 40
#: What is known of a rule beforehand, as votes: right and wrong ones.
PRIOR_RIGHT, PRIOR_WRONG = 8.0, 2.0


def _ratio(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def _between(x: Column, least: float, most: float) -> Column:
    return (x >= least) & (x <= most)


def default_rules() -> dict[str, tuple[Column, Column]]:
    """Rules as (votes good where, votes bad where) on the counts; neither is to abstain.

    What a defect shows in is voted on by one rule each, which abstains where it shows
    none: its absence says little. Two rules vote for documents that read like prose.
    """
    never = F.lit(False)
    length = _ratio("word_chars", "n_words")
    letters, upper = _ratio("n_letters", "word_chars"), _ratio("n_upper", "n_letters")
    symbols, repeated, copied = _ratio("n_symbols", "n_words"), _ratio("n_repeat_words", "n_words"), _ratio("n_dup_lines", "n_lines")
    sentences = _between(_ratio("n_sentences", "n_words"), 0.02, 0.25) & (upper <= 0.2) & (symbols <= 0.1)
    plain = _between(length, 3, 10) & (letters >= 0.9) & (symbols <= 0.02)
    return {
        "sentences": (sentences, never),
        "plain_words": (plain, never),
        "word_length": (never, ~_between(length, 2.5, 14)),
        "letters": (never, letters < 0.7),
        "symbols": (never, symbols > 0.1),
        "capitals": (never, upper > 0.4),
        "shouts": (never, _ratio("n_shouts", "n_words") > 0.1),
        "repeated_words": (never, repeated > 0.3),
        "copied_lines": (never, copied > 0.3),
    }


# ---------------------------------------------------------------------------------- counts
def _with_repeated(df: DataFrame) -> DataFrame:
    """Column ``repeated``: how many of ``words`` are in windows of three that are found twice or more.

    Windows are compared by 64-bit hashes inside their document. Only a document with a
    repeated window sorts its windows, by hash and place.
    """
    n = F.size("words")
    window = lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), window)).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("windows", windows)
    sort = F.sort_array(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    df = df.withColumn("ordered", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), sort))
    like = lambda x, i: F.coalesce(x["w"] == F.get("ordered", i)["w"], F.lit(False))
    twice = F.filter("ordered", lambda x, i: like(x, i - 1) | like(x, i + 1))
    df = df.withColumn("places", F.sort_array(F.transform(twice, lambda x: x["i"])))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    cover = lambda s, x: F.struct(x.alias("last"), (s["n"] + F.least(F.lit(3), x - s["last"])).alias("n"))
    covered = F.aggregate("places", start, cover, lambda s: s["n"])
    return df.withColumn("repeated", F.coalesce(covered, F.lit(0).cast("long")))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the counts ``COUNTS``, all long, to every row of ``docs``.

    Words are runs without ASCII white space; symbols are ``#*$%&|<>``; n_dup_lines are
    lines with a word that equal an earlier line; n_repeat_words are words in windows of
    three words found twice or more in the text, the first included; n_lines are lines with
    a word. A null text counts as an empty one. Whole texts are counted. Every row is on
    its own: rows that repeat agree, an empty table stays empty. Input columns named like a
    count are replaced, no other is touched.
    """
    kept = [c for c in docs.columns if c not in COUNTS]
    df = docs.select(F.struct(*[F.col(_quoted(c)) for c in kept]).alias("row"), F.coalesce(F.col(_quoted(text)), F.lit("")).alias("text"))
    df = _with_repeated(df.withColumn("words", F.array_remove(F.split("text", f"{BLANK}+"), "")))
    df = df.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]"))))
    count = lambda pattern: F.regexp_count("text", F.lit(pattern))
    counts = {
        "n_words": F.size("words"),
        "word_chars": F.length("text") - count(BLANK),
        "n_symbols": count(SYMBOLS),
        "n_lines": F.size("lines"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": F.col("repeated"),
        "n_letters": F.length("text") - count(r"\P{L}"),
        "n_upper": count(r"\p{Lu}"),
        "n_sentences": count(r"[.!?](?=[\x20\x09-\x0D]|\z)"),
        "n_shouts": count(r"[!?]{2,}"),
    }
    df = df.select("row", *[counts[c].cast("long").alias(c) for c in COUNTS])
    return df.select(*[F.col("row")[c].alias(c) for c in kept], *COUNTS)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# ------------------------------------------------------------------------------ estimation
def vote_columns(rules: dict[str, tuple[Column, Column]]) -> Column:
    """The rules' votes in order as an array: 1 good, -1 bad, 0 abstains (null conditions too)."""
    return F.array(*[F.when(good, 1).when(bad, -1).otherwise(0) for good, bad in rules.values()])


def estimate(votes: DataFrame, rules: int, rounds: int = ROUNDS, balance: float = BALANCE) -> DataFrame:
    """Expectation-maximisation over rows (votes array<int>, n long), one for each combination.

    Returns one row with ``accuracy``: for each rule, how often a vote of its is right, be it
    good or bad. It starts from the votes' majority. ``PRIOR_RIGHT`` and ``PRIOR_WRONG``
    votes come on top of each rule's, so a rule without votes says little and none is
    certain; no rule counts as worse than a coin. Without rows the priors remain.
    """
    cell = votes.agg(F.array_sort(F.collect_list(F.struct("votes", F.col("n").cast("double").alias("n")))).alias("seen"))

    def maximise(posterior: Callable[[Column], Column]) -> Column:
        """Accuracies from the posterior of each combination, in one pass over them."""

        def add(sums: Column, x: Column) -> Column:
            right = lambda p: lambda v: F.when(v == 1, x["n"] * p).when(v == -1, x["n"] * (1 - p))
            return _let(
                posterior(x),
                lambda p: F.struct(
                    _plus(sums["right"], x["votes"], right(p)).alias("right"),
                    _plus(sums["all"], x["votes"], lambda v: F.when(v != 0, x["n"])).alias("all"),
                ),
            )

        def rate(right: Column, whole: Column) -> Column:
            return F.greatest(F.lit(0.5), (right + PRIOR_RIGHT) / (whole + (PRIOR_RIGHT + PRIOR_WRONG)))

        zeros = F.array_repeat(F.lit(0.0), rules)
        return F.aggregate("seen", F.struct(zeros.alias("right"), zeros.alias("all")), add, lambda s: F.zip_with(s["right"], s["all"], rate))

    def majority(x: Column) -> Column:
        count = lambda vote: F.size(F.filter(x["votes"], lambda v: v == vote))
        return (count(1) + 1.0) / (count(1) + count(-1) + 2.0)

    accuracy = F.aggregate(
        F.sequence(F.lit(1), F.lit(rounds)),
        maximise(majority),
        lambda known, _: maximise(lambda x: posterior_good(x["votes"], known, balance)),
    )
    return cell.select(accuracy.alias("accuracy"))


def posterior_good(votes: Column, accuracy: Column, balance: float = BALANCE) -> Column:
    """Probability that a document with these votes is good; votes are independent given that."""
    weight = F.zip_with(votes, accuracy, lambda v, a: v * (F.log(a) - F.log(1 - a)))
    odds = F.aggregate(weight, F.lit(math.log(balance / (1 - balance))), lambda s, w: s + w)
    return 1 / (1 + F.exp(-odds))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _plus(sums: Column, votes: Column, part: Callable[[Column], Column]) -> Column:
    return F.zip_with(sums, votes, lambda s, v: s + F.coalesce(part(v), F.lit(0.0)))


# --------------------------------------------------------------------------------- verdict
def judge(
    measured: DataFrame,
    rules: dict[str, tuple[Column, Column]] | None = None,
    threshold: float = THRESHOLD,
    rounds: int = ROUNDS,
    balance: float = BALANCE,
) -> DataFrame:
    """Adds ``votes`` (array, in the rules' order), ``quality`` and ``good`` to every row.

    ``quality`` is the posterior probability of a good document, ``good`` whether it reaches
    ``threshold``. The rules are conditions on columns of ``measured``; the estimate is made
    over all its rows, which are written to the shared folder first. A rule whose
    conditions are null abstains; rows without a vote have ``balance`` as quality. Every row
    gets its verdict, repeated rows the same; an empty table stays empty. Input columns of
    the three names are replaced, no other is touched.
    """
    rules = default_rules() if rules is None else rules
    if not 1 <= len(rules) <= MAX_RULES:
        raise ValueError(f"{len(rules)} rules; from 1 to {MAX_RULES} are possible")
    kept = [c for c in measured.columns if c not in ("votes", "quality", "good")]
    row = F.struct(*[F.col(_quoted(c)) for c in kept])
    voted = saved(measured.select(row.alias("row"), vote_columns(rules).alias("votes")), "quality-votes")
    seen = saved(voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")), "quality-combinations")
    model = estimate(seen, len(rules), rounds, balance)
    # One row of accuracies, and a row for each combination of votes: bounded by the rules, checked above.
    known = seen.join(F.broadcast(model)).select("votes", posterior_good(F.col("votes"), F.col("accuracy"), balance).alias("quality"))
    out = voted.join(F.broadcast(known), "votes", "left")
    return out.select(*[F.col("row")[c].alias(c) for c in kept], "votes", "quality", (F.col("quality") >= threshold).alias("good"))


# --------------------------------------------------------------------------------- queries
def op13_quality(spark, sf_dir: str) -> DataFrame:
    """Counts of every document, whether it fails the base rules, and whether it is kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = judge(measure(docs).drop("text"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(*base, failed.alias("base_failed"), (~failed & F.col("good")).alias("kept"), "quality")
