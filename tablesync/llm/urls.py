"""URL filters: fixed rules by host and path, and rules mined from labelled URLs.

Spark's FP-growth finds token combinations that are frequent among labelled URLs; rules
from a combination to the label "bad" that are confident and supported enough stay, less
those that a shorter rule makes needless. They are looked up by an inverted index: each
rule stands under its rarest token, and a URL's tokens find the rules to be tried.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_spread, saved, table

BAD = "label=bad"
#: Least support: this part of the labelled URLs and this number of them.
MIN_SUPPORT, MIN_COUNT = 0.002, 20
MIN_CONFIDENCE = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: str) -> dict[str, Column]:
    """Columns host (A-Z lower-cased) and path; both empty for null and without ``://``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.col(url).substr(at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return {
        "host": F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER),
        "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
    }


def fitting_rule(rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest of ``rules`` (host, path, verdict) that fits columns host and path, and its verdict.

    A rule fits its host and all subdomains if the path starts with the rule's. Of rules as
    long, the first in the list wins.
    """
    name, verdict = [], []
    for host, path, says in sorted(rules, key=lambda r: -len(r[0] + r[1])):
        ours = (F.col("host") == host) | F.endswith("host", F.lit(f".{host}"))
        fits = ours & F.startswith("path", F.lit(path))
        name.append(F.when(fits, F.lit(host + path)))
        verdict.append(F.when(fits, F.lit(says)))
    none = F.lit(None).cast("string")
    return F.coalesce(*name, none), F.coalesce(*verdict, none)


def url_tokens(url: str = "url") -> Column:
    """Distinct tokens of a URL: its domains, path segments, query keys and scheme."""
    parts = host_and_path(url)
    labels = F.split(parts["host"], r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.lit("host="), F.array_join(F.slice(labels, i, F.size(labels)), "."))
    )
    segments = F.transform(F.split(parts["path"], "/"), lambda s: F.concat(F.lit("path="), F.lower(s)))
    asked = F.regexp_extract_all(F.col(url), F.lit(r"[?&]([^=&#?]+)"), F.lit(1))
    keys = F.transform(asked, lambda s: F.concat(F.lit("key="), F.lower(s)))
    scheme = F.array(F.concat(F.lit("scheme="), F.lower(F.substring_index(url, "://", 1))))
    tokens = F.array_distinct(F.concat(domains, segments, keys, scheme))
    tokens = F.filter(tokens, lambda t: ~t.isin("path=", "host="))
    return F.when(parts["host"] != "", tokens).otherwise(F.array().cast("array<string>"))


def token_classes(items: DataFrame, min_count: int) -> DataFrame:
    """Rows (token, part, n): tokens in ``min_count`` rows or more, and one that stands for all in the same rows.

    ``items`` has row and tokens. Two tokens are in the same rows if the rows' hashes, 128
    bits each, have the same exclusive or and number. ``part`` is the least such token.
    """
    each = items.select("row", F.explode("tokens").alias("token"))
    seen = each.groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("row")).alias("a"), F.bit_xor(F.xxhash64(F.lit(1), "row")).alias("b")
    )
    seen = seen.where(F.col("n") >= min_count)
    least = seen.groupBy("n", "a", "b").agg(F.min("token").alias("part"))
    return seen.join(least, ["n", "a", "b"]).select("token", "part", "n")


def mine_rules(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE
) -> DataFrame:
    """Rules (rule_id, tokens, anchor, confidence, support, members) from ``labelled`` (url, bad).

    Rows without url or label are left out. A rule needs ``min_confidence``, to be likelier
    than bad URLs are anyway, and a combination seen with "bad" in ``min_support`` of all
    labelled rows and ``min_count`` of them; one whose tokens include another rule's with
    at least its confidence is left out.

    Tokens that occur in exactly the same labelled rows, as all those of a URL that is
    repeated, are mined as one and stand for each other: ``tokens`` has the one, ``members``
    all that count for each of ``tokens``. So copies of a long URL are no more work than a
    token. URLs that are alike but for a token or two, with many tokens, still give many
    combinations. ``anchor`` is the rule's rarest token.
    """
    spark = labelled.sparkSession
    rows = labelled.where("url IS NOT NULL AND bad IS NOT NULL")
    rows = rows.select(F.monotonically_increasing_id().alias("row"), url_tokens().alias("tokens"), "bad")
    items = saved(rows, "url-items")
    n = items.count()
    shape = "rule_id string, tokens array<string>, anchor string, confidence double, support double, members array<array<string>>"
    least = max(min_count, math.ceil(min_support * n))
    if n == 0 or least > n:
        return spark.createDataFrame([], shape)
    classes = saved(token_classes(items, least), "url-classes")
    parts = items.select("row", F.explode("tokens").alias("token")).join(classes.select("token", "part").where("token = part"), "token")
    parts = parts.groupBy("row").agg(F.collect_set("part").alias("parts"))
    label = F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))
    baskets = items.select("row", label.alias("label")).join(parts, "row", "left")
    baskets = baskets.select(F.concat(F.coalesce("parts", F.array().cast("array<string>")), "label").alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=least / n, minConfidence=min_confidence).fit(saved(baskets, "url-baskets"))
    rules = model.associationRules.where((F.col("consequent")[0] == BAD) & (F.col("lift") > 1))
    rules = rules.select(F.array_sort("antecedent").alias("tokens"), "confidence", "support")
    rules = rules.withColumn("rule_id", F.array_join("tokens", " "))
    alone = classes.where("token = part").select("token", "n")
    members = classes.groupBy("part").agg(F.array_sort(F.collect_set("token")).alias("member"))
    told = rules.select("rule_id", F.posexplode("tokens").alias("place", "token")).join(alone, "token").join(members, F.col("token") == F.col("part"))
    told = told.groupBy("rule_id").agg(
        F.min(F.struct("n", "token")).alias("least"), F.transform(F.array_sort(F.collect_list(F.struct("place", "member"))), lambda x: x["member"]).alias("members")
    )
    rules = saved(rules.join(told, "rule_id").withColumn("anchor", F.col("least.token")).drop("least"), "url-rules")
    # A shorter rule's anchor is among the tokens of each rule that it covers.
    shorter = rules.select(F.col("tokens").alias("covering"), F.col("confidence").alias("as_sure"), "anchor")
    tried = rules.select("rule_id", "tokens", "confidence", F.explode("tokens").alias("anchor"))
    covers = (F.size("covering") < F.size("tokens")) & (F.size(F.array_except("covering", "tokens")) == 0) & (F.col("as_sure") >= F.col("confidence"))
    needless = tried.join(shorter, "anchor").where(covers).select("rule_id").distinct()
    out = saved(rules.join(needless, "rule_id", "left_anti"), "url-rules")
    return out.select(*[c.split()[0] for c in shape.split(", ")])


def matching(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows (url, mined): the surest of ``rules`` that each distinct url fits, if any does.

    A rule fits a URL that has, for each of its tokens, that one or one that stands for it.
    """
    tokens = urls.where("url IS NOT NULL").select("url").distinct().withColumn("tokens", url_tokens())
    tried = tokens.withColumn("anchor", F.explode("tokens"))
    at = F.array_position("tokens", F.col("anchor"))
    anchors = rules.select(F.explode(F.get("members", (at - 1).cast("int"))).alias("anchor"), "members", "rule_id", "confidence")
    # The index is short; a token that most URLs have is read from the URLs' side only.
    tried = tried.join(anchors, "anchor").where(F.forall("members", lambda m: F.arrays_overlap(m, F.col("tokens"))))
    surest = F.min(F.struct((-F.col("confidence")).alias("c"), "rule_id")).alias("best")
    return tried.groupBy("url").agg(surest).select("url", F.col("best.rule_id").alias("mined"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], mined: DataFrame) -> DataFrame:
    """Adds host, path, rule, mined and verdict (allow or block) to ``pages``.

    A fixed rule decides; else a URL that a mined rule fits is blocked and any other
    allowed, a null one too. Input columns of these names are replaced; every row is judged
    on its own; an empty table stays empty.
    """
    pages = pages.drop("host", "path", "rule", "mined", "verdict").withColumns(host_and_path("url"))
    pages = join_spread(pages, matching(pages, mined), "url", "page_id")
    rule, verdict = fitting_rule(rules)
    other = F.when(F.col("mined").isNull(), "allow").otherwise("block")
    return pages.withColumns({"rule": rule, "verdict": F.coalesce(verdict, other)})


# --------------------------------------------------------------------------------- queries
#: Fixed by the query's contract.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def labelled_urls(spark, sf_dir: str) -> DataFrame:
    """Rows (url, bad): a page's document is named by the number in its path."""
    doc = F.regexp_extract(host_and_path("url")["path"], r"([0-9]+)[^/0-9]*/?$", 1)
    pages = table(spark, sf_dir, "pages").select("url", doc.try_cast("long").alias("doc_id"))
    labels = table(spark, sf_dir, "labels").where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad")
    )
    return pages.where("doc_id IS NOT NULL").join(labels, "doc_id").select("url", "bad")


def op4_urls(spark, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL."""
    rules = mine_rules(labelled_urls(spark, sf_dir))
    judged = judge(table(spark, sf_dir, "pages").select("page_id", "url"), RULES, rules)
    return judged.select("page_id", "host", "path", "rule", "verdict", "mined")
