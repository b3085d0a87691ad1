import time
from itertools import combinations

from pyspark.sql import functions as F

from helpers import SF, duck, write_tables
from tablesync.llm import urls


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]


def fixed(host, path):
    fits = [r for r in urls.RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return max(fits, key=lambda r: len(r[0] + r[1]), default=None)


def test_whole_table(spark):
    want = duck().execute("SELECT page_id, url FROM pages").fetchall()
    got = {r.page_id: r for r in urls.op4_urls(spark, SF).collect()}
    assert len(got) == len(want)
    for page_id, url in want:
        host, path = parts(url)
        rule, r = fixed(host, path), got[page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule and rule[0] + rule[1])
        assert r.verdict == (rule[2] if rule else "block" if r.mined else "allow")


def test_odd_urls(spark):
    given = [None, "", "no scheme", "HTTP://A.NET", "http://net/", "http://xnet/", "http://Example.COM/de/x", "http://a.example.net/en/", "http://b.net?x=/"]
    given += ["http://É.ORG/fr/", "a://b://c/d", "://h#f/g", "http://h/" + "a" * 100_000, "http://x.org/fr", "http://u.net/p\nq", "http://u.net/p\nq"]
    pages = spark.createDataFrame([(i if i % 5 else None, u) for i, u in enumerate(given)], "page_id long, url string")
    pages = pages.withColumns({"host": F.lit("x"), "tokens": F.lit(1), "anchor": F.lit("y"), "n": F.monotonically_increasing_id(), "_part": F.lit("p")})
    none = urls.mine_rules(spark.createDataFrame([], "url string, bad boolean"))
    out = urls.judge(pages, urls.RULES, none)
    assert sorted(out.columns) == sorted(["page_id", "url", "tokens", "anchor", "n", "_part", "path", "host", "mined", "rule", "verdict"])
    assert {r["_part"] for r in out.collect()} == {"p"}
    rows = out.collect()
    assert len(rows) == len(given)
    for r in rows:
        host, path = parts(r.url)
        rule = fixed(host, path)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule and rule[0] + rule[1], rule[2] if rule else "allow")


def test_mined_rules_against_brute_force(spark):
    rows = [(f"http://{'spam' if i % 4 == 0 else 'ok'}.site{i % 3}.com/{'win' if i % 2 == 0 else 'news'}/{i}?id={i}", i % 4 == 0 and i % 3 != 1) for i in range(240)]
    rows += [(None, True), ("http://x", None)]
    labelled = spark.createDataFrame(rows, "url string, bad boolean")
    mined = urls.mine_rules(labelled, min_support=0.02, min_count=5, min_confidence=0.6)
    tokens = labelled.where("url IS NOT NULL AND bad IS NOT NULL").select(urls.url_tokens().alias("t"), "bad").collect()
    sets = [(frozenset(r.t), r.bad) for r in tokens]
    n, base = len(sets), sum(b for _, b in sets) / len(sets)
    frequent = {t for s, _ in sets for t in s if sum(t in x for x, _ in sets) >= 5}
    want = {}
    for size in range(1, 8):
        for c in combinations(sorted(frequent), size):
            hits = [b for s, b in sets if s.issuperset(c)]
            if hits and sum(hits) >= max(5, 0.02 * n) and sum(hits) / len(hits) >= 0.6 and sum(hits) / len(hits) > base:
                want[frozenset(c)] = sum(hits) / len(hits)
    want = {c: p for c, p in want.items() if not any(d < c and q >= p for d, q in want.items())}
    got = {frozenset(r.tokens): r.confidence for r in mined.collect()}
    assert got.keys() == want.keys() and all(abs(got[c] - want[c]) < 1e-9 for c in want) and got
    pages = labelled.where("url IS NOT NULL").select(F.monotonically_increasing_id().alias("page_id"), "url")
    for r in urls.judge(pages, [], mined).withColumn("t", urls.url_tokens()).collect():
        assert (r.verdict == "block") == any(c <= set(r.t) for c in want)


def test_empty_tables(spark, tmp_path):
    assert urls.op4_urls(spark, write_tables(spark, tmp_path)).count() == 0


def test_copies_of_a_long_url_are_no_work(spark):
    """A thousand copies with 60 path parts: their tokens are mined as one, and any of them counts as it."""
    long = "http://spam.example/" + "/".join(f"part{i}" for i in range(60))
    rows = [(long, True)] * 1000 + [(f"http://ok.example/page/{i}", i % 10 == 0) for i in range(1000)]
    labelled = spark.createDataFrame(rows, "url string, bad boolean")
    begin = time.monotonic()
    mined = urls.mine_rules(labelled).collect()
    assert time.monotonic() - begin < 60
    # host=spam.example and the 60 path parts are in the same rows; host=example and the scheme are in all.
    assert [(len(r.tokens), r.confidence) for r in mined] == [(1, 1.0)]
    assert sorted(mined[0].members[0]) == sorted(["host=spam.example", *(f"path=part{i}" for i in range(60))])
    rules = urls.mine_rules(labelled)
    pages = spark.createDataFrame([(1, long), (2, "http://new.example/part7"), (3, "http://spam.example/"), (4, "http://ok.example/page/5")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in urls.judge(pages, [], rules).collect()} == {1: "block", 2: "block", 3: "block", 4: "allow"}


def test_mined_rules_decide_in_the_query(spark, tmp_path):
    """Pages whose documents are labelled; the rules mined from them block other pages that no fixed rule fits."""
    pages = [(i, f"https://{'junk' if i % 3 == 0 else 'fine'}.example.edu/{'offer' if i % 3 == 0 else 'read'}/{i}.html") for i in range(300)]
    pages += [(1000 + i, f"https://junk.example.edu/new/x{i}") for i in range(5)] + [(2000, "https://junk.net/offer/1.html"), (2001, "https://other.example.edu/read/x")]
    labels = [(i, 0 if i % 3 == 0 else 1, 0) for i in range(0, 300, 2)]
    sf = write_tables(
        spark, tmp_path, pages=spark.createDataFrame([(i, u, "") for i, u in pages], "page_id long, url string, html string"),
        labels=spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )
    got = {r.page_id: r for r in urls.op4_urls(spark, sf).collect()}
    for i, url in pages:
        junk = "://junk.example.edu" in url or "/offer/" in url
        assert (got[i].rule, got[i].verdict) == (("net/", "block") if ".net" in url else (None, "block" if junk else "allow"))
        assert (got[i].mined is not None) == junk
