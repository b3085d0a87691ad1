import gzip
import re

import pytest
from pyspark.sql import functions as F

from helpers import SF, same_as_sql, write_tables
from tablesync.llm import warc

PAGES = "page_id long, url string, html string"


def test_whole_table(spark):
    assert same_as_sql(warc.op2_warc(spark, SF), warc.OP2_SQL)


def test_odd_pages(spark, tmp_path):
    long = "".join(chr(0x4E00 + i % 2000) for i in range(100_000))
    rows = [(1, "http://a/", None), (2, None, ""), (3, "u", "a\r\n\r\nb"), (4, "x\r\nWARC-Type: y", "WARC/1.0\r\n\r\n"), (5, "l", long)]
    rows += [(6, "l2", long), (None, "n", "only"), (None, "n", "only"), (7, "r", "same"), (7, "r", "same"), (8, "z", "0\r\n\r\n")]
    pages = spark.createDataFrame(rows, PAGES).withColumns({"payload": F.lit(1), "refers_to": F.lit("x")})
    path = str(tmp_path / "w")
    warc.write_warc(pages, path, segment_bytes=1000, chunk_bytes=64)
    read = warc.read_warc(spark, path)
    assert read.where("problem IS NOT NULL").count() == 0
    found = {}
    for r in read.collect():
        found.setdefault(r.page_id, []).append((r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload).decode()))
    assert found[5] == [("revisit", 6, None)] and found[6] == [("response", None, long)]
    assert found[1] == [("revisit", 2, None)] and found[2] == [("response", None, "")]
    assert found[3] == [("response", None, "a\r\n\r\nb")] and found[4] == [("response", None, "WARC/1.0\r\n\r\n")]
    assert found[None] == [("response", None, "only")] * 2 and found[7] == [("response", None, "same")] * 2
    done = {r.page_id: r for r in warc.resolved(read.drop("payload")).collect()}
    assert done[5].payload_bytes == 300_000 and done[5].found_digest == done[6].found_digest
    data = write_tables(spark, tmp_path / "t", pages=pages.select("page_id", "url", "html").where("page_id <> 7"))
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{data}/pages.parquet/*.parquet')")
    assert same_as_sql(warc.op2_warc(spark, data), warc.OP2_SQL, con)


def test_headers_of_the_format(spark, tmp_path):
    rows = [(k, f"http://h/{k}", "same" if k < 40 else "tie" if k < 60 else "x" * k * 20) for k in range(100)]
    rows += [(59, "http://h/again", "tie")]
    path = tmp_path / "w"
    warc.write_warc(spark.createDataFrame(rows, PAGES).coalesce(2), str(path), segment_bytes=512, file_bytes=8 << 10)
    heads = []
    for file in path.glob("*.gz"):
        data = gzip.decompress(file.read_bytes())
        assert len(data) <= 8 << 10
        heads += [head for head, _ in warc.records(data)]
    ids = [h["warc-record-id"] for h in heads]
    assert len(set(ids)) == len(ids)
    uuid = "[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}"
    assert all(re.fullmatch(f"<urn:uuid:{uuid}>", i) for i in ids)
    assert all(re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", h["warc-date"]) for h in heads)
    by_id = dict(zip(ids, heads, strict=True))
    origins = [by_id[h["warc-segment-origin-id"]] for h in heads if h["warc-type"] == "continuation"]
    assert origins and all(h["warc-segment-number"] == "1" for h in origins)
    revisits = {int(h["warc-page-id"]): h for h in heads if h["warc-type"] == "revisit"}
    assert set(revisits) == {*range(39), *range(40, 59)}
    for k in range(39):
        assert by_id[revisits[k]["warc-refers-to"]]["warc-page-id"] == "39"
    # Two rows have page 59: a revisit names the page, no record.
    assert all("warc-refers-to" not in revisits[k] and revisits[k]["warc-refers-to-page-id"] == "59" for k in range(40, 59))


def test_empty_table(spark, tmp_path):
    assert warc.op2_warc(spark, write_tables(spark, tmp_path)).count() == 0


def _record(kind, rid, block, **more):
    head = {"WARC-Type": kind, "WARC-Record-ID": rid, "WARC-Page-ID": "1", **more, "Content-Length": str(len(block))}
    return ("WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + "\r\n").encode() + block + b"\r\n\r\n"


@pytest.mark.parametrize(
    ("total", "numbers", "body", "problem"),
    [
        (None, (1, 2), b"3\r\nabc\r\n0\r\n\r\n", "last segment is missing"),
        (10_000, (1, 2), b"3\r\nabc\r\n0\r\n\r\n", "bytes in segments"),
        ("right", (1, 3), b"3\r\nabc\r\n0\r\n\r\n", "missing or doubled"),
        ("right", (1, 1), b"3\r\nabc\r\n0\r\n\r\n", "missing or doubled"),
        ("right", (1, 2), b"9\r\nabc\r\n0\r\n\r\n", "chunked"),
        ("right", (1, 2), b"3\r\nabc\r\n0\r\n\r\n", None),
    ],
)
def test_segments_are_verified(spark, tmp_path, total, numbers, body, problem):
    block = warc.HTTP_HEAD.encode() + body
    total = len(block) if total == "right" else total
    end = {"WARC-Segment-Total-Length": str(total)} if total else {}
    second = _record("continuation", "<b>", block[30:], **{"WARC-Segment-Origin-ID": "<a>", "WARC-Segment-Number": str(numbers[1])}, **end)
    first = _record("response", "<a>", block[:30], **{"WARC-Segment-Number": str(numbers[0])})
    # The continuation comes first, in another file and gzip member.
    (tmp_path / "1.warc.gz").write_bytes(gzip.compress(second))
    (tmp_path / "2.warc.gz").write_bytes(gzip.compress(_record("response", "<c>", block)) + gzip.compress(first))
    got = {r.record_id: r for r in warc.read_warc(spark, str(tmp_path)).collect()}
    assert set(got) == {"<a>", "<c>"}
    if problem:
        assert problem in got["<a>"].problem and got["<a>"].payload is None
    else:
        assert got["<a>"].problem is None and bytes(got["<a>"].payload) == b"abc"
