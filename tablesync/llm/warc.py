"""Web archive records: written with segments and chunked framing, read back and reassembled.

Writing stays with DataFrame functions: a record is one line of a text file whose line
separator is the blank line that ends a record. Reading parses whole files in Arrow
batches, groups the continuation records of a segmented record by their origin's id, puts
them in order by segment number, verifies the total length and decodes the chunked
framing of the HTTP body.

The files: gzip, one per write task and per ``file_bytes`` of records (a record holds at
most ``segment_bytes`` and its header), so that a reader task holds one bounded file at a time.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_spread, saved, shared_path, table

CRLF = "\r\n"
#: Room for a record's header in the bound of a file.
HEADER_BYTES = 1024
RECORD_END = "\r\n\r\n"
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
#: The base-32 digits of Spark's conv() and those of RFC 4648.
CONV_DIGITS, BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

PARSED = (
    "record_id string, record_type string, page_id long, target_uri string, payload_digest string, "
    "refers_to long, origin_id string, segment long, total_length long, block binary"
)
PAYLOAD = "payload binary, payload_bytes long, found_digest string, problem string"


# --------------------------------------------------------------------------------- writing
def payload_digest(payload: Column) -> Column:
    """Upper-case base32 SHA-1 of binary or string data: ten hex digits give eight of base 32."""
    sha = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(sha, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), CONV_DIGITS, BASE32_DIGITS)


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Adds payload (null html: empty), payload_bytes, payload_digest, refers_to, own_id and refers_id.

    Of the pages with one payload of at least ``min_bytes`` bytes, all but that with the
    largest page_id refer to it; rows that repeat that page_id are responses too. A null
    page_id is the smallest; if a payload has no other, its pages are responses.

    own_id is the UUID of a response that others refer to, refers_id that of the response a
    page refers to; both follow from payload and page_id, so nothing has to be looked up. If
    several rows repeat the largest page_id, no id can name one of them: both are null.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    pages = pages.withColumns({"payload": payload, "payload_bytes": F.octet_length(payload).cast("long")})
    pages = pages.withColumn("payload_digest", payload_digest(F.col("payload")))
    rows = pages.where(F.col("payload_bytes") >= min_bytes).groupBy("payload_digest", "page_id").agg(F.count(F.lit(1)).alias("n"))
    last = rows.groupBy("payload_digest").agg(F.max(F.struct("page_id", "n")).alias("last"), F.sum("n").alias("n"))
    last = last.where("n > 1").select("payload_digest", F.col("last.page_id").alias("last"), (F.col("last.n") == 1).alias("alone"))
    pages = join_spread(pages, last, "payload_digest", "page_id")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") < F.col("last")), F.col("last"))
    pages = pages.withColumn("refers_to", F.when(F.col("payload_bytes") >= min_bytes, refers))
    named = F.when(F.col("alone") & (F.col("payload_bytes") >= min_bytes), _uuid_of(F.col("payload_digest"), F.col("last")))
    ids = {"own_id": F.when(F.col("page_id") == F.col("last"), named), "refers_id": F.when(F.col("refers_to").isNotNull(), named)}
    return pages.withColumns(ids).drop("last", "alone")


def _uuid_of(*named: Column) -> Column:
    """A name-based UUID (SHA-1, version 5 by its marks)."""
    sha = F.sha1(F.concat_ws(":", *[c.cast("string") for c in named]))
    parts = [F.substring(sha, 1, 8), F.substring(sha, 9, 4), F.concat(F.lit("5"), F.substring(sha, 14, 3))]
    return F.concat_ws("-", *parts, F.concat(F.lit("8"), F.substring(sha, 18, 3)), F.substring(sha, 21, 12))


def _text(data: Column) -> Column:
    return data.cast("string")  # the same bytes, whether valid UTF-8 or not


def _pieces(data: Column, length: Column, size: int) -> Column:
    """Binary ``data`` cut every ``size`` bytes; one empty piece for empty data."""
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(length - 1, F.lit(0).cast("long")), F.lit(size).cast("long"))
    return F.transform(starts, lambda i: F.substring(data, (i + 1).cast("int"), F.lit(size)))


def chunked(data: Column, size: int) -> Column:
    """A body in chunked transfer framing, as text of the same bytes."""

    def frame(piece: Column) -> Column:
        return F.concat(F.lower(F.hex(F.octet_length(piece).cast("long"))), F.lit(CRLF), _text(piece), F.lit(CRLF))

    length = F.octet_length(data).cast("long")
    body = F.when(length > 0, F.array_join(F.transform(_pieces(data, length, size), frame), "")).otherwise(F.lit(""))
    return F.concat(body, F.lit("0\r\n\r\n"))


def write_warc(
    pages: DataFrame, path: str, segment_bytes: int = 16384, chunk_bytes: int = 4096, file_bytes: int = 256 << 20
) -> None:
    """Write a record per row of ``pages`` (page_id, url, html), see ``with_revisits``.

    A response longer than ``segment_bytes`` becomes a record and its continuations.
    A record's id is random, but for responses that others refer to; each record and its
    segments are written by one task, all with the time of the write as their date. A file
    holds ``file_bytes`` before compression at most, taking 1,024 bytes for a header (what a
    longer URL takes beyond them comes on top).
    """
    pages = with_revisits(pages.select("page_id", "url", "html"))
    revisit = F.col("refers_to").isNotNull()
    body = F.when(revisit, F.lit("")).otherwise(chunked(F.col("payload"), chunk_bytes))
    pages = pages.withColumns({"id": F.coalesce("own_id", F.uuid()), "block": F.concat(F.lit(HTTP_HEAD), body).cast("binary")})
    pages = pages.withColumn("total", F.octet_length("block").cast("long"))
    pages = pages.select("*", F.posexplode(_pieces(F.col("block"), F.col("total"), segment_bytes)).alias("pos", "piece"))
    pages = pages.withColumn("record", F.when(F.col("pos") == 0, F.col("id")).otherwise(F.uuid()))

    def header(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF))

    def when(condition: Column, name: str, value: Column) -> Column:
        return F.when(condition & value.isNotNull(), header(name, value)).otherwise(F.lit(""))

    always, first, split = F.lit(True), F.col("pos") == 0, F.col("total") > segment_bytes
    ends = (F.col("pos") + 1) * segment_bytes >= F.col("total")
    kind = F.when(~first, F.lit("continuation")).when(revisit, F.lit("revisit")).otherwise(F.lit("response"))
    utc = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())

    def urn(uuid: str) -> Column:
        return F.concat(F.lit("<urn:uuid:"), F.col(uuid), F.lit(">"))

    profile = F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")
    record = F.concat(
        F.lit(f"WARC/1.0{CRLF}"),
        header("WARC-Type", kind),
        header("WARC-Record-ID", urn("record")),
        header("WARC-Date", F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        when(first, "WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", "")),
        when(always, "WARC-Page-ID", F.col("page_id")),
        when(first, "WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        when(first & revisit, "WARC-Profile", profile),
        when(first, "WARC-Refers-To", urn("refers_id")),
        when(first, "WARC-Refers-To-Page-ID", F.col("refers_to")),
        when(split, "WARC-Segment-Number", F.col("pos") + 1),
        when(~first, "WARC-Segment-Origin-ID", urn("id")),
        when(split & ends, "WARC-Segment-Total-Length", F.col("total")),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("Content-Length", F.octet_length("piece")),
        F.lit(CRLF),
        _text(F.col("piece")),
    )
    out = pages.select(record.alias("value")).write.option("lineSep", RECORD_END).option("compression", "gzip")
    out.option("maxRecordsPerFile", max(1, file_bytes // (segment_bytes + HEADER_BYTES))).text(path)


# --------------------------------------------------------------------------------- reading
def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of a file, gzipped or not."""
    view, at = bytearray(), 0
    for part in _inflated(data):
        view += part
        while (end := view.find(b"\r\n\r\n", at)) >= 0:
            lines = view[at:end].decode("utf-8", "replace").split(CRLF)
            if not lines[0].startswith("WARC/"):
                raise ValueError(f"not a WARC record: {lines[0][:80]!r}")
            head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
            stop = end + 4 + int(head["content-length"])
            if stop + 4 > len(view):
                break
            yield head, bytes(view[end + 4 : stop])
            at = stop + 4
        if at > 1 << 20:
            del view[:at]
            at = 0
    if view[at:].strip():
        raise ValueError("the file ends inside a record")


def _inflated(data: bytes) -> Iterator[bytes]:
    """The data in parts of up to 1 MB; any number of gzip members."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    while data:
        stream = zlib.decompressobj(31)
        while not stream.eof:
            part = stream.decompress(data, 1 << 20)
            data = stream.unconsumed_tail
            if not part and not data and not stream.eof:
                raise ValueError("the file ends inside a gzip member")
            yield part
        data = stream.unused_data


def _number(head: dict[str, str], name: str) -> int | None:
    return int(head[name]) if name in head else None


def _parse(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [x.split()[0] for x in PARSED.split(", ")]
    for batch in batches:
        for data in batch["content"]:
            rows, held = [], 0
            for head, block in records(data):
                digest = head.get("warc-payload-digest", "")
                rows.append((
                    head["warc-record-id"], head["warc-type"], _number(head, "warc-page-id"), head.get("warc-target-uri"),
                    digest.partition(":")[2] or None, _number(head, "warc-refers-to-page-id"), head.get("warc-segment-origin-id"),
                    _number(head, "warc-segment-number"), _number(head, "warc-segment-total-length"), block,
                ))
                held += len(block)
                if held > 4 << 20:
                    yield _frame(rows, names)
                    rows, held = [], 0
            yield _frame(rows, names)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    whole = ["page_id", "refers_to", "segment", "total_length"]
    return out.astype({c: "Int64" for c in whole})


def dechunk(body: bytes) -> bytes:
    """The data of a body in chunked transfer framing; a ValueError if the framing is wrong."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].partition(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        at = end + 2 + size
        if body[at : at + 2] != b"\r\n":
            raise ValueError("a chunk's length is wrong")
        out.append(body[end + 2 : at])
        at += 2


def decoded(block: bytes, total: int | None) -> tuple[bytes | None, int | None, str | None, str | None]:
    """Payload, its length, its digest, and what is wrong with the block, if anything is."""
    if total is not None and len(block) != total:
        return None, None, None, f"{len(block)} bytes in segments of a record of {total}"
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        return None, None, None, "no end of the HTTP header"
    try:
        if b"transfer-encoding: chunked" in head.lower():
            body = dechunk(body)
    except ValueError as e:
        return None, None, None, f"bad chunked framing: {e}"
    return body, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), None


def _decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kinds, blocks, totals, problems = (batch[c].to_pylist() for c in ("record_type", "block", "total_length", "problem"))
        got = [
            (None, None, None, p) if p or kind == "revisit" else decoded(b, t)
            for kind, b, t, p in zip(kinds, blocks, totals, problems, strict=True)
        ]
        kept = [c for c in batch.schema.names if c not in ("block", "total_length", "problem")]
        types = [pa.binary(), pa.int64(), pa.string(), pa.string()]
        new = [pa.array([x[k] for x in got], t) for k, t in enumerate(types)]
        names = ["payload", "payload_bytes", "found_digest", "problem"]
        yield pa.RecordBatch.from_arrays([batch[c] for c in kept] + new, names=kept + names)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Every record but continuations, whole: rows with payload, payload_bytes, found_digest.

    Missing, doubled or misnumbered segments, a wrong total length, wrong framing and a
    digest unlike the header's leave a null payload and say why in ``problem``. A revisit
    has no payload of its own, see ``resolved``. No files give no rows.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(path)
    parsed = files.select("content").mapInPandas(_parse, PARSED)
    single = parsed.where("segment IS NULL").withColumn("problem", F.lit(None).cast("string"))

    origin = F.coalesce("origin_id", "record_id")
    pieces = parsed.where("segment IS NOT NULL").groupBy(origin.alias("record_id"))
    first = F.col("segment") == 1
    whole = pieces.agg(
        *[F.max(F.when(first, F.col(c))).alias(c) for c in ("record_type", "page_id", "target_uri", "payload_digest", "refers_to")],
        F.max("total_length").alias("total_length"),
        F.array_sort(F.collect_list(F.struct("segment", "block"))).alias("parts"),
    )
    numbers = F.transform("parts", lambda x: x["segment"])
    in_order = numbers == F.transform(F.sequence(F.lit(1), F.size("parts")), lambda i: i.cast("long"))
    problem = F.when(~in_order, "segments are missing or doubled").when(F.col("total_length").isNull(), "the last segment is missing")
    joined = F.array_join(F.transform("parts", lambda x: _text(x["block"])), "").cast("binary")
    whole = whole.withColumns({"problem": problem, "block": F.when(problem.isNull(), joined)})
    names = [x.split()[0] for x in PARSED.split(", ") if x.split()[0] not in ("origin_id", "segment")]
    both = single.select(*names, "problem").unionByName(whole.select(*names, "problem"))
    kept = "record_id string, record_type string, page_id long, target_uri string, payload_digest string, refers_to long"
    out = both.mapInArrow(_decode, f"{kept}, {PAYLOAD}")
    wrong = (F.col("record_type") == "response") & (F.col("payload_digest") != F.col("found_digest"))
    problem = F.when(F.col("problem").isNull() & wrong, "the payload has another digest").otherwise(F.col("problem"))
    return out.withColumn("problem", problem)


def resolved(read: DataFrame) -> DataFrame:
    """payload_bytes and found_digest of revisits, from the responses with their digest."""
    own = read.where("record_type = 'response'").groupBy("payload_digest")
    own = own.agg(F.max("payload_bytes").alias("response_bytes"), F.max("found_digest").alias("response_digest"))
    revisits = join_spread(read.where("record_type = 'revisit'"), own, "payload_digest", "page_id")
    lost = F.when(F.col("response_digest").isNull(), "its response is missing").otherwise(F.col("problem"))
    revisits = revisits.withColumns(
        {"payload_bytes": F.col("response_bytes"), "found_digest": F.col("response_digest"), "problem": lost}
    ).drop("response_bytes", "response_digest")
    return read.where("record_type <> 'revisit'").unionByName(revisits)


# --------------------------------------------------------------------------------- queries
def op2_warc(spark, sf_dir: str) -> DataFrame:
    """Every page, archived and read back."""
    path = shared_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    read = resolved(saved(read_warc(spark, path).drop("payload"), "warc-read"))
    return read.select(
        "page_id", "payload_bytes", F.col("found_digest").alias("payload_digest"), "record_type", "refers_to", "problem"
    )


OP2_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
q AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes,
  translate(to_base(('0x' || substr(h, 1, 10))::BIGINT, 32, 8) || to_base(('0x' || substr(h, 11, 10))::BIGINT, 32, 8)
    || to_base(('0x' || substr(h, 21, 10))::BIGINT, 32, 8) || to_base(('0x' || substr(h, 31, 10))::BIGINT, 32, 8),
    '{CONV_DIGITS}', '{BASE32_DIGITS}') AS payload_digest,
  max(page_id) OVER (PARTITION BY h) AS last FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < last THEN last END AS refers_to, CAST(NULL AS VARCHAR) AS problem
FROM q
"""
