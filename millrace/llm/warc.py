"""WARC archives: writing with segments and chunked transfer framing, and reassembly on reading.

Writing. Each page is an HTTP response with a chunked body. Of pages with equal payloads of at least `least_shared` bytes
the one with the largest id is written as a response, the others as revisits of it (headers only, with the payload's
length and digest). A block longer than `segment_bytes` is cut: segment 1 is the response, the others are continuation
records that name it as their origin; the last gives the total length. The archives are written by Spark's own writer, whose
line separator is the separator of WARC records, so they land wherever Spark can write; a file holds `file_records` records at most.

Reading. Files are parsed record by record. Records that aren't segmented go on at once; segments, and only they, are
grouped by origin, ordered by number, checked for gaps and against the total length, and joined. Then the transfer framing is
decoded and the payload's digest is computed anew.

Defined results: a null html is an empty payload; a null url is written as an empty one; a page with a null id shares its
payload with none, and is a response; rows that repeat the largest id are all responses; an origin whose segments have
gaps, or not the total length, or whose framing is broken, is returned with ok false and its payload as far as it goes.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import schema, scratch

END = b"\r\n\r\n"
CHUNK = 16384


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """The payload in chunked transfer framing."""
    parts = []
    for i in range(0, len(payload), size):
        part = payload[i : i + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> tuple[bytes, bool]:
    """(payload, whether the framing was whole); chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end > at else -1
        except ValueError:
            size = -1
        if size < 0:
            return b"".join(out), False
        if size == 0:
            return b"".join(out), True
        part = body[end + 2 : end + 2 + size]
        out.append(part)
        at = end + 2 + size
        if len(part) < size or body[at : at + 2] != b"\r\n":
            return b"".join(out), False
        at += 2


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + f"Content-Length: {len(block)}\r\n\r\n"
    return head.encode() + block


def _urn(name: object, segment: int = 1) -> str:
    return f"<urn:millrace:{name}:{segment}>"


def records_of(page_id: int | None, row: str, url: str, payload: bytes, refers_to: int | None, segment_bytes: int, date: str) -> Iterator[bytes]:
    """The records of a page, without the separator after each. row: a name for the row, unique in the archive set."""
    about: list[tuple[str, object]] = [("WARC-Date", date), ("WARC-Target-URI", url), ("WARC-Payload-Digest", f"sha1:{digest(payload)}")]
    if page_id is not None:
        about.append(("X-Page-Id", page_id))
    if refers_to is not None:
        block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        yield _record([("WARC-Type", "revisit"), ("WARC-Record-ID", _urn(row)), ("WARC-Profile", profile), ("X-Refers-To-Page-Id", refers_to), *about, ("Content-Type", "application/http;msgtype=response")], block)
        return
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    pieces = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", _urn(row)), *about, ("Content-Type", "application/http;msgtype=response")]
    yield _record(fields + ([("WARC-Segment-Number", 1)] if len(pieces) > 1 else []), pieces[0])
    for n, piece in enumerate(pieces[1:], 2):
        tail = [("WARC-Segment-Total-Length", len(block))] if n == len(pieces) else []
        yield _record([("WARC-Type", "continuation"), ("WARC-Record-ID", _urn(row, n)), ("WARC-Date", date), ("WARC-Segment-Origin-ID", _urn(row)), ("WARC-Segment-Number", n), *tail], piece)


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_shared: int = 0, segment_bytes: int = 1 << 16, file_records: int = 4000, date: str = "2024-01-01T00:00:00Z") -> None:
    """Archives of pages (id integer, url, html) under path."""
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.coalesce(F.col(f"`{url_col}`"), F.lit("")).alias("url"), F.coalesce(F.col(f"`{html_col}`"), F.lit("")).alias("html"))
    sha = F.sha1(F.col("html").cast("binary"))
    shared = rows.filter(F.col("page_id").isNotNull() & (F.octet_length("html") >= least_shared)).select("page_id", sha.alias("sha"))
    heads = shared.groupBy("sha").agg(F.max("page_id").alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("sha", "head")
    own = F.when(F.col("page_id").isNotNull() & (F.octet_length("html") >= least_shared), sha)
    tagged = rows.withColumn("own", own)
    met = tagged.join(heads, tagged["own"] == heads["sha"], "left").select("page_id", "url", "html", F.when(F.col("head") != F.col("page_id"), F.col("head")).alias("refers_to"), F.monotonically_increasing_id().alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes] = []
            held = 0
            for page_id, url, html, refers_to, row in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                url = url.replace("\r", "%0D").replace("\n", "%0A")
                for r in records_of(page_id, str(row), url, html.encode(), refers_to, segment_bytes, date):
                    out.append(r)
                    held += len(r)
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, type=pa.binary())], names=["record"])
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, type=pa.binary())], names=["record"])

    made = met.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
    made.write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", file_records).text(path)


def inflated(data: bytes, step: int = 1 << 16) -> Iterator[bytes]:
    """The bytes of an archive by blocks, inflated if it is gzip, in one or more members. A member that is cut off ends where it ends."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    view, at, member = memoryview(data), 0, zlib.decompressobj(31)
    while at < len(view):
        if member.eof:
            member = zlib.decompressobj(31)
        piece = view[at : at + step]
        out = member.decompress(piece)
        at += len(piece) - len(member.unused_data)
        if out:
            yield out


def parse(data: bytes, step: int = 1 << 16) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields by lower-case name, block) of each record of an archive; beside data, one record and one inflated block are held."""
    blocks, held, at = inflated(data, step), bytearray(), 0

    def more() -> bool:
        nonlocal at
        block = next(blocks, None)
        if block is None:
            return False
        del held[:at]
        at = 0
        held.extend(block)
        return True

    def find(what: bytes) -> int:
        """The place of what from `at` on; what has been searched isn't searched again."""
        seen = 0
        while (place := held.find(what, at + seen)) < 0:
            seen = max(0, len(held) - at - len(what) + 1)
            if not more():
                return -1
        return place

    while (start := find(b"WARC/")) >= 0:
        at = start
        end = find(END)
        if end < 0:
            return
        lines = bytes(held[at:end]).decode("utf-8", "replace").split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        size = int(fields.get("content-length", 0))
        at = end + 4
        while len(held) - at < size and more():
            pass
        yield fields, bytes(held[at : at + size])
        at = min(at + size, len(held))


SEGMENT = schema("origin string, number int, total long, page_id long, record_type string, refers_to long, url string, declared string, block binary")
PAGE = schema("page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, ok boolean, payload binary")


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives under path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(path).select("content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def whole(x: str | None) -> int | None:
            return int(x) if x else None

        for batch in batches:
            for i in range(batch.num_rows):
                rows, held = [], 0
                for f, block in parse(batch.column(0)[i].as_py()):
                    more = f.get("warc-type") == "continuation"
                    origin = f.get("warc-segment-origin-id" if more else "warc-record-id")
                    number = whole(f.get("warc-segment-number"))
                    rows.append((origin, number, whole(f.get("warc-segment-total-length")), whole(f.get("x-page-id")), f.get("warc-type"), whole(f.get("x-refers-to-page-id")), f.get("warc-target-uri"), f.get("warc-payload-digest"), block))
                    held += len(block)
                    if held > 8 << 20:
                        yield _batch(rows, SEGMENT)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, SEGMENT)

    return files.mapInArrow(run, SEGMENT)


def _batch(rows: list[tuple], kind: T.StructType) -> pa.RecordBatch:
    arrow = to_arrow_schema(kind)
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)


def _page(record_type: str | None, page_id: int | None, refers_to: int | None, url: str | None, declared: str | None, block: bytes, ok: bool) -> tuple:
    head, _, body = block.partition(END)
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
    named = (declared or "").removeprefix("sha1:") or None
    if record_type == "revisit":
        return page_id, url, record_type, refers_to, int(fields.get(b"content-length", b"0")), named, ok, None
    if fields.get(b"transfer-encoding", b"").lower() == b"chunked":
        body, whole = dechunked(body)
        ok = ok and whole
    found = digest(body)
    return page_id, url, record_type, refers_to, len(body), found, ok and found == named, body


def _joined(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("number").drop_duplicates("number")  # a record archived twice counts once
    head = pdf.iloc[0]
    block = b"".join(pdf["block"])
    total = pdf["total"].dropna()
    ok = pdf["number"].tolist() == list(range(1, len(pdf) + 1)) and len(total) == 1 and int(total.iloc[0]) == len(block)
    none = lambda x: None if pd.isna(x) else x
    return pd.DataFrame([_page(head["record_type"], none(head["page_id"]), none(head["refers_to"]), head["url"], head["declared"], block, ok)], columns=PAGE.fieldNames())


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The pages of all archives under path; payloads: with the payload bytes (null for revisits)."""
    found = segments(spark, path).filter(F.col("record_type").isin("response", "revisit", "continuation"))
    out = PAGE if payloads else T.StructType(PAGE.fields[:-1])
    width = len(out.fields)

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {n: batch.column(i).to_pylist() for i, n in enumerate(SEGMENT.fieldNames())}
            rows = [_page(*x, True)[:width] for x in zip(c["record_type"], c["page_id"], c["refers_to"], c["url"], c["declared"], c["block"], strict=True)]
            if rows:
                yield _batch(rows, out)

    def joined(pdf: pd.DataFrame) -> pd.DataFrame:
        return _joined(pdf)[out.fieldNames()]

    single = found.filter("number IS NULL").mapInArrow(alone, out)
    return single.unionByName(found.filter("number IS NOT NULL").groupBy("origin").applyInPandas(joined, out))


def roundtrip(pages: DataFrame, **how) -> DataFrame:
    """Write pages as archives in the shared folder and read them back."""
    path = scratch(pages.sparkSession, "warc")
    write(pages, path, **how)
    return read(pages.sparkSession, path, payloads=False)


#: DuckDB SQL for the rows of the query.
SQL = r"""
WITH p AS (
  SELECT page_id, coalesce(strlen(html), 0)::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS head
  FROM pages
), b AS (
  SELECT *, array_to_string(list_transform(range(10), lambda i: lpad(bin(('0x' || substr(hex, (4 * i + 1)::BIGINT, 4))::BIGINT), 16, '0')), '') AS bits FROM p
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         (list_sum(list_transform(range(5), lambda j: (substr(bits, (5 * i + j + 1)::BIGINT, 1)::INT << (4 - j)::INT)::BIGINT)) + 1)::BIGINT, 1)), '') AS payload_digest,
       CASE WHEN page_id IS NULL OR page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> head THEN head END AS refers_to
FROM b
"""
