"""WARC transactions (operator 6).

Writing: a page becomes a request, a response (or revisit) and a metadata record, tied
by WARC-Concurrent-To. Of pages with equal payloads of at least `REVISIT_BYTES` the one
with the smallest id is the response; the others are revisits that refer to it. Files
are written by Spark's text sink, which writes bytes as they are and compresses each
file; its line end is the last one of a record.

Reading: archives are parsed record by record along Content-Length. A file is held,
compressed, by one task; `write_archives` bounds its files by records and input split.
Records without payloads are stored once; responses and revisits are then joined to
their requests and metadata through the concurrent-to identifiers, and revisits to
what they refer to. One nested row per capture comes out.

Defined cases: null html is an empty payload; null urls leave the target out; a page without an id
is never the first of its payload; of repeated rows one is the response, the others
revisit it (or, with a small payload, all are responses); an empty table has no
archives; a long payload is one record; other columns are not read. Pages are read twice, so they must come from stored rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclimate.llm.common import mapped, shared_folder, small_side, stored

REVISIT_BYTES = 100
#: Captures of one file at most.
FILE_CAPTURES = 50_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BATCH_BYTES = 8 << 20
CHUNK = 1 << 20
#: Repeated payloads, or captures that others refer to, that every task is sent at most.
SMALL_ROWS = 200_000


def _urn(*parts) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(repr(parts).encode()).digest())}>"


def _record(kind: str, record_id: str, content_type: str, block: bytes, date: str, **headers) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {date}"]
    lines += [f"{k.replace('_', '-')}: {v}" for k, v in headers.items() if v is not None]
    lines += [f"Content-Type: {content_type}", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def capture_bytes(page_id: int | None, row: int, url: str | None, payload: bytes, digest: str, first: tuple | None, date: str = DATE) -> bytes:
    """The three records of a page. `first` names the capture it repeats (page id, row)."""
    own = _urn("response", page_id, row)
    target = quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url is not None else None
    parts = urlsplit(target) if target and re.match(r"https?://[^\[\]]*$", target) else None
    ask = f"GET {(parts.path or '/') + ('?' + parts.query if parts.query else '') if parts else '/'} HTTP/1.1\r\nHost: {parts.netloc if parts else ''}\r\n\r\n"
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    common = {"WARC_Target_URI": target}
    answer = {**common, "WARC_Payload_Digest": f"sha256:{digest}"}
    if first is None:
        middle = _record("response", own, "application/http; msgtype=response", head + payload, date, **answer)
    else:
        middle = _record("revisit", own, "application/http; msgtype=response", head, date, **answer,
                         WARC_Refers_To=_urn("response", *first), WARC_Profile=PROFILE)
    fields = json.dumps({"page_id": page_id, "url": url}).encode()
    return (_record("request", _urn("request", page_id, row), "application/http; msgtype=request", ask.encode(), date, **common, WARC_Concurrent_To=own)
            + middle + _record("metadata", _urn("metadata", page_id, row), "application/json", fields, date, **common, WARC_Concurrent_To=own))


def write_archives(pages: DataFrame, path: str) -> None:
    """Write a WARC archive of the pages (page_id, url, html) under `path`."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"),
                        F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    firsts = stored(rows.where((F.length("payload") >= REVISIT_BYTES)).groupBy("digest").agg(
        F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "row"))).alias("first"), F.count("*").alias("n")) \
        .where("n > 1 and first is not null").select("digest", F.col("first.page_id").alias("first_id"), F.col("first.row").alias("first_row")), "firsts")
    # Payloads are not dealt by digest, which one page may share with a third of all: the firsts go to them, or, if they are
    # many, their pages are found without payloads and then told by row number.
    if firsts.count() <= SMALL_ROWS:
        named = rows.join(F.broadcast(firsts), "digest", "left")
    else:
        named = rows.join(rows.select("row", "digest").join(firsts, "digest").select("row", "first_id", "first_row"), "row", "left")

    def run(batches):
        for batch in batches:
            out, size = [], 0
            for page_id, url, row, digest, first_id, first_row, payload in zip(*[batch.column(i).to_pylist() for i in range(6)], batch.column(6)):
                first = (first_id, first_row) if first_row is not None and first_row != row else None
                out.append(capture_bytes(page_id, row, url, payload.as_py(), digest, first)[:-2])
                size += len(out[-1])
                if size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])
                    out, size = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    records = mapped(named.select("page_id", "url", "row", "digest", "first_id", "first_row", "payload"), run, "record binary")
    records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\r\n").option("compression", "gzip") \
        .option("maxRecordsPerFile", FILE_CAPTURES).text(path)


def _chunks(content: memoryview) -> Iterator[bytes]:
    """Content in pieces, unpacked if it is gzip (of any number of members)."""
    if bytes(content[:2]) != b"\x1f\x8b":
        for at in range(0, len(content), CHUNK):
            yield bytes(content[at:at + CHUNK])
        return
    at, unpack, rest = 0, zlib.decompressobj(31), b""
    while at < len(content) or rest:
        part = rest or bytes(content[at:at + CHUNK])
        at += 0 if rest else len(part)
        yield unpack.decompress(part)
        rest = unpack.unused_data
        if unpack.eof:
            unpack = zlib.decompressobj(31)


def parse_records(content: memoryview) -> Iterator[tuple[dict, bytes]]:
    """Headers (lower-case names) and block of every record of an archive."""
    chunks, held = _chunks(content), bytearray()

    def more() -> bool:
        part = next(chunks, None)
        if part:
            held.extend(part)
        return part is not None

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0 or held.startswith(b"\r\n"):
            if held.startswith(b"\r\n"):
                del held[:2]
            elif not more():
                if held.strip():
                    raise ValueError("archive ends inside a header")
                return
        lines = held[:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record: {lines[0][:40]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(headers["content-length"])
        while len(held) < end + 4 + size:
            if not more():
                raise ValueError("archive ends inside a block")
        yield headers, bytes(held[end + 4:end + 4 + size])
        del held[:end + 4 + size]


def _http(block: bytes) -> tuple[int | None, int | None, bytes]:
    """Status, announced length and payload of an HTTP message."""
    head, _, payload = block.partition(b"\r\n\r\n")
    status = re.match(rb"HTTP/\S+ (\d{3})", head)
    length = re.search(rb"(?im)^content-length:[ \t]*(\d+)", head)
    return int(status[1]) if status else None, int(length[1]) if length else None, payload


def read_records(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per record of the archives under `path`. Payload and its SHA-256 are of the HTTP body; revisits have none of their own."""
    names = ["record_id", "type", "concurrent_to", "refers_to", "target_uri", "date", "status", "payload_bytes", "payload_digest", "fields", "payload"]
    types = [*[pa.string()] * 6, pa.int32(), pa.int64(), pa.string(), pa.string(), pa.binary()]

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for headers, block in parse_records(memoryview(content.as_buffer())):
                    kind = headers.get("warc-type")
                    status = length = digest = body = fields = None
                    if kind == "response":
                        status, _, body = _http(block)
                        length, digest = len(body), hashlib.sha256(body).hexdigest()
                    elif kind == "revisit":
                        status, length, _ = _http(block)
                        digest = headers.get("warc-payload-digest", "").removeprefix("sha256:") or None
                    elif kind in ("metadata", "request"):
                        fields = block.decode("utf-8", "replace")
                    rows.append((headers.get("warc-record-id"), kind, headers.get("warc-concurrent-to"), headers.get("warc-refers-to"),
                                 headers.get("warc-target-uri"), headers.get("warc-date"), status, length, digest, fields, body if payload else None))
                    size += len(block) if payload else 500
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    files = spark.read.format("binaryFile").load(path).select("content")
    return mapped(files, run, "record_id string, type string, concurrent_to string, refers_to string, target_uri string, date string, "
                              "status int, payload_bytes long, payload_digest string, fields string, payload binary")


def captures(records: DataFrame) -> DataFrame:
    """One nested row per response or revisit: its own record, its requests and its metadata.

    A capture without request or metadata has empty arrays; requests and metadata tied to no capture are left out.
    """
    def side(kind: str, name: str) -> DataFrame:
        return records.where(F.col("type") == kind).groupBy(F.col("concurrent_to").alias("record_id")).agg(
            F.sort_array(F.collect_list(F.struct(F.col("record_id").alias("id"), "date", "fields"))).alias(name))

    main = records.where(F.col("type").isin("response", "revisit")).drop("concurrent_to", "fields")
    out = main.join(side("request", "requests"), "record_id", "left").join(side("metadata", "metadata"), "record_id", "left")
    none = F.expr("cast(array() as array<struct<id:string,date:string,fields:string>>)")
    return out.select("record_id", F.struct(*[c for c in main.columns if c != "record_id"]).alias("response"),
                      F.coalesce("requests", none).alias("requests"), F.coalesce("metadata", none).alias("metadata"))


def with_referred(found: DataFrame) -> DataFrame:
    """Captures with `refers_to_page`, the page of the capture that a revisit refers to (null if there is none)."""
    page = F.get_json_object(F.get("metadata", F.lit(0))["fields"], "$.page_id").cast("long")
    rows = found.withColumn("page_id", page)
    asked = rows.where("response.refers_to is not null").select(F.col("response.refers_to").alias("record_id")).distinct()
    firsts = stored(rows.where("response.type = 'response'").join(asked, "record_id").select(
        F.col("record_id").alias("__refers"), F.col("page_id").alias("refers_to_page")), "referred")
    # one capture may be what a third of all refer to, so small tables go to the revisits
    return rows.join(small_side(firsts, SMALL_ROWS), F.col("response.refers_to") == F.col("__refers"), "left").drop("__refers")


def page_captures(pages: DataFrame) -> DataFrame:
    """Write the pages as archives, read them back, and give page_id, payload size and digest, record type, what a revisit refers to, and
    the number of requests of the capture and whether the first asks for the capture's target."""
    spark, path = pages.sparkSession, shared_folder(pages.sparkSession, "warc")
    write_archives(pages, path)
    found = stored(captures(stored(read_records(spark, path, payload=False), "records")), "captures")
    asked = F.coalesce(F.regexp_extract(F.get("requests", F.lit(0))["fields"], r"\r\nHost: ([^\r]*)\r\n", 1), F.lit(""))
    target = F.coalesce(F.col("response.target_uri"), F.lit(""))
    return with_referred(found).select(
        "page_id", F.col("response.payload_bytes").alias("payload_bytes"), F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"), F.col("refers_to_page").alias("refers_to"), F.size("requests").cast("long").alias("n_requests"),
        F.contains(target, asked).alias("request_matches"))
