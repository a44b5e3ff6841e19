"""WARC archives: writing pages as transactions, and putting transactions together again.

A page becomes three records: a request, a response (or a revisit that refers to the
response with the same payload) and metadata. Requests and metadata name the response or
revisit they belong to in WARC-Concurrent-To. Archives are gzip files in the shared folder,
written and found by Spark.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroll.llm.common import free_name, new_folder, row_keyed, staged

#: Payloads of fewer bytes are never revisits.
MIN_BYTES = 0
#: Records of one archive file at most.
FILE_RECORDS = 20_000
DATE = "2024-01-01T00:00:00Z"
#: Fixed value: the profile of revisits with an identical payload.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HEX, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def payload_digest(payload) -> F.Column:
    """SHA-1 of a text's UTF-8 in base32 letters."""
    h = F.sha1(payload.cast("binary"))
    # 10 hex digits are 8 letters of 5 bits.
    parts = [F.lpad(F.conv(F.substring(h, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), _HEX, _BASE32)


def _record_id(kind: str, number) -> F.Column:
    h = F.md5(F.concat_ws("/", F.lit(kind), number.cast("string")))
    parts = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _record(kind: str, record_id, headers: dict, block) -> F.Column:
    """A record without its last line end; headers that are null are left out."""
    lines = [
        F.concat(F.lit(f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: "), record_id, F.lit(f"\r\nWARC-Date: {DATE}\r\n")),
        *(F.coalesce(F.concat(F.lit(f"{k}: "), v, F.lit("\r\n")), F.lit("")) for k, v in headers.items()),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n")),
    ]
    return F.concat(*lines, block, F.lit("\r\n"))


def write_pages(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES) -> None:
    """Archives in ``folder`` of every row of ``pages`` (``page_id``, ``url``, ``html``).

    The payload is the html in UTF-8, null as empty. Of rows with equal payloads of
    ``min_bytes`` or more the one with the smallest page_id is the response (null ids come
    last, of equal ids the first row), the others are revisits. Null urls have no target
    URI; line ends in urls are written as percent signs and digits. Rows of a
    join must be staged first.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    no = free_name(pages, "no")
    numbered = row_keyed(pages, no).select(
        F.col(no).alias("no"), F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html")
    )
    known = staged(
        numbered.select("no", "page_id", "url", payload_digest(F.col("html")).alias("digest"), F.octet_length("html").alias("bytes")),
        "payloads",
    )
    first = (
        known.where(F.col("bytes") >= min_bytes)
        .groupBy("digest")
        .agg(F.min(F.struct(F.col("page_id").isNull().alias("n"), "page_id", "no")).alias("first"))
        .select("digest", F.col("first.no").alias("first"))
    )
    decided = staged(known.join(first, "digest", "left").withColumn("new", F.coalesce(F.col("first") == F.col("no"), F.lit(True))), "decided")

    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    capture = _record_id("capture", F.col("no"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n")
    )
    common = {"WARC-Target-URI": uri, "WARC-Payload-Digest": F.concat(F.lit("sha1:"), F.col("digest"))}
    response = _record("response", capture, common | {"Content-Type": F.lit("application/http; msgtype=response")}, F.concat(http, F.col("html")))
    revisit = _record(
        "revisit",
        capture,
        common
        | {
            "WARC-Refers-To": _record_id("capture", F.col("first")),
            "WARC-Profile": F.lit(_PROFILE),
            "Content-Type": F.lit("application/http; msgtype=response"),
        },
        http,
    )
    request = _record(
        "request",
        _record_id("request", F.col("no")),
        {"WARC-Target-URI": uri, "WARC-Concurrent-To": capture, "Content-Type": F.lit("application/http; msgtype=request")},
        F.concat(F.lit("GET "), F.coalesce(uri, F.lit("")), F.lit(" HTTP/1.1\r\n\r\n")),
    )
    metadata = _record(
        "metadata",
        _record_id("metadata", F.col("no")),
        {"WARC-Concurrent-To": capture, "Content-Type": F.lit("application/warc-fields")},
        F.coalesce(F.concat(F.lit("page-id: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit("")),
    )
    # Only responses need their html, dealt out by row so that archives are of similar size.
    with_html = (
        numbered.select("no", "html")
        .join(decided.where("new").select("no", "url", "digest", "bytes").hint("merge"), "no")
        .select(response.alias("record"))
    )
    without = decided.select(F.explode(F.array(F.when(~F.col("new"), revisit), request, metadata)).alias("record")).where("record is not null")
    # Each record ends with two line ends: its own and the writer's.
    with_html.unionByName(without).write.option("lineSep", "\r\n").option("compression", "gzip").option(
        "maxRecordsPerFile", FILE_RECORDS
    ).text(folder)


_RECORDS = (
    "type string, record_id string, concurrent_to string, refers_to string, target_uri string, date string, "
    "header_digest string, http_length long, payload_bytes long, payload_digest string, payload binary, fields string"
)
_NAMES = [c.split()[0] for c in _RECORDS.split(", ")]


def _parsed(stream: io.BufferedIOBase, with_payload: bool) -> Iterator[dict]:
    """The records of one archive, read in order; only one is held."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        head = _headers(stream)
        block = stream.read(int(head["content-length"]))
        if len(block) < int(head["content-length"]):
            raise ValueError("a WARC record ends before its length")
        kind = head.get("warc-type")
        row = dict.fromkeys(_NAMES) | {
            "type": kind,
            "record_id": head.get("warc-record-id"),
            "concurrent_to": head.get("warc-concurrent-to"),
            "refers_to": head.get("warc-refers-to"),
            "target_uri": head.get("warc-target-uri"),
            "date": head.get("warc-date"),
            "header_digest": head.get("warc-payload-digest", "").removeprefix("sha1:") or None,
        }
        if kind in ("response", "revisit"):
            http, _, payload = block.partition(b"\r\n\r\n")
            length = _headers(io.BytesIO(http.partition(b"\r\n")[2])).get("content-length")
            row["http_length"] = int(length) if length else None
            if kind == "response":
                row["payload_bytes"] = len(payload)
                row["payload_digest"] = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                row["payload"] = payload if with_payload else None
        elif kind == "metadata":
            row["fields"] = block.decode("utf-8", "replace")
        yield row


def _headers(stream: io.BufferedIOBase) -> dict[str, str]:
    out = {}
    while (line := stream.readline()).strip():
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out.setdefault(name.strip().lower(), value.strip())
    return out


def _read(with_payload: bool, block: int = 8 << 20):
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in _RECORDS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column("content"):
                data = io.BytesIO(content.as_buffer())
                rows, size = [], 0
                for r in _parsed(io.BufferedReader(gzip.GzipFile(fileobj=data)), with_payload):
                    rows.append(r)
                    size += 500 + len(r["payload"] or b"")
                    if size >= block:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def read_records(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """A row for each record of the archives (``*.gz``) in ``folder``; digests and lengths are of the payload read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("content")
    return files.mapInArrow(_read(with_payload), _RECORDS)


def captures(records: DataFrame) -> DataFrame:
    """One nested row for each capture: ``capture_id, main, requests, metadata``.

    Requests and metadata come to the response or revisit that they are concurrent to;
    where there is none, ``main`` is null. Several records of a kind are all kept, in the
    order of their ids. Repeated responses of one id count once.
    """
    is_main = F.col("type").isin("response", "revisit")
    main = F.struct(
        "type", "record_id", "refers_to", "target_uri", "date", "header_digest", "http_length", "payload_bytes", "payload_digest", "payload"
    )
    return (
        records.where(is_main | F.col("type").isin("request", "metadata"))
        .groupBy(F.when(is_main, F.col("record_id")).otherwise(F.col("concurrent_to")).alias("capture_id"))
        .agg(
            F.max(F.when(is_main, main)).alias("main"),
            F.array_sort(F.collect_list(F.when(F.col("type") == "request", F.struct("record_id", "target_uri")))).alias("requests"),
            F.array_sort(F.collect_list(F.when(F.col("type") == "metadata", F.struct("record_id", "fields")))).alias("metadata"),
        )
    )


def page_captures(spark: SparkSession, folder: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of each capture written by ``write_pages``.

    A revisit has the payload of the response it refers to; ``refers_to`` is that one's page_id.
    """
    page = F.regexp_extract(F.col("metadata")[0]["fields"], r"page-id: (-?\d+)", 1)
    flat = staged(
        captures(read_records(spark, folder, with_payload=False))
        .where("main is not null")
        .select("capture_id", "main.*", F.when(page != "", page).cast("long").alias("page_id"))
        .select("capture_id", "type", "refers_to", "payload_bytes", "payload_digest", "page_id"),
        "captures",
    )
    target = flat.where("type = 'response'").select(
        F.col("capture_id").alias("refers_to"),
        F.col("page_id").alias("target"),
        F.col("payload_bytes").alias("target_bytes"),
        F.col("payload_digest").alias("target_digest"),
    )
    return flat.join(target, "refers_to", "left").select(
        "page_id",
        F.coalesce("payload_bytes", "target_bytes").alias("payload_bytes"),
        F.coalesce("payload_digest", "target_digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("target").alias("refers_to"),
    )


def round_trip(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``page_captures`` of archives written from ``pages``; an empty table gives no rows."""
    folder = new_folder(pages.sparkSession, "warc")
    write_pages(pages, folder, min_bytes)
    return page_captures(pages.sparkSession, folder)
