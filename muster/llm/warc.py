"""WARC archives: pages written as records, archives read back as captures.

Writing.  Every page becomes three records: the request, the response (or a
revisit of an earlier equal payload) and a metadata record that carries the
page's id; request and metadata name the response in WARC-Concurrent-To.
Records are put together by SQL and written by Spark's text writer, whose line
separator is the end of a WARC record, so any store Spark knows will do.  Equal
payloads are found by an aggregation of narrow rows; the join that brings the
first of them back to the pages is one that adaptive execution splits where a
payload is very common.

Reading.  Gzip files are not split, so a task sees a file's bytes in order,
again cut at record ends, and puts records together by Content-Length whatever
the payload holds.  Transactions are assembled by grouping records on the id
that Concurrent-To names; each capture is one nested row.

Edge cases.  A null payload is an empty one.  A null page id sorts after all
others and reads back as null; a null URL gives records without a target.
Repeated rows are captures of their own, and of equal payloads with equal page
ids the first by capture number is the response.  Pages must come from a table
or another input that gives the same rows in the same order when a task runs
again.  Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the WARC 1.1 format.
VERSION = "WARC/1.1"
RECORD_END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

KINDS = {"response": 1, "request": 2, "metadata": 3}


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base32, without Python."""
    hexed = F.sha1(payload)
    # 40 bits at a time make eight letters.
    groups = F.transform(
        F.sequence(F.lit(0), F.lit(3)),
        lambda g: F.conv(F.substring(hexed, g * 10 + 1, F.lit(10)), 16, 10).cast("bigint"),
    )

    def letters(group: Column) -> Column:
        five = [F.shiftright(group, 35 - 5 * i).bitwiseAND(F.lit(31)).cast("int") for i in range(8)]
        return F.concat(*(F.substring(F.lit(BASE32), v + 1, F.lit(1)) for v in five))

    return F.array_join(F.transform(groups, letters), "")


def _record_id(capture: Column, kind: str) -> Column:
    """A version 8 UUID of the capture's number and the record's kind."""
    h = F.lpad(F.hex(capture), 16, "0")

    def part(start: int, size: int) -> Column:
        return F.substring(h, start, size)

    return F.lower(
        F.concat(
            F.lit("<urn:uuid:"), part(1, 8), F.lit("-"), part(9, 4), F.lit(f"-8{KINDS[kind]:03x}-8"),
            part(13, 3), F.lit("-"), part(16, 1), F.lit("0" * 11 + ">"),
        )
    )


def _lines(*fields: tuple[str, Column]) -> Column:
    """Header lines of the fields that aren't null."""
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")) for name, value in fields]
    return F.concat_ws("", *lines)


def _record(kind: Column | str, capture: Column, as_kind: str, block: Column, content: str, *fields) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    head = _lines(
        ("WARC-Type", kind),
        ("WARC-Record-ID", _record_id(capture, as_kind)),
        *fields,
        ("Content-Type", F.lit(content)),
        ("Content-Length", F.octet_length(block).cast("string")),
    )
    return F.concat(F.lit(f"{VERSION}\r\n"), head, F.lit("\r\n"), block)


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    date: str = "1970-01-01T00:00:00Z",
    min_revisit_bytes: int = 0,
) -> None:
    """Write the pages as gzipped WARC files to a new folder."""
    rows = pages.select(
        F.monotonically_increasing_id().alias("capture"),
        F.col(id_col).cast("bigint").alias("page_id"),
        F.regexp_replace(F.col(url_col), r"[\r\n]", "%0A").alias("url"),
        F.coalesce(F.col(payload_col), F.lit("")).alias("payload"),
    ).withColumns({"digest": base32_sha1(F.col("payload")), "bytes": F.octet_length("payload")})
    order = F.struct(F.isnull("page_id").alias("none"), "page_id", "capture")
    repeated = (
        rows.where(F.col("bytes") >= min_revisit_bytes)
        .groupBy("digest", "bytes")
        .agg(F.min(order).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select("digest", "bytes", F.col("first.page_id").alias("first_page"), F.col("first.capture").alias("first_capture"))
    )
    known = rows.join(repeated, ["digest", "bytes"], "left")
    capture, first = F.col("capture"), F.col("first_capture")
    again = first.isNotNull() & (first != capture)
    fields = [
        ("WARC-Target-URI", F.col("url")),
        ("WARC-Date", F.lit(date)),
    ]
    about = [("WARC-Concurrent-To", _record_id(capture, "response")), *fields]
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    response = _record(
        F.when(again, "revisit").otherwise("response"),
        capture,
        "response",
        F.concat(http, F.when(again, F.lit("")).otherwise(F.col("payload"))),
        "application/http; msgtype=response",
        *fields,
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Profile", F.when(again, REVISIT_PROFILE)),
        ("WARC-Refers-To", F.when(again, _record_id(first, "response"))),
    )
    request = _record(
        "request",
        capture,
        "request",
        F.concat(F.lit("GET "), F.coalesce(F.col("url"), F.lit("*")), F.lit(" HTTP/1.1\r\n\r\n")),
        "application/http; msgtype=request",
        *about,
    )
    metadata = _record(
        "metadata",
        capture,
        "metadata",
        _lines(
            ("page-id", F.col("page_id").cast("string")),
            ("refers-to-page-id", F.when(again, F.col("first_page").cast("string"))),
        ),
        "application/warc-fields",
        *about,
    )
    together = F.concat_ws(RECORD_END, request, response, metadata)
    (
        known.select(together.alias("value"))
        .write.option("lineSep", RECORD_END)
        .option("compression", "gzip")
        .text(folder)
    )


def parse_records(parts: Iterable[bytes]) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """(header fields in lower case, block) of each record of one file, given
    what lies between the record ends in it."""
    end = RECORD_END.encode()
    fields = None
    wanted, held, size = 0, [], 0
    for part in parts:
        if fields is None:
            head = part.lstrip(b"\r\n")
            if not head:
                continue
            version, *lines = head.decode("utf-8", "replace").split("\r\n")
            if not version.startswith("WARC/"):
                raise ValueError(f"no WARC record: {version[:80]!r}")
            fields = {}
            for line in lines:
                name, _, value = line.partition(":")
                fields.setdefault(name.strip().lower(), []).append(value.strip())
            wanted, held, size = int(fields["content-length"][0]), [], 0
            if wanted:
                continue
        else:
            held += (part, end)
            size += len(part) + len(end)
        if size >= wanted:
            yield fields, b"".join(held)[:wanted]
            fields = None
    if fields is not None:
        raise ValueError("the last record is cut off")


RECORD = """record_id STRING, type STRING, concurrent_to STRING, refers_to STRING, target_uri STRING,
    date STRING, http_head STRING, fields MAP<STRING, STRING>, payload BINARY, payload_bytes BIGINT,
    payload_digest STRING"""


def _row(fields: dict[str, list[str]], block: bytes, with_payload: bool) -> dict:
    kind = fields["warc-type"][0]
    row = {
        "record_id": fields["warc-record-id"][0],
        "type": kind,
        "concurrent_to": fields.get("warc-concurrent-to", [None])[0],
        "refers_to": fields.get("warc-refers-to", [None])[0],
        "target_uri": fields.get("warc-target-uri", [None])[0],
        "date": fields.get("warc-date", [None])[0],
    }
    content = fields.get("content-type", [""])[0]
    if content.startswith("application/warc-fields"):
        pairs = (line.partition(":") for line in block.decode("utf-8", "replace").split("\r\n") if line)
        row["fields"] = [(name.strip(), value.strip()) for name, _, value in pairs]
    elif content.startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        row["http_head"] = head.decode("utf-8", "replace")
        if kind == "revisit":  # the payload lies in the record referred to
            sizes = [h.partition(":")[2] for h in row["http_head"].split("\r\n") if h.lower().startswith("content-length:")]
            row["payload_bytes"] = int(sizes[0]) if sizes else None
            row["payload_digest"] = fields.get("warc-payload-digest", [""])[0].removeprefix("sha1:") or None
        else:
            row["payload_bytes"] = len(payload)
            row["payload_digest"] = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            row["payload"] = payload if with_payload else None
    else:
        row["payload"] = block if with_payload else None
        row["payload_bytes"] = len(block)
        row["payload_digest"] = base64.b32encode(hashlib.sha1(block).digest()).decode()
    return row


def read_records(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """All records of the gzipped WARC files in a folder; digests are computed
    from the payloads, and declared ones taken only for revisits."""
    parts = (
        spark.read.option("lineSep", RECORD_END)
        .option("pathGlobFilter", "*.gz")
        .text(folder)
        .select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))
    )
    types = pa.schema(
        [
            *((n, pa.string()) for n in ("record_id", "type", "concurrent_to", "refers_to", "target_uri", "date", "http_head")),
            ("fields", pa.map_(pa.string(), pa.string())),
            ("payload", pa.binary()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
        ]
    )

    def by_file(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
        for batch in batches:
            yield from zip(batch.column("file").to_pylist(), (v.as_py() for v in batch.column("value")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for _, own in groupby(by_file(batches), key=lambda x: x[0]):
            for fields, block in parse_records(part for _, part in own):
                rows.append(_row(fields, block, with_payload))
                size += len(block) if with_payload else 0
                if len(rows) >= 5000 or size >= 1 << 24:
                    yield pa.RecordBatch.from_pylist(rows, schema=types)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=types)

    return parts.mapInArrow(run, RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: the main record, its request and its metadata.

    A record that names no other by Concurrent-To is a capture's main record; a
    request or metadata record whose main record is missing still gives a row.
    """
    side = F.col("type").isin("request", "metadata")
    fields = F.struct("record_id", "type", "target_uri", "date", "refers_to", "http_head", "payload", "payload_bytes", "payload_digest")
    request = F.struct("record_id", "http_head")
    metadata = F.struct("record_id", "fields")
    return (
        records.withColumn("capture_id", F.when(side, F.coalesce("concurrent_to", "record_id")).otherwise(F.col("record_id")))
        .groupBy("capture_id")
        .agg(
            F.first(F.when(~side, fields), ignorenulls=True).alias("main"),
            F.first(F.when(F.col("type") == "request", request), ignorenulls=True).alias("request"),
            F.first(F.when(F.col("type") == "metadata", metadata), ignorenulls=True).alias("metadata"),
        )
    )


def digest(captures: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    fields = F.col("metadata.fields")
    return captures.select(
        fields["page-id"].cast("bigint").alias("page_id"),
        F.col("main.payload_bytes").alias("payload_bytes"),
        F.col("main.payload_digest").alias("payload_digest"),
        F.col("main.type").alias("record_type"),
        fields["refers-to-page-id"].cast("bigint").alias("refers_to"),
    )
