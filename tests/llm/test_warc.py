import base64
import glob
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from muster.llm import warc
from muster.sources.scratch import new_folder

HOSTILE = [
    None, "", "\r\n", "\r\n\r\n", "a\r\n\r\nWARC/1.1\r\nContent-Length: 9\r\n\r\nb", "x\r\n", "x\r\n\r", "x\r\n\r\r\n\r\n",
    "\n\n\r\r", "WARC/1.1\r\n", "é日本", "x\r\n", "x" * 300_000, "same", "same", "same", "\x00\x01",
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def archive(spark, pages, **options):
    folder = new_folder(spark, "warc")
    warc.write_archives(pages, folder, **options)
    return folder


def pages_of(spark, texts):
    rows = [(100 - i, f"http://x.org/{i}\r\nX: y" if i % 3 else None, t, "z") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING, payload STRING").coalesce(2)


def test_round_trip_of_hostile_payloads(spark):
    pages = pages_of(spark, HOSTILE)
    folder = archive(spark, pages)
    records = warc.read_records(spark, folder)
    assert records.count() == 3 * len(HOSTILE)
    got = {r.metadata.fields["page-id"]: r for r in warc.assemble(records).collect()}
    first = {}
    for number, text in sorted((100 - i, t or "") for i, t in enumerate(HOSTILE)):
        capture = got[str(number)]
        assert capture.main.payload_digest == digest(text)
        assert capture.main.payload_bytes == len(text.encode())
        assert capture.request.http_head.startswith("GET ")
        if text in first:
            assert (capture.main.type, capture.metadata.fields["refers-to-page-id"]) == ("revisit", str(first[text]))
            assert capture.main.refers_to == got[str(first[text])].main.record_id
            assert capture.main.payload is None
        else:
            first[text] = number
            assert (capture.main.type, bytes(capture.main.payload)) == ("response", text.encode())


def test_archives_are_valid_warc(spark):
    folder = archive(spark, pages_of(spark, HOSTILE))
    records = []
    for name in glob.glob(f"{folder}/*.gz"):
        data = gzip.open(name).read()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
            size = int(fields["Content-Length"])
            assert head.startswith(b"WARC/1.1\r\n") and rest[size : size + 4] == b"\r\n\r\n"
            records.append((fields, rest[:size]))
            data = rest[size + 4 :]
    assert len({f["WARC-Record-ID"] for f, _ in records}) == len(records) == 3 * len(HOSTILE)
    ids = {f["WARC-Record-ID"] for f, _ in records if f["WARC-Type"] in ("response", "revisit")}
    assert all(f["WARC-Concurrent-To"] in ids for f, _ in records if f["WARC-Type"] in ("request", "metadata"))


def test_nulls_repeats_and_small_payloads(spark):
    rows = [(None, None, "p"), (3, "u", "p"), (3, "u", "p"), (4, "u", ""), (5, "u", None)]
    pages = spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING")
    out = warc.digest(warc.assemble(warc.read_records(spark, archive(spark, pages)))).collect()
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to or 0) for r in out)
    assert kinds == [
        (0, "revisit", 3), (3, "response", 0), (3, "revisit", 3), (4, "response", 0), (5, "revisit", 4),
    ]
    large = warc.digest(warc.assemble(warc.read_records(spark, archive(spark, pages, min_revisit_bytes=1))))
    assert large.where("payload_bytes = 0 AND record_type = 'response'").count() == 2


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id BIGINT, url STRING, html STRING")
    assert warc.assemble(warc.read_records(spark, archive(spark, pages))).count() == 0


def test_records_without_partner_are_kept(spark):
    rows = [("<a>", "response", None), ("<b>", "request", "<a>"), ("<c>", "metadata", "<lost>"), ("<d>", "request", None)]
    schema = "record_id STRING, type STRING, concurrent_to STRING"
    records = spark.createDataFrame(rows, schema).selectExpr(
        "*", "string(null) refers_to", "string(null) target_uri", "string(null) date", "string(null) http_head",
        "map('k', 'v') fields", "binary(null) payload", "0L payload_bytes", "string(null) payload_digest",
    )
    got = {r.capture_id: (r.main is not None, r.request is not None, r.metadata is not None) for r in warc.assemble(records).collect()}
    assert got == {"<a>": (True, True, False), "<lost>": (False, False, True), "<d>": (False, True, False)}


def test_cut_off_records_are_an_error():
    with pytest.raises(ValueError):
        list(warc.parse_records([b"WARC/1.1\r\nContent-Length: 9", b"abc"]))


def test_base32(spark):
    for text in ("", "a", "日本" * 50):
        assert spark.range(1).select(warc.base32_sha1(F.lit(text))).first()[0] == digest(text)
