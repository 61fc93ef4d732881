"""Archives: records, payloads stored once, exact reconstruction."""

import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from chattermark.llm import warc
from chattermark.sources.staging import new_folder


@pytest.fixture
def archive(spark):
    def build(rows, **options):
        pages = spark.createDataFrame(rows, "page_id long, url string, html string")
        folder = new_folder(spark, "warc-test")
        warc.write_archive(pages, folder, **options)
        return folder

    return build


def records(spark, folder):
    return warc.read_records(spark, folder).withColumns(
        {"type": warc.header_type(), "refers_to": warc.header_field("WARC-Refers-To-Page")}
    ).collect()


def test_copies_are_revisits_and_stored_once(spark, archive):
    rows = [(5, "u5", "same"), (3, "u3", "same"), (9, "u9", "same"), (4, "u4", "other"), (7, "u\r\n7", "é x")]
    folder = archive(rows)
    found = {r.page_id: r for r in records(spark, folder)}
    assert {i: (r.type, r.refers_to) for i, r in found.items()} == {
        5: ("revisit", "3"), 3: ("response", None), 9: ("revisit", "3"),
        4: ("response", None), 7: ("response", None),
    }
    for page_id, _, html in rows:
        assert bytes(found[page_id].payload) == html.encode()
    payloads = spark.read.parquet(f"{folder}/payloads").collect()
    assert sorted(gzip.decompress(r.packed) for r in payloads) == sorted({h.encode() for _, _, h in rows})


def test_record_bytes(spark, archive):
    found = {r.page_id: r for r in records(spark, archive([(1, "http://a/", "<p>é</p>"), (2, "http://b/", "<p>é</p>")]))}
    body = "<p>é</p>".encode()
    digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
    head, rest = bytes(found[1].record).split(b"\r\n\r\n", 1)
    lines = head.decode().split("\r\n")
    assert lines[0] == "WARC/1.1" and f"WARC-Payload-Digest: sha1:{digest}" in lines
    assert f"Content-Length: {len(body)}" in lines and rest == body + b"\r\n\r\n"
    head, rest = bytes(found[2].record).split(b"\r\n\r\n", 1)
    first_id = next(x for x in lines if x.startswith("WARC-Record-ID: ")).removeprefix("WARC-Record-ID: ")
    assert f"WARC-Refers-To: {first_id}" in head.decode().split("\r\n")
    assert "Content-Length: 0" in head.decode() and rest == b"\r\n\r\n"


def test_a_wrong_payload_ends_the_job(spark, archive):
    folder = archive([(1, "u", "right")])
    payloads = spark.read.parquet(f"{folder}/payloads").collect()
    bad = spark.createDataFrame([(payloads[0].address, bytearray(gzip.compress(b"wrong")))], "address binary, packed binary")
    other = new_folder(spark, "warc-bad")
    spark.read.parquet(f"{folder}/headers").write.parquet(f"{other}/headers")
    bad.write.parquet(f"{other}/payloads")
    with pytest.raises(Exception, match="does not match its address"):
        warc.read_records(spark, other).collect()


def test_small_payloads_are_responses(spark, archive):
    folder = archive([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcd"), (4, "u", "abcd")], min_bytes=3)
    assert {r.page_id: r.type for r in records(spark, folder)} == {
        1: "response", 2: "response", 3: "response", 4: "revisit",
    }
    assert spark.read.parquet(f"{folder}/payloads").count() == 2


def test_nulls_repeats_and_long_payloads(spark, archive):
    long = "x" * 300_000
    folder = archive([(None, None, None), (2, None, ""), (3, "u", long), (3, "u", long), (4, "u", long), (None, "v", "only")])
    found = records(spark, folder)
    kinds = sorted((r.page_id or 0, r.type, r.refers_to, len(r.payload)) for r in found)
    assert kinds == [
        (0, "response", None, 4), (0, "revisit", "2", 0), (2, "response", None, 0),
        (3, "response", None, 300_000), (3, "response", None, 300_000), (4, "revisit", "3", 300_000),
    ]
    assert spark.read.parquet(f"{folder}/payloads").count() == 3


def test_empty_archive_and_extra_columns(spark, archive):
    assert records(spark, archive([])) == []
    pages = spark.createDataFrame([(1, "u", "h")], "page_id long, url string, html string").withColumns(
        {"address": F.lit(1), "packed": F.lit(2), "header": F.lit("x"), "keeper": F.lit(0)}
    )
    folder = new_folder(spark, "warc-extra")
    warc.write_archive(pages, folder)
    assert [bytes(r.payload) for r in records(spark, folder)] == [b"h"]
