"""A content-addressed WARC archive: payload bytes once, record headers apart.

An archive is two Parquet tables in one folder. `headers` holds the exact
header block of every record with the SHA-256 address of its payload;
`payloads` holds each distinct payload once, packed with gzip, by address.
Joining them gives back the original records, byte for byte.

Of the records with equal payloads, the one with the smallest page id is the
`response`; the others are `revisit` records that refer to it. Payloads below
`min_bytes` are always responses, and still stored once.

Only addresses and page ids are grouped, combined on the map side, so thousands
of copies of one payload move as one row per map task. Payloads move packed,
once when written and once when read, and the joins are on the address, where
Spark splits hot keys. When reading, every payload is unpacked and hashed
again; one that does not match its address ends the job.

Defined results: a null html is an empty payload, a null url an empty target. A
row without page id is a revisit if another row with an id has the payload, and
else a response; rows that repeat a page id and payload are all alike. Header
values have line breaks taken out. An empty table makes an empty archive.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The header fields of WARC/1.1 records, and the profile of a revisit.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"


def payload_digest(payload: bytes) -> str:
    """Upper-case base32 SHA-1, the form archives use."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _addresses(pages: DataFrame) -> DataFrame:
    """Per page its id, url, payload address, base32 digest and length."""

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            payloads = [(x or "").encode() for x in batch["html"]]
            yield pd.DataFrame(
                {
                    "page_id": batch["page_id"].astype("Int64"),
                    "url": batch["url"],
                    "address": [hashlib.sha256(x).digest() for x in payloads],
                    "digest": [payload_digest(x) for x in payloads],
                    "n_bytes": [len(x) for x in payloads],
                }
            )

    schema = "page_id long, url string, address binary, digest string, n_bytes long"
    return _narrow(pages).mapInPandas(hashed, schema)


def _narrow(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")


def _record_uri(page_id: Column) -> Column:
    """A record id that follows from the page id, so reruns write the same bytes."""
    h = F.md5(F.concat(F.lit("page:"), F.coalesce(page_id.cast("string"), F.lit(""))))
    cuts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def _header_block(date: str) -> Column:
    """The header lines of a record, with the empty line that ends them."""
    revisit = F.col("record_type") == "revisit"

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(END))

    referred = F.concat(
        line("WARC-Refers-To", _record_uri(F.col("refers_to"))),
        line("WARC-Refers-To-Page", F.col("refers_to").cast("string")),
        line("WARC-Profile", F.lit(REVISIT_PROFILE)),
    )
    target = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]+", " ")
    return F.concat(
        F.lit(VERSION + END),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", _record_uri(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", target),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, referred).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes")).cast("string")),
        F.lit(END),
    )


def write_archive(
    pages: DataFrame, path: str, *, min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z"
) -> None:
    """Write the records of `pages` (page_id, url, html) to `path`/headers and `path`/payloads."""
    addresses = _addresses(pages)
    keepers = addresses.groupBy("address").agg(F.min("page_id").alias("keeper"))
    revisits = (F.col("n_bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    headers = (
        addresses.join(keepers, "address")
        .withColumn("record_type", F.when(revisits, "revisit").otherwise("response"))
        .withColumn("refers_to", F.when(revisits, F.col("keeper")))
        .select("page_id", "address", _header_block(date).alias("header"))
    )
    headers.write.parquet(f"{path}/headers")

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            payloads = [(x or "").encode() for x in batch["html"]]
            yield pd.DataFrame(
                {
                    "page_id": batch["page_id"].astype("Int64"),
                    "address": [hashlib.sha256(x).digest() for x in payloads],
                    "packed": [gzip.compress(x, 6, mtime=0) for x in payloads],
                }
            )

    schema = "page_id long, address binary, packed binary"
    same_page = Window.partitionBy("address", "page_key").orderBy("page_key")
    no_id = F.lit(-(2**63))
    (
        _narrow(pages)
        .mapInPandas(packed, schema)
        .withColumn("page_key", F.coalesce("page_id", no_id))
        .join(
            keepers.select("address", F.coalesce("keeper", no_id).alias("page_key")),
            ["address", "page_key"],
        )
        .withColumn("copy", F.row_number().over(same_page))
        .where("copy = 1")
        .select("address", "packed")
        .write.option("compression", "uncompressed")
        .parquet(f"{path}/payloads")
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record again: (page_id, header, payload, record).

    `payload` is the full payload also of a revisit, found by its address;
    `record` holds the bytes as they would stand in a WARC file, where a revisit
    has no payload of its own.
    """
    headers = spark.read.schema("page_id long, address binary, header string").parquet(f"{path}/headers")
    payloads = spark.read.schema("address binary, packed binary").parquet(f"{path}/payloads")

    @F.pandas_udf("binary")
    def verified(addresses: pd.Series, packs: pd.Series) -> pd.Series:
        out = []
        for address, pack in zip(addresses, packs, strict=True):
            payload = gzip.decompress(pack)
            if hashlib.sha256(payload).digest() != address:
                raise ValueError(f"payload {bytes(address).hex()} does not match its address")
            out.append(payload)
        return pd.Series(out, dtype=object)

    body = F.when(header_type() == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return (
        headers.join(payloads, "address", "left")
        .withColumn("payload", verified("address", "packed"))
        .select(
            "page_id",
            "header",
            "payload",
            F.concat(F.encode("header", "UTF-8"), body, F.lit((END + END).encode())).alias("record"),
        )
    )


def header_field(name: str) -> Column:
    """The value of a header line, or null."""
    found = F.regexp_extract("header", rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(F.col("header").contains(f"{END}{name}: "), found)


def header_type() -> Column:
    return header_field("WARC-Type")
