"""WARC archives with revisit resolution.

Only headers travel by payload digest: the digest, length and page id of every page are grouped by digest, the page with the largest id
becomes the response, the other pages of the digest are joined back to it as revisits, and payloads are written for
responses alone, under fresh headers. Archives are gzipped WARC/1.1 files that Spark writes and reads, so they may lie in any store that
Spark reaches. A record ends with two line breaks; that is the line separator given to the text writer, so a row
is a record. Files are cut by size, and reading takes a file per row, walking from record to record by Content-Length.

Edge cases: a null html is an empty payload and a null url an empty target; line breaks in a url become spaces; payloads shorter than
``min_bytes`` are responses each; pages that repeat the largest id of their digest are all responses; pages without an id rank below those
with one, and where no page of a digest has an id, all are responses; an empty table gives empty archives, read back as no record.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.sources.staging import fresh_path, stage

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORD_END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of payload in one archive file, about; a file is read as one row.
FILE_BYTES = 16 << 20


def sha1_base32(data: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 160 bits are eight groups of 20 bits, four letters each."""
    hexed = F.sha1(data)
    groups = [F.conv(F.substring(hexed, 1 + 5 * g, 5), 16, 10).cast("int") for g in range(8)]
    letters = [
        F.substring(F.lit(BASE32), F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1)) for v in groups for s in (15, 10, 5, 0)
    ]
    return F.concat(*letters)


def record_id(page_id: Column) -> Column:
    """A urn of the UUID form that holds the page's id in hexadecimal."""
    h = F.lpad(F.lower(F.hex(page_id)), 16, "0")
    tail = F.concat(F.substring(h, 1, 4), F.lit("-8"), F.substring(h, 5, 3), F.lit("-"), F.lpad(F.substring(h, 8, 9), 12, "0"))
    return F.coalesce(F.concat(F.lit("<urn:uuid:00000000-0000-"), tail, F.lit(">")), F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">")))


def resolve(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, digest, payload_bytes -> the same with origin: the page a revisit refers to, null for responses.

    Grouping by digest combines before its shuffle. In the join back one row per digest meets its copies; adaptive execution splits a
    digest with many.
    """
    origins = headers.groupBy("digest").agg(F.max("page_id").alias("first"))
    return headers.join(origins, "digest").select(
        "page_id",
        "digest",
        "payload_bytes",
        F.when((F.col("payload_bytes") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("origin"),
    )


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, date: str = "2000-01-01T00:00:00Z", file_bytes: int = FILE_BYTES) -> None:
    """Write one record per page to ``path``; ``pages`` has page_id, url, html. ``date`` is the date of capture."""
    body = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), "[\r\n]", " ").alias("url"),
        F.coalesce(F.col("html"), F.lit("")).alias("html"),
    ).select("*", sha1_base32(F.col("html").cast("binary")).alias("digest"), F.octet_length("html").cast("long").alias("payload_bytes"))
    heads = stage(body.select("page_id", "digest", "payload_bytes"), "warc-heads")
    found = resolve(heads, min_bytes).where("origin IS NOT NULL").select("page_id", "digest", "origin").distinct()
    total = heads.agg(F.sum("payload_bytes")).first()[0] or 0
    # ids may repeat with another payload: the digest belongs to the key; payloads move once, to the join's and the files' layout
    marked = body.repartition(max(1, -(-total // file_bytes)), "page_id", "digest").join(found, ["page_id", "digest"], "left")
    revisit = F.col("origin").isNotNull()
    line = "\r\n"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{line}Content-Type: text/html; charset=utf-8{line}Content-Length: "), F.col("payload_bytes"), F.lit(line + line)
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    head = F.concat(
        F.lit("WARC/1.1" + line),
        F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit(line),
        F.lit("WARC-Record-ID: "), record_id(F.col("page_id")), F.lit(line),
        F.lit(f"WARC-Date: {date}{line}"),
        F.lit("WARC-Target-URI: "), F.col("url"), F.lit(line),
        F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit(line),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}{line}WARC-Refers-To: "), record_id(F.col("origin")), F.lit(line))).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response" + line),
        F.coalesce(F.concat(F.lit("X-Page-Id: "), F.col("page_id"), F.lit(line)), F.lit("")),
        F.lit("Content-Length: "), F.octet_length("block"), F.lit(line + line),
    )
    records = marked.withColumn("block", block).select(F.concat(head, F.col("block")).alias("value"))
    records.write.option("lineSep", RECORD_END).option("compression", "gzip").text(path)


_FIELD = re.compile(rb"^([A-Za-z-]+): ?(.*)$", re.M)


def walk(data: bytes) -> Iterator[tuple[dict[bytes, bytes], memoryview]]:
    """Header fields and block of each record of an archive."""
    at, view = 0, memoryview(data)
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        fields = {k.lower(): v.strip() for k, v in _FIELD.findall(data[at:end])}
        start = end + 4
        stop = start + int(fields[b"content-length"])
        yield fields, view[start:stop]
        at = stop + 4


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record: page_id, record_id, record_type, payload_bytes, payload_digest, refers_to_id, and payload if asked for.

    The digest of a response is checked against its payload; a record that does not match is an error.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for content in b["content"]:
                rows = []
                for fields, block in walk(gzip.decompress(content)):
                    raw = bytes(block)
                    cut = raw.index(b"\r\n\r\n") + 4
                    payload, kind = raw[cut:], fields[b"warc-type"].decode()
                    digest = fields[b"warc-payload-digest"].decode().removeprefix("sha1:")
                    if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"record {fields[b'warc-record-id']!r} does not match its digest")
                    size = int(re.search(rb"Content-Length: (\d+)", raw[:cut])[1])
                    page, refers = fields.get(b"x-page-id"), fields.get(b"warc-refers-to")
                    row = (page and int(page), fields[b"warc-record-id"].decode(), kind, size, digest, refers and refers.decode())
                    rows.append((*row, payload) if with_payload else row)
                    if len(rows) == 2000:
                        yield frame(rows)
                        rows = []
                yield frame(rows)

    names = ["page_id", "record_id", "record_type", "payload_bytes", "payload_digest", "refers_to_id"]
    names += ["payload"] if with_payload else []

    def frame(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=names).astype({"page_id": "Int64"})

    schema = "page_id long, record_id string, record_type string, payload_bytes long, payload_digest string, refers_to_id string"
    schema += ", payload binary" if with_payload else ""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInPandas(run, schema)


def archive_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the archives, read them back, and resolve each revisit to its response's page."""
    spark = pages.sparkSession
    path = fresh_path(spark, "warc")
    write_archives(pages, path, min_bytes)
    records = stage(read_archives(spark, path), "warc-records")
    responses = records.where("record_type = 'response'").groupBy(F.col("payload_digest").alias("d"), F.col("record_id").alias("r"))
    responses = responses.agg(F.max("page_id").alias("refers_to"))
    return records.join(
        responses, (F.col("payload_digest") == F.col("d")) & (F.col("refers_to_id") == F.col("r")), "left"
    ).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
