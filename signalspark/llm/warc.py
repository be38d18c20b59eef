"""Operator 9, WARC archives with revisit resolution.

Headers (payload digest, payload length, page id) are grouped by digest; of
equal payloads of at least ``MIN_REVISIT`` bytes the largest page id is the
response and the others become ``revisit`` records that refer to it. Every
record gets fresh headers. Archives are written by Spark's text writer, whose
line separator is the blank line that ends a WARC record, gzip-compressed, so
commit and retry are Spark's own. Reading back parses the archives by their
Content-Length fields.

Payloads travel once: the pages are joined with the groups of two or more by
digest (a join that adaptive execution may split or turn into a broadcast);
groups of one never enter it.

Edge cases: a null html is an empty payload; rows that repeat the response's
page id are all responses; in a group without any page id every row is a
response; CR and LF in a URL become %0D and %0A; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalspark.llm.common import free_name, text_of
from signalspark.session import work_dir

MIN_REVISIT = 1000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
PARSED = ("page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def resolve_revisits(pages: DataFrame, key: str = "page_id", payload: str = "html",
                     min_bytes: int = MIN_REVISIT) -> DataFrame:
    """``pages`` with ``payload_digest``, ``payload_bytes``, ``record_type`` and ``refers_to``."""
    body = text_of(payload)
    pages = (pages.drop("payload_digest", "payload_bytes", "record_type", "refers_to")
             .withColumn("payload_digest", F.sha1(body.cast("binary")))
             .withColumn("payload_bytes", F.octet_length(body).cast("long")))
    response = free_name(pages, "_response")
    groups = (pages.filter(F.col("payload_bytes") >= min_bytes)
              .groupBy("payload_digest").agg(F.max(key).alias(response), F.count(F.lit(1)).alias("n"))
              .filter("n > 1").select("payload_digest", response))
    revisit = F.col(response).isNotNull() & ~F.col(response).eqNullSafe(F.col(key))
    return (pages.join(groups, "payload_digest", "left")
            .withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
            .withColumn("refers_to", F.when(revisit, F.col(response))).drop(response))


def _uri(key: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(key.cast("string"), F.lit("null")), F.lit(">"))


def warc_record(key: str, url: str, payload: str, date: str) -> Column:
    """One record as text, without the blank lines that end it."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    revisit = F.col("record_type") == "revisit"
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
                    line("Content-Length", F.col("payload_bytes").cast("string")), F.lit("\r\n"))
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("payload_bytes"))
    target = F.replace(F.replace(text_of(url), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", _uri(F.col(key))), line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", target),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)),
                                 line("WARC-Refers-To", _uri(F.col("refers_to"))))).otherwise(""),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", length.cast("string")), F.lit("\r\n"), http,
        F.when(revisit, "").otherwise(text_of(payload)))


def write_archives(resolved: DataFrame, path: str, key: str = "page_id", url: str = "url",
                   payload: str = "html", date: str = "2024-01-01T00:00:00Z",
                   records_per_file: int = 20_000) -> None:
    """Gzip archives under ``path``; records end with the two line breaks of the format."""
    (resolved.select(warc_record(key, url, payload, date).alias("value")).write
     .option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", records_per_file).text(path))


def _records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record, decompressing in steps."""
    z, buf = zlib.decompressobj(31), bytearray()
    fed = 0

    def more() -> bool:
        nonlocal fed
        if fed >= len(content):
            return False
        buf.extend(z.decompress(content[fed:fed + (1 << 18)]))
        fed += 1 << 18
        return True

    while True:
        while (cut := buf.find(b"\r\n\r\n")) < 0:
            if not more():
                if buf.strip():
                    raise ValueError("archive ends inside a header")
                return
        head = dict(x.split(": ", 1) for x in bytes(buf[:cut]).decode().split("\r\n")[1:])
        size = int(head["Content-Length"])
        while len(buf) < cut + 8 + size:
            if not more():
                raise ValueError("archive ends inside a record")
        yield head, bytes(buf[cut + 4:cut + 4 + size])
        del buf[:cut + 8 + size]


def _page(uri: str) -> int | None:
    page = uri.removeprefix("<urn:x-page:").removesuffix(">")
    return None if page == "null" else int(page)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64())])
    for batch in batches:
        for content in batch.column(0):
            rows = []
            for head, block in _records(content.as_py()):
                http, _, payload = block.partition(b"\r\n\r\n")
                size = int(http.rpartition(b"Content-Length: ")[2])
                digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                if head["WARC-Type"] == "response":
                    if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"payload of {head['WARC-Record-ID']} does not fit its digest")
                rows.append((_page(head["WARC-Record-ID"]), size, digest, head["WARC-Type"],
                             _page(head["WARC-Refers-To"]) if "WARC-Refers-To" in head else None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in
                                              zip(zip(*rows) if rows else [[]] * 5, schema)], schema=schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record; response payloads are checked against their digests."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(_parse, PARSED)


def archive_pages(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Resolve, write and read back; ``path`` defaults to a folder under the shared checkpoint root."""
    path = path or work_dir(pages.sparkSession, "warc")
    write_archives(resolve_revisits(pages, **options), path)
    return read_archives(pages.sparkSession, path)
