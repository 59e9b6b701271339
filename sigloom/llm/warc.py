"""WARC archives: write, index, and read selected records by byte ranges.

Writing: a record per page, one archive per task.  Spark's text writer ends every line with its separator; with two line
breaks as the separator, its output is a valid archive, and task retries are handled by its commit.
Index first: a task walks the headers of an archive and skips the payloads by their lengths, which gives file, offset,
length, URL and digest of every record.
Reading: the index rows of the selected records are sorted by file and offset; neighbours less than ``GAP`` apart form one
range of at most ``RANGE_BYTES`` (a longer record is a range of its own), and each range is one read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sigloom.llm.common import written

END = "\r\n\r\n"
GAP = 64 << 10
RANGE_BYTES = 8 << 20
HEADER_BYTES = 64 << 10  # read at once while walking headers

INDEX_SCHEMA = ("file string, offset bigint, length bigint, page_id bigint, url string, payload_digest string, payload_bytes bigint, "
                "record_type string, refers_to bigint, body_at bigint")
RECORD_SCHEMA = ("file string, offset bigint, page_id bigint, url string, record_type string, refers_to bigint, payload binary, "
                 "payload_bytes bigint, payload_digest string")


def base32_sha1(content: Column) -> Column:
    """SHA-1 in base 32: 160 bits are four times ten hexadecimal or eight base-32 digits."""
    digits = F.sha1(content)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_types(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, digest, bytes, refers_to): of equal payloads of at least ``least_bytes`` bytes the smallest id is stored, others refer to it."""
    html = F.coalesce(F.col(f"`{html_col}`"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").cast("bigint").alias("page_id"), F.col(f"`{url_col}`").alias("url"), html.alias("html"))
    rows = rows.withColumn("bytes", F.octet_length("html").cast("bigint")).withColumn("digest", base32_sha1(F.col("html").cast("binary")))
    # Written, so that the join below deals out both sides itself and can split a payload that many pages share.
    shared = written(rows.filter(F.col("bytes") >= least_bytes).groupBy("digest", "bytes")
                         .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "shared-payloads")
    joined = rows.join(shared, ["digest", "bytes"], "left")
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.withColumn("refers_to", F.when(other, F.col("first"))).drop("first")


def _record(date: str) -> Column:
    """The text of a record without its closing line breaks.  A revisit keeps headers only."""
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise(F.lit(""))
    revisit = F.col("refers_to").isNotNull()
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    body = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Payload-Length", F.col("bytes").cast("string")),
        line("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">"))),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        line("Content-Length", (F.octet_length(http) + F.octet_length(body)).cast("string")),
        F.lit("\r\n"), http, body)


def write_archives(typed: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Archives in the folder ``path``, uncompressed, one per task."""
    typed.select(_record(date).alias("value")).write.option("lineSep", END).option("compression", "none").text(path)


def _open(file: str):
    from pyarrow import fs
    system, place = fs.FileSystem.from_uri(file)
    return system.open_input_file(place)


def _parse(head: bytes) -> dict[str, str]:
    return dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:] if ": " in x)


def _number(urn: str | None) -> int | None:
    digits = (urn or "")[len("<urn:page:"):-1]
    return int(digits) if digits else None


def index(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives in ``path``; written, so that many reads can use it."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = []
                with _open(file) as f:
                    at = 0
                    while at < size:
                        head = b""
                        while (stop := head.find(b"\r\n\r\n")) < 0:
                            more = f.read_at(HEADER_BYTES, at + len(head))
                            if not more:
                                raise ValueError(f"{file} ends inside a header at {at}")
                            head += more
                        fields = _parse(head[:stop])
                        length = stop + 4 + int(fields["Content-Length"]) + len(END)
                        rows.append((file, at, length, _number(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                                     int(fields["WARC-Payload-Length"]), fields["WARC-Type"], _number(fields.get("WARC-Refers-To")), stop + 4))
                        at += length
                        if len(rows) == 10_000:
                            yield _batch(rows, INDEX_SCHEMA)
                            rows = []
                if rows:
                    yield _batch(rows, INDEX_SCHEMA)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).filter("length > 0").select("path", "length")
    many = max(1, files.count())
    return written(files.repartition(many, "path").mapInArrow(walk, INDEX_SCHEMA), "index")


_KINDS = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, k in zip(zip(*rows), kinds)], names)


def read_records(selected: DataFrame) -> DataFrame:
    """Records behind the selected index rows: url, type, reference, payload (null for a revisit), its bytes and SHA-1.

    The digest of a response is computed from what was read and must equal the one in its header.
    """
    in_file = Window.partitionBy("file").orderBy("offset")  # a file holds what one task wrote
    before = F.lag(F.col("offset") + F.col("length")).over(in_file)
    apart = selected.withColumn("new", F.coalesce((F.col("offset") - before > GAP).cast("int"), F.lit(1)))
    span = apart.withColumn("run", F.sum("new").over(in_file)).withColumn("slot", F.floor(F.col("offset") / RANGE_BYTES))
    entry = F.struct("offset", "length", "body_at", "page_id", "url", "payload_digest", "payload_bytes", "record_type", "refers_to")
    ranges = span.groupBy("file", "run", "slot").agg(F.sort_array(F.collect_list(entry)).alias("records"))  # at most RANGE_BYTES of records begin in a slot

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with _open(file) as f:
                    first, last = records[0], records[-1]
                    content = f.read_at(last["offset"] + last["length"] - first["offset"], first["offset"])
                rows = []
                for r in records:
                    at = r["offset"] - first["offset"]
                    body = content[at + r["body_at"]:at + r["length"] - len(END)]
                    payload = body[body.index(b"\r\n\r\n") + 4:]
                    if r["record_type"] == "revisit":
                        payload, size, digest = None, r["payload_bytes"], r["payload_digest"]
                    else:
                        size, digest = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
                        if digest != r["payload_digest"]:
                            raise ValueError(f"record at {r['offset']} of {file} does not match its digest")
                    rows.append((file, r["offset"], r["page_id"], r["url"], r["record_type"], r["refers_to"], payload, size, digest))
                yield _batch(rows, RECORD_SCHEMA)

    return ranges.select("file", "records").mapInArrow(fetch, RECORD_SCHEMA)
