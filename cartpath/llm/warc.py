"""Web archives: pages to WARC records, and records back to one nested row per capture.

A capture is a transaction of three records: the response (or a revisit of an equal payload), the
request and the metadata, both of which name the response as concurrent to them. Archives are written
by Spark's text writer, whose line separator is the pair of line breaks that ends a record.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpath.llm.common import durable

VERSION, BREAK = "WARC/1.1", "\r\n"
# The digits of base 32 as Spark's conv writes them, and as digests are written.
_CONV32, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORD = (
    "record_id string, type string, concurrent_to string, refers_to string, target_uri string, date string,"
    " payload_digest string, payload binary"
)


def sha1_base32(payload: Column) -> Column:
    """The SHA-1 of bytes in upper-case base 32."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), _CONV32, _BASE32)


def _record_id(kind: str, *names: Column) -> Column:
    digits = F.md5(F.concat_ws("|", F.lit(kind), *(F.coalesce(n.cast("string"), F.lit("-")) for n in names)))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(digits, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def _record(kind: Column | str, headers: dict[str, Column], content_type: str, block: Column) -> Column:
    """A record without the line breaks that end it. Headers with a null value are left out."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    named = {"WARC-Type": kind, **headers, "Content-Type": F.lit(content_type), "Content-Length": F.octet_length(block).cast("string")}
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in named.items()]
    return F.concat(F.concat_ws(BREAK, F.lit(VERSION), *lines), F.lit(BREAK * 2), block)


def records(pages: DataFrame, min_revisit_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Three records (column ``value``) for each row of ``pages`` (page_id, url, html).

    The payload is the html, null as empty. Of equal payloads of at least ``min_revisit_bytes`` the one
    with the largest page_id is the response and the others revisit it; a null page_id counts as smaller
    than any. Rows that repeat the largest page_id are all responses. Line breaks in a url are cut out.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    given = pages.select(F.col("page_id").cast("long"), F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "").alias("url"), html.alias("html"))
    known = given.withColumns({"digest": sha1_base32(F.col("html").cast("binary")), "bytes": F.octet_length("html").cast("long")})
    winners = known.groupBy("digest").agg(F.max("page_id").alias("top_page"))
    joined = known.join(winners, "digest")
    revisit = (F.col("bytes") >= min_revisit_bytes) & ~F.col("page_id").eqNullSafe(F.col("top_page"))
    own = _record_id("response", F.col("page_id"), F.col("digest"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"))
    common = {"WARC-Date": F.lit(date), "WARC-Target-URI": F.col("url")}
    main = _record(
        F.when(F.col("_revisit"), "revisit").otherwise("response"),
        {
            "WARC-Record-ID": own,
            **common,
            "WARC-Payload-Digest": F.concat(F.lit("sha1:"), F.col("digest")),
            "WARC-Refers-To": F.when(F.col("_revisit"), _record_id("response", F.col("top_page"), F.col("digest"))),
            "WARC-Profile": F.when(F.col("_revisit"), F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        },
        "application/http; msgtype=response",
        F.when(F.col("_revisit"), http).otherwise(F.concat(http, F.col("html"))),
    )
    request = _record(
        "request",
        {"WARC-Record-ID": _record_id("request", F.col("page_id"), F.col("digest")), **common, "WARC-Concurrent-To": own},
        "application/http; msgtype=request",
        F.concat(F.lit("GET "), F.col("url"), F.lit(" HTTP/1.1\r\n\r\n")),
    )
    fields = F.concat_ws(
        BREAK,
        F.concat(F.lit("page-id: "), F.col("page_id").cast("string")),
        F.concat(F.lit("payload-length: "), F.col("bytes").cast("string")),
    )
    metadata = _record(
        "metadata",
        {"WARC-Record-ID": _record_id("metadata", F.col("page_id"), F.col("digest")), **common, "WARC-Concurrent-To": own},
        "application/warc-fields",
        fields,
    )
    return joined.withColumn("_revisit", revisit).select(F.explode(F.array(request, main, metadata)).alias("value"))


def write_archives(made: DataFrame, path: str, records_per_file: int = 6_000) -> None:
    """Gzipped archives below ``path``, each of a bounded number of records, as one file is read by one task."""
    made.write.option("lineSep", BREAK * 2).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def parse(archive: bytes) -> Iterator[tuple]:
    """The records of one archive, plain or gzipped as a whole or by record, cut by their Content-Length."""
    if archive[:2] == b"\x1f\x8b":
        plain = bytearray()
        while archive:
            stream = zlib.decompressobj(31)
            plain += stream.decompress(archive) + stream.flush()
            archive = stream.unused_data.lstrip(b"\0")
        archive = bytes(plain)
    at = 0
    while (at := archive.find(b"WARC/", at)) >= 0:
        end = archive.find(b"\r\n\r\n", at)
        if end < 0:
            return
        lines = archive[at:end].decode("utf-8", "replace").split("\r\n")[1:]
        head = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
        block = archive[end + 4 : (at := end + 4 + int(head.get("content-length") or 0))]
        if head.get("content-type", "").startswith("application/http"):
            block = block.partition(b"\r\n\r\n")[2]
        names = ("warc-record-id", "warc-type", "warc-concurrent-to", "warc-refers-to", "warc-target-uri", "warc-date", "warc-payload-digest")
        yield (*map(head.get, names), block)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below ``path``; responses also get the digest of what was read."""

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = [pa.string()] * 7
        for part in parts:
            for i in range(part.num_rows):
                found = list(parse(part.column(0)[i].as_py()))
                for start in range(0, len(found), 1000):
                    columns = list(zip(*found[start : start + 1000], strict=True))
                    digests = [base64.b32encode(hashlib.sha1(x).digest()).decode() if t == "response" else None for t, x in zip(columns[1], columns[7], strict=True)]
                    arrays = [pa.array(c, k) for c, k in zip(columns, [*texts, pa.binary()], strict=True)]
                    names = [*(f.split()[0] for f in RECORD.split(", ")), "read_digest"]
                    yield pa.RecordBatch.from_arrays([*arrays, pa.array(digests, pa.string())], names=names)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("content")
    return files.mapInArrow(read, RECORD + ", read_digest string")


def without_payload(read: DataFrame) -> DataFrame:
    """The records with the payload's length alone, but for the small blocks of requests and metadata."""
    small = F.when(F.col("type").isin("request", "metadata"), F.col("payload"))
    return read.withColumn("payload_bytes", F.length("payload").cast("long")).withColumn("payload", small)


def captures(read: DataFrame) -> DataFrame:
    """One row per response or revisit: ``response``, ``request`` and ``metadata`` as structs.

    A part that is missing is null. Of several requests or metadata records concurrent to one capture the
    smallest record id counts; requests without a capture are left out.
    """
    size = F.col("payload_bytes") if "payload_bytes" in read.columns else F.length("payload").cast("long").alias("payload_bytes")
    fields = ["record_id", "type", "refers_to", "target_uri", "date", "payload_digest", "read_digest", "payload"]
    main = read.where("type IN ('response', 'revisit')")
    parts = main.select(F.col("record_id").alias("capture_id"), F.struct(*fields, size).alias("response"))
    for kind in ("request", "metadata"):
        part = F.struct("record_id", "target_uri", "date", F.col("payload").cast("string").alias("content"))
        one = read.where(F.col("type") == kind).groupBy(F.col("concurrent_to").alias("capture_id")).agg(F.min(part).alias(kind))
        parts = parts.join(one, "capture_id", "left")
    return parts


def page_captures(assembled: DataFrame) -> DataFrame:
    """The digest columns of each capture: page_id, payload_bytes, payload_digest, record_type, refers_to."""

    def field(name: str) -> Column:
        return F.regexp_extract("metadata.content", rf"(?m)^{name}: (-?\d+)", 1).try_cast("long")

    revisit = F.col("response.type") == "revisit"
    # Computed once, and so that the join below can split the revisits of one response over tasks.
    rows = durable(assembled.select(
        "capture_id",
        field("page-id").alias("page_id"),
        F.when(revisit, field("payload-length")).otherwise(F.col("response.payload_bytes")).alias("payload_bytes"),
        F.when(revisit, F.regexp_replace("response.payload_digest", "^sha1:", "")).otherwise(F.col("response.read_digest")).alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.when(revisit, F.col("response.refers_to")).otherwise(F.col("capture_id")).alias("_refers_to"),
    ))
    targets = rows.where("record_type = 'response'").groupBy(F.col("capture_id").alias("_refers_to")).agg(F.max("page_id").alias("_target"))
    refers_to = F.when(F.col("record_type") == "revisit", F.col("_target")).alias("refers_to")
    return rows.join(durable(targets), "_refers_to", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", refers_to)
