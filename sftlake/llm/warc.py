"""WARC archives: writing captures, reading records, assembling transactions.

A capture is three records: the response (or a revisit of an equal payload), its request and its metadata,
tied together by WARC-Concurrent-To. The writer composes whole records as columns and lets the text
writer put them into files; every record ends in CR LF CR LF, the last byte of which is the writer's line
end, so the files are plain WARC/1.1 (with ``compression="gzip"`` inside one gzip member per file). The reader takes whole files of
bounded size, since only Content-Length tells where a record ends.

Defined cases: a null payload is empty; equal page ids of one payload are all responses or all revisits; a
null id sorts lowest and can only be the response when all ids of the payload are null; a record whose partner is missing
gives a capture with that part null; an empty table gives no records.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRLF = "\r\n"
RECORD = (
    "record_type string, record_id string, concurrent_to array<string>, refers_to string, target_uri string, "
    "payload_digest string, headers map<string,string>, payload_bytes bigint, seen_digest string, block binary"
)


def base32_sha1(data: Column) -> Column:
    """Bare upper-case base32 SHA-1: 160 bits are 8 groups of 5 hexadecimal or 4 base32 digits."""
    digest = F.sha1(data)
    groups = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _record(headers: list[tuple[str, Column]], block: Column) -> Column:
    """A record without its last byte. Headers with a null value are left out."""
    lines = [F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)) for name, value in headers]
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF))
    return F.concat(F.lit(f"WARC/1.1{CRLF}"), F.concat_ws("", *lines), length, F.lit(CRLF), block, F.lit("\r\n\r"))


def captures(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, digest, first): ``first`` is the id of the page that a revisit refers to, else null."""
    rows = pages.select(
        F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", base32_sha1(F.col("html")))
    # Only payloads seen more than once are joined; most digests have one page and no partner.
    seen = (
        rows.where(F.octet_length("html") >= min_bytes).groupBy("digest")
        .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "last")
    )
    joined = rows.join(seen, "digest", "left")
    revisit = (
        F.col("last").isNotNull() & (F.octet_length("html") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("last"))
    )
    return joined.select("page_id", "url", "html", "digest", F.when(revisit, F.col("last")).alias("first"))


def _urn(kind: str, page: Column) -> Column:
    """A record id: the page and its payload, so that one id with two payloads is two captures."""
    return F.concat(F.lit(f"<urn:{kind}:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(":"), "digest", F.lit(">"))


def records(rows: DataFrame, date: str = "2020-01-01T00:00:00Z") -> DataFrame:
    """Three records per capture as text: (value). A revisit has no payload, only its digest."""
    page, first = F.col("page_id"), F.col("first")
    uri = F.coalesce(F.regexp_replace("url", r"[\r\n]", ""), F.lit("urn:unknown"))
    mine = _urn("capture", page)
    http = F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}{CRLF}")
    stamp, target = ("WARC-Date", F.lit(date)), ("WARC-Target-URI", uri)
    revisits = first.isNotNull()
    head = _record(
        [("WARC-Type", F.when(revisits, F.lit("revisit")).otherwise(F.lit("response"))), ("WARC-Record-ID", mine),
         stamp, target, ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
         ("WARC-Refers-To", F.when(revisits, _urn("capture", first))),
         ("WARC-Profile", F.when(revisits, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
         ("Content-Type", F.lit("application/http; msgtype=response"))],
        F.concat(http, F.when(revisits, F.lit("")).otherwise(F.col("html"))),
    )
    request = _record(
        [("WARC-Type", F.lit("request")), ("WARC-Record-ID", _urn("request", page)), stamp, target,
         ("WARC-Concurrent-To", mine), ("Content-Type", F.lit("application/http; msgtype=request"))],
        F.concat(F.lit("GET "), uri, F.lit(f" HTTP/1.1{CRLF}{CRLF}")),
    )
    metadata = _record(
        [("WARC-Type", F.lit("metadata")), ("WARC-Record-ID", _urn("metadata", page)), stamp, target,
         ("WARC-Concurrent-To", _urn("request", page)), ("Content-Type", F.lit("application/warc-fields"))],
        F.concat_ws("", F.concat(F.lit("page-id: "), page.cast("string"), F.lit(CRLF)), F.lit(f"fetched: {date}{CRLF}")),
    )
    return rows.select(F.explode(F.array(head, request, metadata)).alias("value"))


def write_warc(rows: DataFrame, path: str, compression: str = "gzip", records_per_file: int = 2000) -> None:
    """Archives of at most ``records_per_file`` records each, which also bounds what a reading task holds."""
    (
        records(rows).write.option("lineSep", "\n").option("compression", compression)
        .option("maxRecordsPerFile", records_per_file).text(path)
    )


def _parse(data: bytes) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """Header fields and block of each record, by Content-Length."""
    at = 0
    while at < len(data):
        if data[at : at + 5] != b"WARC/":
            raise ValueError(f"no WARC record at byte {at}")
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "replace").split(CRLF)[1:]
        fields = [(k.strip().lower(), v.strip()) for k, _, v in (line.partition(":") for line in lines)]
        start = end + 4
        stop = start + int(dict(fields)["content-length"])
        yield fields, data[start:stop]
        at = stop + 4


def _read(keep_blocks: bool):
    import base64
    import hashlib

    def row(fields: list[tuple[str, str]], block: bytes) -> dict:
        head = dict(fields)
        payload = block.partition(b"\r\n\r\n")[2] if head.get("content-type", "").startswith("application/http") else block
        return {
            "record_type": head.get("warc-type"), "record_id": head.get("warc-record-id"),
            "concurrent_to": [v for k, v in fields if k == "warc-concurrent-to"], "refers_to": head.get("warc-refers-to"),
            "target_uri": head.get("warc-target-uri"), "payload_digest": head.get("warc-payload-digest"),
            "headers": list(head.items()), "payload_bytes": len(payload),
            "seen_digest": base64.b32encode(hashlib.sha1(payload).digest()).decode(), "block": block if keep_blocks else None,
        }

    schema = pa.schema([
        ("record_type", pa.string()), ("record_id", pa.string()), ("concurrent_to", pa.list_(pa.string())),
        ("refers_to", pa.string()), ("target_uri", pa.string()), ("payload_digest", pa.string()),
        ("headers", pa.map_(pa.string(), pa.string())), ("payload_bytes", pa.int64()), ("seen_digest", pa.string()),
        ("block", pa.binary()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                data = content.as_py()
                if data[:2] == b"\x1f\x8b":
                    out, rest = [], data
                    while rest:  # one member per file, or one per record
                        member = zlib.decompressobj(31)
                        out.append(member.decompress(rest))
                        rest = member.unused_data
                    data = b"".join(out)
                rows: list[dict] = []
                for fields, block in _parse(data):
                    rows.append(row(fields, block))
                    if len(rows) == 256:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def read_warc(spark: SparkSession, path: str, keep_blocks: bool = True) -> DataFrame:
    """One row per record of all archives below ``path``; the digest is taken from the bytes read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    return files.mapInArrow(_read(keep_blocks), RECORD)


def assemble(recs: DataFrame) -> DataFrame:
    """One nested row per capture: (capture_id, response, request, metadata, others).

    ``request`` and ``metadata`` are the capture's first by record id; ``others`` holds all further ones, requests first, by record id.

    A request names its response, or a response its request; metadata names either of them. Every link
    is an equi-join on record ids, so a capture's records meet wherever they were stored. Each response
    or revisit record gives a row; requests and metadata without one give a row of their own.
    """
    parts = F.struct(*(c for c in recs.columns if c != "concurrent_to")).alias("rec")
    is_head = F.col("record_type").isin("response", "revisit", "resource")
    heads = recs.where(is_head).select(F.col("record_id").alias("capture_id"), parts)
    # Request -> response, in whichever of the two the link was written.
    named = (
        recs.where(is_head).select(F.explode("concurrent_to").alias("req_id"), F.col("record_id").alias("named"))
        .distinct()
    )
    linked = recs.select("record_type", "record_id", F.explode_outer("concurrent_to").alias("other"), parts)
    asked = linked.where("record_type = 'request'")
    requests = asked.join(named, asked["record_id"] == named["req_id"], "left").select(
        F.coalesce("named", "other", "record_id").alias("capture_id"), "record_id", "rec"
    )
    by_request = requests.select(F.col("record_id").alias("req_id"), F.col("capture_id").alias("via")).distinct()
    notes = linked.where("record_type = 'metadata'")
    noted = notes.join(by_request, notes["other"] == by_request["req_id"], "left").select(
        F.coalesce("via", "other", "record_id").alias("capture_id"), "rec"
    )
    kind = heads.schema["rec"].dataType
    null = F.lit(None).cast(kind)

    def by_id(records: Column) -> Column:
        key = lambda r: F.coalesce(r["record_id"], F.lit(""))
        return F.array_sort(records, lambda x, y: F.when(key(x) < key(y), -1).when(key(x) > key(y), 1).otherwise(0))

    sides = (
        requests.select("capture_id", F.col("rec").alias("request"), null.alias("metadata"))
        .unionByName(noted.select("capture_id", null.alias("request"), F.col("rec").alias("metadata")))
        .groupBy("capture_id")
        .agg(*(by_id(F.collect_list(part)).alias(f"_{part}") for part in ("request", "metadata")))
        .select(
            "capture_id", *(F.get(f"_{part}", F.lit(0)).alias(part) for part in ("request", "metadata")),
            F.concat(*(F.slice(f"_{part}", 2, F.greatest(F.size(f"_{part}"), F.lit(1))) for part in ("request", "metadata"))).alias("others"),
        )
    )
    joined = heads.withColumnRenamed("rec", "response").join(sides, "capture_id", "full_outer")
    return joined.withColumn("others", F.coalesce("others", F.array().cast(joined.schema["others"].dataType)))


def resolved(found: DataFrame) -> DataFrame:
    """Add ``payload_bytes`` and ``payload_digest`` of the full payload: a revisit takes those of the
    response that it refers to. The join is on record ids; many revisits of one response are split by
    adaptive execution."""
    response = F.col("response")
    # Responses look themselves up, so that they spread by their own ids instead of meeting under one null.
    plain = found.select("*", F.coalesce(response["refers_to"], response["record_id"], "capture_id").alias("_to"))
    base = found.where(response["refers_to"].isNull()).groupBy(response["record_id"].alias("_base")).agg(
        F.first(response["payload_bytes"]).alias("payload_bytes"), F.first(response["seen_digest"]).alias("payload_digest")
    )
    return plain.join(base, plain["_to"] == base["_base"], "left").drop("_to", "_base")
