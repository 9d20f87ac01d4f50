"""WARC round trips and transaction assembly."""

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from sftlake.llm import warc

PAGES = [
    (1, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (3, None, "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"), (4, "http://a/4", None),
    (5, "http://a/5", ""), (6, "http://\r\nb", "é你\n" * 2000), (6, "http://c", "other payload"), (7, "u", "twice"), (7, "u", "twice"), (None, "v", "<p>same</p>"),
]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_round_trip(spark, tmp_path, compression):
    path = str(tmp_path / "warc")
    df = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id bigint, url string, html string, digest string")
    warc.write_warc(warc.captures(df), path, compression=compression, records_per_file=4)
    recs = warc.read_warc(spark, path)
    assert recs.count() == 3 * len(PAGES)
    got = warc.resolved(warc.assemble(recs))
    assert got.where("request is null or metadata is null or response is null").count() == 0
    rows = sorted(
        (r.payload_bytes, r.payload_digest, r.response.record_type, r.response.refers_to is not None) for r in got.collect()
    )
    last = {}
    for i, _, h in PAGES:
        last[h or ""] = max(last.get(h or "", -1), -1 if i is None else i)
    want = sorted(
        (len((h or "").encode()), digest(h), "response" if i == last[h or ""] else "revisit", i != last[h or ""]) for i, _, h in PAGES
    )
    assert rows == want
    blocks = {r.record_id: bytes(r.block) for r in recs.where("record_type = 'response'").collect()}
    assert any(b.endswith(("é你\n" * 2000).encode()) for b in blocks.values())


def test_links_in_either_direction_and_orphans(spark):
    rows = [
        ("response", "r1", ["q1"]), ("request", "q1", []), ("metadata", "m1", ["q1"]), ("response", "r2", []), ("request", "q2", ["r2"]),
        ("metadata", "m2", ["r2"]), ("request", "q3", ["gone"]), ("metadata", "m4", []), ("warcinfo", "w", []),
    ]
    df = spark.createDataFrame(rows, "record_type string, record_id string, concurrent_to array<string>")
    got = {r.capture_id: tuple(x and x.record_id for x in (r.response, r.request, r.metadata)) for r in warc.assemble(df).collect()}
    assert got == {"r1": ("r1", "q1", "m1"), "r2": ("r2", "q2", "m2"), "gone": (None, "q3", None), "m4": (None, None, "m4")}


def test_smallest_payload_size_and_empty_table(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    assert warc.captures(df, min_bytes=12).where("first is not null").count() == 0
    assert warc.captures(df, min_bytes=11).where("first is not null").count() == 2
    path = str(tmp_path / "none")
    warc.write_warc(warc.captures(df.where("false")), path)
    assert warc.assemble(warc.read_warc(spark, path)).count() == 0
    sha = df.select(F.coalesce("html", F.lit("")).alias("h"), warc.base32_sha1(F.coalesce("html", F.lit(""))).alias("d"))
    assert all(r.d == digest(r.h) for r in sha.collect())


def test_no_record_of_a_capture_is_lost(spark):
    rows = [
        ("response", "r1", []), ("metadata", "m2", ["r1"]), ("metadata", "m1", ["r1"]), ("metadata", "m3", ["q1"]), ("request", "q2", ["r1"]),
        ("request", "q1", ["r1"]), ("response", "r2", []), ("metadata", "m9", ["lost"]), ("metadata", "m8", ["lost"]),
    ]
    schema = "record_type string, record_id string, concurrent_to array<string>, headers map<string,string>"
    df = spark.createDataFrame([(*r, {"n": r[1]}) for r in rows], schema)
    got = {r.capture_id: r for r in warc.assemble(df.repartition(5)).collect()}
    first = got["r1"]
    assert (first.request.record_id, first.metadata.record_id, [o.record_id for o in first.others]) == ("q1", "m1", ["q2", "m2", "m3"])
    assert got["r2"].others == [] and got["r2"].request is None
    assert (got["lost"].response, got["lost"].metadata.record_id, [o.headers["n"] for o in got["lost"].others]) == (None, "m8", ["m9"])
