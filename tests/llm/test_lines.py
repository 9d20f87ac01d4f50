"""Line dedup against brute force."""

import hashlib
import random

import pytest

from sftlake.llm import lines

SPACE = " \t\n\v\f\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows, min_docs, keep):
    docs = [(t or "").split("\n") for _, t in rows]
    order = sorted(range(len(rows)), key=lambda r: (rows[r][0] is not None, rows[r][0] or 0))
    seen, first = {}, {}
    for r in order:
        for p, line in enumerate(docs[r]):
            if key(line):
                seen.setdefault(key(line), set()).add(r)
                first.setdefault(key(line), (r, p))
    out = []
    for r, own in enumerate(docs):
        gone = [len(seen.get(key(x), ())) >= min_docs and not (keep == "first" and first[key(x)] == (r, p)) for p, x in enumerate(own)]
        kept = "\n".join(x for x, g in zip(own, gone) if not g)
        out.append((rows[r][0], len(own), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def applied(spark, df, **options):
    lost = lines.line_bitmaps_of_losers(df, **options)
    from pyspark.sql import functions as F

    same = df["doc_id"].eqNullSafe(lost["doc"]) & (F.xxhash64(df["text"]) == lost["text_hash"])
    got = df.join(lost, same, "left").select("doc_id", lines.applied_digest("text", "bitmap").alias("d")).select("doc_id", "d.*")
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize("min_docs, keep", [(10, "none"), (2, "first"), (3, "none")])
def test_equals_brute_force(spark, min_docs, keep):
    rng = random.Random(min_docs)
    pool = [f"Line number {i}" for i in range(30)] + ["", "  ", "\tCommon LINE ", "common line", "Été", "été"]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 12)))) for i in range(80)]
    rows += [(500, None), (501, ""), (502, "\n"), (503, "common line\n" * 300), (504, "only here\nonly here")]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id bigint, text string, pos int")
    assert applied(spark, df, min_docs=min_docs, keep=keep) == brute(rows, min_docs, keep)


def test_bitmaps_null_ids_and_repeated_rows(spark):
    rows = [(1, "a\nb"), (1, "a\nb"), (None, "a\nc"), (2, "x\na\nx")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = lines.line_bitmaps(df, min_docs=2, keep="none").collect()
    bits = {(r.doc_id, r.n_lines): lines.bitmap_bits(r.bitmap, r.n_lines).tolist() for r in got}
    # Equal rows are one document: b is in one document only.
    assert bits == {(1, 2): [False, True], (None, 2): [False, True], (2, 3): [True, False, True]} and len(got) == 4
    assert lines.line_bitmaps(df.where("false")).count() == 0


def test_hot_key_spreads_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(4000).selectExpr("id doc_id", "concat('hot line\nown ', id) text")
        rows = lines.line_rows(df, "doc_id", "text", 1).repartitionByRange(8, "h1", "h2", "doc", "uid")
        sizes = rows.rdd.glom().map(len).collect()
        assert max(sizes) < 2 * sum(sizes) / len(sizes)
        got = lines.line_bitmaps(df, min_docs=10, keep="first").agg({"n_dropped": "sum"}).first()[0]
        assert got == 3999
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
