"""Factorisation machine: the linear-time identity, held-out accuracy, defined cases."""

import numpy as np
from pyspark.sql import functions as F

from sftlake.llm import quality as q
from sftlake.llm.common import crc_remainder, table


def test_pairwise_identity():
    f = q.Features(["alpha beta gamma alpha", "", None, "x " * 50], [None, 3, None, 7])
    rng = np.random.default_rng(0)
    m = q.Machine(np.zeros(q.STATS), np.ones(q.STATS), 0.5)
    m.v, m.w = rng.normal(0, 1, m.v.shape), rng.normal(0, 1, m.w.shape)
    m.sv, m.sw, m.w0 = rng.normal(0, 1, m.sv.shape), rng.normal(0, 1, m.sw.shape), 0.3
    dense = m.standard(f.dense)
    margin, _ = m.parts(4, f.rows, f.slots, f.values, dense)
    for row in range(4):
        at = f.rows == row
        x = np.concatenate([f.values[at], dense[row]])
        w = np.concatenate([m.w[f.slots[at]], m.sw])
        v = np.concatenate([m.v[f.slots[at]], m.sv])
        pairs = sum(v[i] @ v[j] * x[i] * x[j] for i in range(len(x)) for j in range(i))
        assert abs(margin[row] - (m.w0 + w @ x + pairs)) < 1e-8 * max(1, abs(pairs))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    held = crc_remainder(F.col("doc_id"), 3) == 1
    scored = q.score(docs, q.train(docs, labels, usable=~held))
    rows = scored.where(held).join(labels, "doc_id").select((F.col("score") >= 0.5).cast("int").alias("p"), "quality").collect()
    good, bad = [r.p for r in rows if r.quality == 1], [r.p for r in rows if r.quality == 0]
    assert len(bad) > 50 and np.mean(good) > 0.98 and np.mean(bad) < 0.05


def test_defined_cases(spark):
    rows = [(1, "Plain words in a line.", 5, 0.1), (2, None, None, 0.2), (3, "", 0, 0.3), (None, "!!! $$$", 7, 0.4), (1, "Plain words in a line.", 5, 0.5), (5, "word " * 20000, -1, 0.6)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint, score double")
    none = spark.createDataFrame([(1, None, 0), (None, 1, 0), (77, 0, 0)], "doc_id bigint, quality int, toxic int")
    got = q.score(df, q.train(df, none))
    assert got.columns == ["doc_id", "text", "n_chars", "score"] and [r.score for r in got.collect()] == [1.0] * 6
    some = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (3, 0, 1), (5, 0, 0), (5, 1, 0), (5, 1, 0)], "doc_id bigint, quality int, toxic int")
    score = [r.score for r in q.score(df, q.train(df, some)).collect()]
    assert all(0 <= s <= 1 for s in score) and score[0] == score[4] > 0.5 > score[2]
    assert q.score(df.where("false"), q.train(df, some)).count() == 0
    assert q.train(df, some, sample=1).constant


def test_query_contract(spark):
    import zlib

    from sftlake.llm import queries

    sf = "/root/testdata/sf0.001"
    df = queries.op3_quality(spark, sf)
    assert df.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = df.collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in table(spark, sf, "documents").collect())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) for r in rows)
