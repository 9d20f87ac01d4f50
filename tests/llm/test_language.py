"""Nearest centroids: held-out accuracy, rejection, defined cases."""

import numpy as np
from pyspark.sql import functions as F

from sftlake.llm import language as lg
from sftlake.llm.common import crc_remainder, table


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    held = crc_remainder(F.col("doc_id"), 4) == 2
    model = lg.train(docs, usable=~held)
    got = lg.identify(docs.where(held), model, reject=False).select("lang", "lang_pred", "lang_score", "rejected").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.98
    assert all(0 <= r.lang_score <= 1 for r in got) and np.mean([r.rejected for r in got]) < 0.05


def test_several_centroids_and_rejection():
    near = ["the cat and the dog went to the house " * 3 + str(i) for i in range(30)] + ["colour of autumn leaves falls slowly " * 3] * 30
    far = ["der hund und die katze gehen nach hause " * 3 + str(i) for i in range(40)]
    model = lg.fit({"en": lg.trigram_counts(near), "de": lg.trigram_counts(far)}, k=2)
    assert len(model.centres) == 4 and np.allclose((model.centres**2).sum(axis=1), 1, atol=1e-5)
    names, score, rejected = model.classify(["the dog and the cat", "die katze und der hund", "zzqx vvkw " * 20, "autumn leaves"])
    assert names[:2] == ["en", "de"] and names[3] == "en" and rejected[2] and score[2] < score[:2].min()


def test_defined_cases(spark):
    rows = [(1, "some english words here", "en", "a"), (2, None, "en", "b"), (3, "123 456 !!", None, "c"), (4, "", "en", "d"), (None, "einige deutsche worte", "de", "e"), (1, "some english words here", "en", "a"), (7, "SOME ENGLISH WORDS", None, "f")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, lang_pred string")
    got = lg.identify(df, lg.train(df, usable=F.lit(True)), reject=False)
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "lang_score", "rejected"]
    assert [r.lang_pred for r in got.collect()] == ["en", "und", "und", "und", "de", "en", "en"]
    assert {r.lang_pred for r in lg.identify(df, lg.train(df.where("false"))).collect()} == {"und"}
    assert lg.identify(df.where("false"), lg.train(df)).count() == 0


def brute_vector(text, idf):
    """Square roots of hashed byte-trigram counts times IDF, at length one, as a dictionary."""
    letters = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in (text or "").lower().encode())
    raw = b" " + b" ".join(letters.split()) + b" "
    counts = {}
    for i in range(len(raw) - 2):
        gram = raw[i] << 16 | raw[i + 1] << 8 | raw[i + 2]
        slot = (gram * 0x9E3779B1 & 0xFFFFFFFF) >> 19
        counts[slot] = counts.get(slot, 0) + 1
    vector = {s: n**0.5 * idf[s] for s, n in counts.items()}
    norm = sum(x * x for x in vector.values()) ** 0.5
    return {s: x / norm for s, x in vector.items()} if norm else {}


def test_equals_a_dictionary_version(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").where("doc_id < 400")
    model = lg.train(docs)
    counts = lg.trigram_counts([r.text for r in docs.where("lang is not null").collect()])
    assert np.allclose(model.idf, np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1, atol=1e-5)
    rows = lg.identify(docs, model, reject=False).collect()
    assert len(rows) > 300
    for r in rows:
        v = brute_vector(r.text, model.idf)
        cosine = [sum(x * float(c[s]) for s, x in v.items()) for c in model.centres]
        best = max(range(len(cosine)), key=lambda i: cosine[i])
        assert abs(r.lang_score - cosine[best]) < 1e-4
        near = {model.names[model.owner[i]] for i, c in enumerate(cosine) if cosine[best] - c < 1e-5}
        assert r.lang_pred in near


def test_a_language_with_all_rows_is_no_hot_key(spark):
    rows = spark.range(60_000).selectExpr("id _id", "if(id % 20 = 0, 'b', 'a') _lang")
    got = lg._picked(rows, 100, 1)
    order = F.xxhash64(F.lit(1), "_id")
    for name in "ab":
        want = [r._id for r in rows.where(F.col("_lang") == name).orderBy(order).limit(100).collect()]
        assert sorted(r._id for r in got.where(F.col("_lang") == name).collect()) == sorted(want)
    assert lg._picked(rows.where("_id < 50"), 100, 1).count() == 50


def test_query_contract(spark):
    from sftlake.llm import queries

    df = queries.op6_language(spark, "/root/testdata/sf0.001")
    assert df.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    import zlib

    rows = df.collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
