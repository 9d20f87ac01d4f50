"""The pipeline's stages, each on its own input, and the whole run."""

import re

import corpus_pipeline as cp
import numpy as np
import pytest
from pyspark.sql import functions as F

from sftlake.llm.common import stored, table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), {}
    out["documents"] = docs
    for name, stage in cp.STAGES:
        docs = out[name] = stored(stage(spark, docs, SF), name)
    return out


def test_columns_and_order(stages):
    assert [n for n, _ in cp.STAGES] == ["quality", "near_dedup", "decontaminate", "mix", "tokens"]
    for name, _ in cp.STAGES[:-1]:
        assert stages[name].columns == stages["documents"].columns
    assert stages["tokens"].columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_quality_keeps_good_documents(spark, stages):
    labels = table(spark, SF, "labels").select("doc_id", "quality")
    kept = stages["quality"].select("doc_id", F.lit(1).alias("k"))
    rows = labels.join(kept, "doc_id", "left").select("quality", F.coalesce("k", F.lit(0)).alias("k")).collect()
    assert np.mean([r.k for r in rows if r.quality == 1]) > 0.97 and np.mean([r.k for r in rows if r.quality == 0]) < 0.1


def test_near_dedup_equals_brute_force(stages):
    before = {r.doc_id: r.text for r in stages["quality"].collect()}
    sets = {}
    for i, t in before.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = frozenset(hash(tuple(w[j : j + 5])) for j in range(max(1, len(w) - 4))) if w else frozenset()
    root = {i: i for i in before}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(before)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            a, b = sets[i], sets[j]
            if a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)) and 5 * len(a & b) >= 4 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    assert sorted(r.doc_id for r in stages["near_dedup"].collect()) == [i for i in ids if find(i) == i]


def test_decontamination_equals_search(spark, stages):
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    norm = lambda t: word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = set()
    for r in table(spark, SF, "benchmark").collect():
        w = norm(r.text)
        windows |= {" ".join(w[i : i + 10]) for i in range(max(1, len(w) - 9))} - {""}
    clean = []
    for r in stages["near_dedup"].collect():
        text = f" {' '.join(norm(r.text))} "
        if not any(f" {w} " in text for w in windows):
            clean.append(r.doc_id)
    assert sorted(clean) == sorted(r.doc_id for r in stages["decontaminate"].collect())


def test_mix_and_tokens(stages):
    mixed, tokens = stages["mix"], stages["tokens"]
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    assert mixed.join(stages["decontaminate"], "doc_id", "left_anti").count() == 0
    rows = sorted((r.start, r.n_tokens, r.doc_id) for r in tokens.collect())
    assert len(rows) == mixed.count() and sorted(r[2] for r in rows) == [r[2] for r in rows]
    assert [r[0] for r in rows] == np.concatenate(([0], np.cumsum([r[1] for r in rows])[:-1])).tolist()


def test_workers_keep_no_pieces_of_the_token_files(spark):
    def held(batches):
        import pyarrow as pa
        from sftlake.llm import bpe

        for _ in batches:
            sizes = [len(e.known.place) + len(e.older.place) for e in bpe._LOADED.values()]
            yield pa.RecordBatch.from_arrays([pa.array([len(sizes)]), pa.array([sum(sizes)])], names=["encoders", "pieces"])

    cp.write_token_files(spark, table(spark, "/root/testdata/sf0.001", "documents"), SF)
    workers = spark.range(0, 64, 1, 16).mapInArrow(held, "encoders bigint, pieces bigint").collect()
    assert any(r.encoders for r in workers) and not any(r.pieces for r in workers)


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(map(tuple, cp.run(spark, SF).collect())) == sorted(map(tuple, stages["tokens"].collect()))


def test_nulls_and_empty_tables(spark):
    docs = spark.createDataFrame(
        [(1, None, None, None, None), (None, "a b c", "en", None, 5), (None, "a b c", "en", None, 5), (2, "a b c d e f", None, "s", 3), (2, "a b c d e f", None, "s", 3), (3, "", "en", "s", 0)],
        table(spark, SF, "documents").schema,
    )
    for name, stage in cp.STAGES:
        got = stored(stage(spark, docs, SF), name)
        none = stored(stage(spark, docs.where("false"), SF), name)
        assert none.count() == 0
        if name == "near_dedup":
            # Rows without an id stay; of the two equal rows of id 2 one does.
            assert sorted(str(r.doc_id) for r in got.collect()) == ["1", "2", "3", "None", "None"]


CLASHING = ["_size", "_rest", "_k", "_score", "_copy", "_id", "_row", "_hits", "item_ids", "component_id"]


def test_stages_keep_columns_of_their_own_names(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    wide = docs.select("*", *(F.concat(F.lit(f"{c} "), "doc_id").alias(c) for c in CLASHING))
    for name, stage in cp.STAGES[:-1]:
        plain = stage(spark, docs, "/root/testdata/sf0.001").select("doc_id")
        got = stage(spark, wide, "/root/testdata/sf0.001")
        assert got.columns == wide.columns, name
        rows = got.collect()
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in plain.collect()), name
        assert all(r[c] == f"{c} {r.doc_id}" for r in rows for c in CLASHING), name


def test_an_id_is_one_document(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(1, text), (1, "something else entirely in these words " * 3), (2, text), (3, "own words of the third document " * 4), (None, text), (None, text)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = cp.keep_distinct(spark, docs, SF).collect()
    assert sorted((r.doc_id for r in kept), key=str) == [1, 3, None, None]
