"""Epochs as permutations, workers and steps as arithmetic; sketches; layouts; radix selection; quota in the stream."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from sftlake.functions import layouts as la
from sftlake.operators import curate as cu
from sftlake.operators import epochs as ep
from sftlake.operators import examples as ex
from sftlake.operators import sketches as sk
from sftlake.operators import split as sp
from sftlake.sources.io import RAW_SCHEMA
from sftlake.streaming import quota as qu


# -- epochs ----------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 7, 10, 97, 1000])
def test_every_epoch_is_a_bijection(spark, n):
    df = spark.range(n).select("id", F.lit(n).cast("bigint").alias("n"), F.explode(F.sequence(F.lit(0), F.lit(4))).alias("epoch"))
    places = df.select("id", "epoch", ep.permuted(F.col("id"), F.col("n"), F.col("epoch"), 42).alias("p")).collect()
    by = {}
    for r in places:
        by.setdefault(r.epoch, {})[r.id] = r.p
    assert all(sorted(own.values()) == list(range(n)) for own in by.values()) and len(by) == 5
    if n == 1000:
        orders = [tuple(own[i] for i in range(n)) for own in by.values()]
        assert len(set(orders)) == 5
        # No place remembers its number: correlation of number and place, and share of neighbours that stay neighbours.
        for order in orders:
            mean = (n - 1) / 2
            r = sum((i - mean) * (p - mean) for i, p in enumerate(order)) / (n * (n * n - 1) / 12)
            assert abs(r) < 0.12 and sum(abs(a - b) == 1 for a, b in zip(order, order[1:])) < 15


def test_workers_are_disjoint_and_even(spark):
    numbered = ep.numbered_rows(spark.range(103).select((F.col("id") * 3).alias("ord")), "ord")
    got = ep.epoch_batches(numbered, 3, 4, workers=3, first_epoch=5).collect()
    plan_ = ex.step_plan(spark.range(103).select(F.lit("t").alias("split")), 4, 3, 1, 1).first()
    for epoch in (5, 6, 7):
        own = [r for r in got if r.epoch == epoch]
        assert len({r.ord for r in own}) == len(own) == plan_.batches * 3 * 4
        for rank in range(3):
            steps = {}
            for r in own:
                if r.rank == rank:
                    steps.setdefault(r.step, []).append(r.pos_in_batch)
            assert sorted(steps) == list(range(plan_.batches)) and all(sorted(p) == [0, 1, 2, 3] for p in steps.values())
    alone = ep.epoch_batches(numbered, 1, 4).collect()
    assert len(alone) == 103 and max(r.step for r in alone) == 25 and {r.rank for r in alone} == {0}


def test_a_further_epoch_shuffles_nothing(spark, tmp_path):
    ep.numbered_rows(spark.range(50).select(F.col("id").alias("ord")), "ord").write.parquet(str(tmp_path / "n"))
    assert "Exchange" not in plan(ep.epoch_batches(spark.read.parquet(str(tmp_path / "n")), 9, 4, 2))
    assert ep.epoch_batches(spark.range(0).selectExpr("id ord", "id _rn", "id _total"), 2, 4).count() == 0


# -- sketches --------------------------------------------------------------------------


def test_rank_error_is_below_one_point(spark):
    rng = random.Random(7)
    data = [(s, rng.choice([rng.randint(0, 50), int(rng.lognormvariate(6, 2))])) for s in range(12) for _ in range(rng.randint(1, 900))]
    df = spark.createDataFrame(data + [(3, None)], "slice int, x bigint")
    for points in (10, 100):
        sketches = sk.sketch_lengths(df, "x", ["slice"], points)
        assert sketches.groupBy("slice").count().agg(F.max("count")).first()[0] <= points
        assert sketches.agg(F.sum("weight")).first()[0] == len(data)
        values = sorted(x for _, x in data)
        quantiles = [i / 20 for i in range(1, 20)]
        got = sk.sketch_quantiles(sketches, quantiles).first()
        for q in quantiles:
            v = got[f"q{round(100 * q)}"]
            below, upto = sum(x < v for x in values), sum(x <= v for x in values)
            assert below - len(values) / points <= q * len(values) <= upto + len(values) / points
        again = sk.merge_sketches(sketches, (), points)
        assert again.count() <= points and again.agg(F.sum("weight")).first()[0] == len(data)


def test_approximate_stats(spark):
    df = spark.range(1000).selectExpr("id % 2 side", "id x")
    got = sk.approximate_stats(df, "x", points=100).first()
    assert (got.rows, got.min, got.max) == (1000, 0, 999) and abs(got.q50 - 500) <= 10 and abs(got.q99 - 990) <= 10
    assert [(r.side, r.rows, r.min, r.max) for r in sk.approximate_stats(df, "x", ["side"]).orderBy("side").collect()] == [(0, 500, 0, 998), (1, 500, 1, 999)]


def test_slices_are_appended(spark, tmp_path):
    df = spark.range(1000).selectExpr("id % 5 day", "id % 3 source", "id * 7 % 101 x")
    path = str(tmp_path / "s")
    for day in range(5):
        sk.append_sketches(sk.sketch_lengths(df.where(f"day = {day}"), "x", ["source", "day"], 200), path, "day")
    got = sk.sketch_quantiles(sk.read_sketches(spark, path), (0.5,), ["source"]).orderBy("source")
    exact = df.groupBy("source").agg(F.count("*").alias("rows"), F.expr("percentile_disc(0.5) within group (order by x)").cast("bigint").alias("q50")).orderBy("source")
    assert rows(got) == rows(exact)  # as many points as values: exact


# -- layouts ---------------------------------------------------------------------------

TALK = [("system", " Be brief. "), ("user", "Hi\n"), ("assistant", "Hello."), ("user", None)]
GOLDEN = {
    "chatml": "<|im_start|>system\n Be brief. <|im_end|>\n<|im_start|>user\nHi\n<|im_end|>\n<|im_start|>assistant\nHello.<|im_end|>\n<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\n",
    "headers": "<|begin_of_text|><|start_header_id|>system<|end_header_id|>\n\nBe brief.<|eot_id|><|start_header_id|>user<|end_header_id|>\n\nHi<|eot_id|>"
    "<|start_header_id|>assistant<|end_header_id|>\n\nHello.<|eot_id|><|start_header_id|>user<|end_header_id|>\n\n<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n",
    "inst": "<s>[INST] <<SYS>>\nBe brief.\n<</SYS>>\n\nHi [/INST] Hello. </s>[INST]  [/INST]",
    "model_turns": "<bos><start_of_turn>user\nBe brief.\n\nHi<end_of_turn>\n<start_of_turn>model\nHello.<end_of_turn>\n<start_of_turn>user\n<end_of_turn>\n<start_of_turn>model\n",
}


def test_golden_texts(spark):
    df = spark.createDataFrame([(TALK,), (TALK[1:2],), ([],)], "m array<struct<role:string,content:string>>")
    got = [tuple(r) for r in df.select(*(l.render(F.col("m")).alias(n) for n, l in la.LAYOUTS.items())).collect()]
    assert dict(zip(la.LAYOUTS, got[0])) == GOLDEN
    assert got[1][2:] == ("<s>[INST] Hi [/INST]", "<bos><start_of_turn>user\nHi<end_of_turn>\n<start_of_turn>model\n")
    assert got[2] == ("<|im_start|>assistant\n", "<|begin_of_text|><|start_header_id|>assistant<|end_header_id|>\n\n", "<s>", "<bos><start_of_turn>model\n")


def test_a_layout_says_what_it_does_not_know(spark):
    for turns in ({"user": "{text}"}, {"user": "{content!r}"}, {"user": "{content:>9}"}, {"user": "{}"}):
        with pytest.raises(ValueError, match="layout knows"):
            la.ChatLayout(turns=turns, opening="")
    with pytest.raises(ValueError, match="folds"):
        la.ChatLayout(turns={"system": "{content}"}, opening="", folded="{system}{content}")
    df = spark.createDataFrame([([("user", "a"), ("tool", "b")],), ([("user", "a"), ("system", "late")],)], "m array<struct<role:string,content:string>>")
    for layout in (la.INST, la.MODEL_TURNS):
        for row in (0, 1):
            with pytest.raises(Exception, match="no role"):
                spark.createDataFrame([df.collect()[row]], df.schema).select(layout.render(F.col("m"))).collect()


def test_examples_in_another_layout(spark):
    df = spark.createDataFrame([(1, "Q", "A")], "ord bigint, prompt string, response string")
    text = ex.example_text(df, "S", "</s>", la.INST).first()
    assert text.full_text == "<s>[INST] <<SYS>>\nS\n<</SYS>>\n\nQ [/INST]A</s>"
    assert ex.example_text(df, "S").first().rendered == ex.example_text(df, "S", layout=la.CHATML).first().rendered


# -- radix selection -------------------------------------------------------------------


def test_a_prefix_with_many_prompts_is_cut_deeper(spark, monkeypatch):
    """Digests that share their first digits: no window holds more than the bound."""
    prompts = [f"p{i}" for i in range(60)] + ["hot"] * 40
    df = spark.createDataFrame(list(enumerate(prompts)), "i int, prompt string")
    want = {frac: rows(sp.group_split(df, val_frac=frac).orderBy("i")) for frac in (0.1, 0.5, 0.9)}
    plain = sp.digest
    monkeypatch.setattr(sp, "digest", lambda value, seed: F.concat(F.lit("0" * 9), F.substring(plain(value, seed), 1, 23)))
    sizes, edge = [], sp._edge
    monkeypatch.setattr(sp, "_edge", lambda counts, missing: (lambda e: (sizes.append(e[2]), e)[1])(edge(counts, missing)))
    for frac, split in want.items():
        sizes.clear()
        monkeypatch.setattr(sp, "MOST_IN_ORDER", 3)
        assert rows(sp.group_split(df, val_frac=frac).orderBy("i")) == split
        assert len(sizes) >= 3  # three levels at least, the first two of which hold everything


# -- quota in the stream ---------------------------------------------------------------


def raw(spark, start, n):
    return spark.range(start, start + n).selectExpr(
        "id ord", "concat('p', id) input", "concat('text of ', id) output", "if(id % 3 = 0, '', 'x = 1') solution", "'L1' difficulty", "'s' source"
    ).select(*(f.split()[0] for f in RAW_SCHEMA.split(", ")))


def test_exactly_the_quota_over_triggers_and_restarts(spark, tmp_path):
    path, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))

    def run(n):
        qu.curate_stream_quota(spark, path, out, state, n, 1, 500, files_per_batch=1, counters_dir=str(tmp_path / "c")).awaitTermination()
        return sorted(r.ord for r in qu.read_kept(spark, out).collect())

    everything = []
    for i in range(3):
        raw(spark, i * 10, 10).coalesce(1).write.mode("append").parquet(path)
        everything += [x for x in range(i * 10, i * 10 + 10) if x % 3]
        assert run(15) == everything[:15]
    assert qu.kept_so_far(spark, out) == 15
    raw(spark, 100, 10).coalesce(1).write.mode("append").parquet(path)
    assert run(15) == everything[:15]  # filled: later files are passed over
    counters = spark.read.parquet(str(tmp_path / "c")).agg(F.sum("checked"), F.sum("kept"), F.sum("skipped_no_solution")).first()
    assert tuple(counters) == (23, 15, 8)


def test_a_batch_that_is_repeated_writes_the_same(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    raw(spark, 0, 20).coalesce(1).write.parquet(path)
    for state in ("a", "b"):  # the log of the first run is lost: batch 0 comes again
        qu.curate_stream_quota(spark, path, out, str(tmp_path / state), 5, 1, 500).awaitTermination()
        assert sorted(r.ord for r in qu.read_kept(spark, out).collect()) == [1, 2, 4, 5, 7]
    assert cu.curate_quota(raw(spark, 0, 20), 5, 1, 500).count() == 5
    with pytest.raises(ValueError):
        qu.curate_stream_quota(spark, path, out, str(tmp_path / "c"), 0, 1, 500)
