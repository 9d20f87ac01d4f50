"""Logits in blocks of classes against whole rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan
from sftlake.functions import scoring as sc
from sftlake.operators import losses as lo
from sftlake.operators import sharded as sh

INF = float("inf")


def close(a, b):
    return a == b or (a is not None and b is not None and (math.isnan(a) and math.isnan(b) or a == pytest.approx(b, rel=1e-9, abs=1e-9)))


def whole(spark):
    rng = random.Random(4)
    rows = []
    for seq in range(6):
        for pos in range(7):
            scale = rng.choice([1, 10, 300, 2000])  # several pivots in a position
            logits = [rng.gauss(0, 1) * scale for _ in range(50)]
            if pos == 2:
                logits[rng.randrange(50)] = -INF
            if pos == 3:
                logits[5] = logits[40] = 9000.0  # a tie across blocks
            rows.append((seq, pos, rng.choice([-100, rng.randrange(50)]), logits))
    rows += [(9, 0, 3, [-INF] * 20 + [1.0] * 30), (9, 1, 49, [1e308] * 50), (9, 2, 0, [float("nan")] + [0.0] * 49), (9, 3, 7, [0.0] * 50)]
    return spark.createDataFrame(rows, "seq_id bigint, pos int, label int, logits array<double>")


@pytest.mark.parametrize("classes", [7, 16, 50, 64])
def test_equals_whole_rows(spark, classes):
    df = lo.with_target(whole(spark))
    scores = {(r.seq_id, r.pos): r for r in sh.position_scores(sh.shard_logits(df, classes)).collect()}
    lp = F.when(F.col("target") != -100, sc.log_prob(F.col("logits"), F.col("target")))
    want = df.select("seq_id", "pos", "target", sc.log_sum_exp(F.col("logits")).alias("lse"), sc.entropy(F.col("logits")).alias("entropy"), sc.top1(F.col("logits")).alias("top1"), lp.alias("lp")).collect()
    assert len(want) == len(scores)
    for w in want:
        got = scores[w.seq_id, w.pos]
        assert got.target == w.target and close(got.lse, w.lse) and close(got.lp, w.lp), (w, got)
        assert close(got.entropy, w.entropy), (w, got)
        assert math.isnan(w.lse) or got.top1 == w.top1


def test_losses_equal_those_of_whole_rows(spark):
    df = lo.with_target(whole(spark).where("seq_id < 6 and pos <> 2"))
    got = {r.seq_id: r for r in sh.score_losses(sh.position_scores(sh.shard_logits(df, 9)), ["seq_id"]).collect()}
    for name, fn in (("ce_loss", lo.ce_loss), ("dft_loss", lo.dft_loss), ("token_accuracy", lo.token_accuracy)):
        for r in fn(df, ["seq_id"]).collect():
            assert close(got[r.seq_id][name], r[name]) and got[r.seq_id].tokens == r.tokens


def test_blocks_are_combined_before_the_shuffle_and_logits_stay(spark, tmp_path):
    sh.shard_logits(lo.with_target(whole(spark)), 16).write.parquet(str(tmp_path / "shards"))
    scores = sh.position_scores(spark.read.parquet(str(tmp_path / "shards")))
    text = plan(scores)
    assert "partial_sum(s" in text and "partial_max(best" in text
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and all("logits" not in line for line in exchanges)


def test_missing_blocks_and_logits(spark):
    rows = [(1, 0, 0, [1.0, None], 5), (1, 0, 2, [3.0], 5), (2, 0, 0, [], 1), (3, 0, 0, None, 1), (4, 0, 0, [1.0], -100)]
    df = spark.createDataFrame(rows, "seq_id bigint, pos int, first_class int, logits array<double>, target int")
    got = {r.seq_id: r for r in sh.position_scores(df).collect()}
    assert got[1].lse == pytest.approx(math.log(math.exp(1) + math.exp(3))) and got[1].top1 == 2 and got[1].lp is None
    assert got[2].lse is None and got[3].lse is None and got[2].top1 is None and got[4].lp is None and got[4].lse == 1.0
