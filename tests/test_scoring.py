import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from sftlake.functions import scoring as sc
from sftlake.operators import losses as lo

CLASSES, LENGTH, SEQS = 11, 9, 6


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    logits = rng.normal(0, 4, (SEQS, LENGTH, CLASSES))
    labels = rng.integers(0, CLASSES, (SEQS, LENGTH))
    labels[:, :3] = -100
    labels[2] = -100
    data = [
        (s, p, s % 2, int(labels[s, p]), [float(x) for x in logits[s, p]]) for s in range(SEQS) for p in range(LENGTH)
    ]
    df = spark.createDataFrame(data, "seq_id bigint, pos int, batch int, label int, logits array<double>")
    return df, logits, labels


def log_softmax(logits):
    top = logits.max(-1, keepdims=True)
    return logits - top - np.log(np.exp(logits - top).sum(-1, keepdims=True))


def expected(logits, labels, batch):
    lp = log_softmax(logits)
    ce = dft = hits = n = 0
    ent, m = 0.0, 0
    for s in range(SEQS):
        if s % 2 != batch:
            continue
        for p in range(LENGTH):
            if labels[s, p] != -100:
                ent -= (np.exp(lp[s, p]) * lp[s, p]).sum()
                m += 1
            if p + 1 < LENGTH and labels[s, p + 1] != -100:
                x = lp[s, p, labels[s, p + 1]]
                ce, dft, n = ce - x, dft - math.exp(x) * x, n + 1
                hits += int(logits[s, p].argmax() == labels[s, p + 1])
    return ce / n, dft / n, hits / n, ent / m, n, m


@pytest.mark.parametrize("batch", [0, 1])
def test_losses_by_brute_force(table, batch):
    df, logits, labels = table
    ce, dft, acc, ent, n, m = expected(logits, labels, batch)
    one = df.where(F.col("batch") == batch)
    assert lo.ce_loss(one).first() == (pytest.approx(ce), n)
    assert lo.dft_loss(one).first() == (pytest.approx(dft), n)
    assert lo.token_accuracy(one).first() == (pytest.approx(acc), n)
    assert lo.masked_entropy(one).first() == (pytest.approx(ent), m)
    assert lo.ce_loss(one, num_items=4).first()[0] == pytest.approx(ce * n / 4)
    by = {r.batch: r.ce_loss for r in lo.ce_loss(df, ["batch"]).collect()}
    assert by[batch] == pytest.approx(ce)


def test_bounds(table):
    df = table[0].select(sc.entropy(F.col("logits")).alias("h"), sc.log_sum_exp(F.col("logits")).alias("z"))
    assert all(0 <= r.h <= math.log(CLASSES) + 1e-12 for r in df.collect())


def test_all_masked_is_zero(spark):
    df = spark.createDataFrame([(1, 0, -100, [1.0, 2.0])], "seq_id int, pos int, label int, logits array<double>")
    assert tuple(lo.ce_loss(df).first()) == (0.0, 0)
    assert tuple(lo.token_accuracy(df).first()) == (0.0, 0)
    assert tuple(lo.masked_entropy(df).first()) == (0.0, 0)


def test_last_label_is_a_target_only_of_the_position_before(spark):
    df = spark.createDataFrame(
        [(1, 0, -100, [0.0, 0.0]), (1, 1, 1, [0.0, 5.0])], "seq_id int, pos int, label int, logits array<double>"
    )
    assert tuple(lo.ce_loss(df).first()) == (pytest.approx(math.log(2)), 1)


def test_special_logits(spark):
    df = spark.createDataFrame([([0.0, float("-inf")],), ([3.0, 3.0],), ([1e4, 0.0],)], "l array<double>")
    l = F.col("l")
    got = rows(df.select(sc.entropy(l), sc.top1(l), sc.log_prob(l, F.lit(0)), sc.log_probs(l, F.array(F.lit(1), F.lit(0)))))
    assert math.isnan(got[0][0]) and got[0][2] == 0.0
    assert got[1][0] == pytest.approx(math.log(2)) and got[1][1] == 0
    assert got[2][2] == 0.0 and got[2][3] == [-1e4, 0.0]


def test_perplexity_cap(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (20.0,), (500.0,)], "x double")
    got = [r[0] for r in rows(df.select(sc.perplexity(F.col("x"))))]
    assert got == pytest.approx([1.0, math.exp(1), math.exp(20), math.exp(20)])


def test_bucketed_logits_are_not_shuffled_for_the_targets(table, spark):
    table[0].write.mode("overwrite").bucketBy(4, "seq_id").sortBy("seq_id", "pos").saveAsTable("logits_bucketed")
    assert "Exchange" not in plan(lo.with_target(spark.table("logits_bucketed")))
    same = lo.ce_loss(spark.table("logits_bucketed")).first()
    assert same[1] == lo.ce_loss(table[0]).first()[1]


def test_losses_of_a_table_with_targets_move_no_logits(spark):
    from sftlake.plans import inputs as inp

    logits = inp.targeted_logits(spark, "/root/testdata/sf0.001")
    for loss in (lo.ce_loss, lo.dft_loss, lo.token_accuracy):
        text = plan(loss(logits.withColumn("batch_id", F.col("seq_id") % 7), ["batch_id"]))
        assert "Window" not in text and text.count("Exchange hashpartitioning") == 1
        assert "partial_" in text and all("logits" not in line for line in text.splitlines() if "Exchange" in line)
