"""Hard negatives and Strassen's recursion against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sftlake.llm import negatives


@pytest.mark.parametrize("m, k, n", [(1, 1, 1), (5, 7, 3), (64, 64, 64), (100, 33, 70), (129, 64, 257), (40, 200, 40), (0, 4, 3)])
@pytest.mark.parametrize("reach", [300, 1 << 40])
def test_strassen_equals_the_product(m, k, n, reach):
    rng = np.random.default_rng(m + k + n)
    a, b = rng.integers(-reach, reach, (m, k)), rng.integers(-reach, reach, (k, n))
    assert (negatives.strassen(a, b, leaf=8) == a @ b).all()  # beyond the range both wrap around alike


def test_seven_products_a_level(monkeypatch):
    sides = []
    base = negatives._base
    monkeypatch.setattr(negatives, "_base", lambda a, b: (sides.append(a.shape + b.shape[1:]), base(a, b))[1])
    negatives.strassen(np.ones((64, 64), np.int64), np.ones((64, 128), np.int64), leaf=16)
    assert len(sides) == 49 and set(sides) == {(16, 16, 32)}


def brute(rows, anchors, positives=5, keep=3, low=50, high=95):
    good = [
        (i, label, [math.floor(256.0 * x) for x in v]) for i, label, v in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a in (r for r in good if anchors(r[0])):
        score = {id(r): sum(x * y for x, y in zip(a[2], r[2])) for r in good}
        best = lambda rows: sorted(rows, key=lambda r: (-score[id(r)], r[0], r[1]))
        for p in best(r for r in good if r is not a and r[1] == a[1])[:positives]:
            inside = [r for r in good if r[1] != a[1] and low * score[id(p)] <= 100 * score[id(r)] <= high * score[id(p)]]
            out += [(a[0], p[0], k, r[0], score[id(p)], score[id(r)]) for k, r in enumerate(best(inside)[:keep], 1)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int, uid int, tile int")
    return sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("id") % 10 == 0, **options).collect())


def test_equals_brute_force_over_tiles_and_blocks(spark):
    rng = random.Random(3)
    base = [[rng.gauss(0.3, 1) for _ in range(20)] for _ in range(6)]
    rows = [(i, [x + rng.gauss(0, 0.5) for x in rng.choice(base)], rng.choice([1, 1, 2, 3])) for i in range(400)]
    rows += [(1000 + i, rows[7][1], 2) for i in range(30)]  # ties
    got = mined(spark, [(i, v, label, 1, 1) for i, v, label in rows], tile_rows=64, block_rows=8)
    assert got == brute([(i, label, v) for i, v, label in rows], lambda i: i % 10 == 0) and len(got) > 300


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 1), (1, [1.0, 1.0], 1), (2, [0.9, 0.7], 2), (3, [0.9], 2), (4, None, 1), (5, [nan, 1.0], 2), (6, [inf, 1.0], 1),
        (7, [None, 1.0], 2), (8, [1.0, 1.0], None), (None, [1.0, 1.0], 2), (10, [0.0, 0.0], 2), (20, [], 2), (30, [-1.0, -1.0], 3), (31, [1.0, 1.0], 3),
        (1, [1.0, 1.0], 1), (1, [0.5, 0.5], 1),
    ]
    got = mined(spark, [(i, v, label, 1, 1) for i, v, label in rows])
    assert got == brute([(i, label, v) for i, v, label in rows], lambda i: i % 10 == 0)
    assert [r for r in got if r[0] == 0] and mined(spark, []) == []
    with pytest.raises(Exception, match="too large"):
        mined(spark, [(0, [1e300], 1, 1, 1), (1, [1.0], 1, 1, 1)])


def test_a_hot_label_is_dealt_over_tiles(spark):
    df = spark.range(3000).selectExpr("id vec_id", "if(id % 3 < 2, 1, 2) label", "array(1d, 1d) embedding")
    got = negatives.hard_negatives(df, F.col("id") == 0, tile_rows=256).collect()
    # Equal scores are outside of the window, which ends at 95 per cent.
    assert got == []
    df = df.withColumn("embedding", F.expr("if(label = 1, array(1d, 1d), array(0.9d, 0.9d))"))
    got = sorted(tuple(r)[:4] for r in negatives.hard_negatives(df, F.col("id") == 0, tile_rows=256).collect())
    assert got == [(0, p, k + 1, n) for p in (1, 3, 4, 6, 7) for k, n in enumerate((2, 5, 8))]
