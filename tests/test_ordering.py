import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sftlake.operators import examples as ex
from sftlake.operators import ordering
from sftlake.operators.ordering import number_by_position, quota_cutoff, running


def test_running_equals_brute_force(spark):
    rng = random.Random(1)
    data = []
    for key, size in (("hot", 900), ("a", 5), ("b", 1)):
        for order in rng.sample(range(5000), size):
            data.append((key, order, rng.randrange(-50, 50), rng.choice([None, rng.randrange(100)])))
    df = spark.createDataFrame(data, "k string, o bigint, v bigint, w bigint")
    got = running(
        df, ["k"], "o",
        {
            "s": ("sum", F.col("v")), "c": ("count", F.col("w")), "lo": ("min", F.col("v")),
            "prev": ("last", F.col("w")), "before": ("sum", F.col("v")), "top": ("max", F.col("v")),
        },
        exclusive=["prev", "before", "top"], block=64,
    )
    want = []
    for key in ("hot", "a", "b"):
        total = count = 0
        low = prev = top = None
        for k, o, v, w in sorted(d for d in data if d[0] == key):
            before = total
            total += v
            count += w is not None
            low = v if low is None else min(low, v)
            want.append((k, o, v, w, total, count, low, prev, before, top))
            prev = w if w is not None else prev
            top = v if top is None else max(top, v)
    assert sorted(rows(got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("orders", [
    range(1000),
    [*range(500), *range(10**15, 10**15 + 500)],
    [0, *range(2**62, 2**62 + 300)],
    [7],
    [-5, -3, 0, 9],
])
def test_number_by_position(spark, orders):
    shuffled = list(orders)
    random.Random(2).shuffle(shuffled)
    numbered = number_by_position(spark.createDataFrame([(o,) for o in shuffled], "o bigint"), "o")
    got = rows(numbered.select("o", "_rn", "_total"))
    assert sorted(got) == [(o, i, len(shuffled)) for i, o in enumerate(sorted(orders))]


@pytest.mark.parametrize("orders", [range(2000), [i * i * 1000003 for i in range(2000)], [i << 33 for i in range(50)]])
@pytest.mark.parametrize("n", [1, 7, 25, 300])
def test_quota_cutoff(spark, orders, n):
    df = spark.createDataFrame([(o,) for o in orders], "o bigint")
    kept = [o for o in orders if o % 3 != 1]
    want = kept[n - 1] if len(kept) >= n else None
    assert quota_cutoff(df, "o", F.col("o") % 3 != 1, n, parts=16) == want


def test_position_buckets_survive_clusters(spark):
    df = spark.range(200_000).union(spark.createDataFrame([(10**17,), (2 * 10**17,)], "id bigint"))
    shares = [i / ordering.POSITION_BUCKETS for i in range(1, ordering.POSITION_BUCKETS)]
    bounds = df.agg(F.percentile_approx("id", shares, 20 * ordering.POSITION_BUCKETS)).first()[0]
    sizes = [b - a for a, b in zip(bounds, bounds[1:])]
    assert max(sizes) < 4 * 200_000 / ordering.POSITION_BUCKETS
    assert df.count() == number_by_position(df, "id").agg(F.countDistinct("_rn")).first()[0]


def test_null_keys_are_kept_and_null_positions_refused(spark):
    df = spark.createDataFrame([(None, 1, 2), (None, 2, 3), ("a", 1, 5)], "k string, o bigint, v bigint")
    got = running(df, ["k"], "o", {"s": ("sum", F.col("v"))})
    assert sorted(rows(got), key=str) == sorted([(None, 1, 2, 2), (None, 2, 3, 5), ("a", 1, 5, 5)], key=str)
    bad = spark.createDataFrame([("a", None, 1), ("a", 1, 1)], "k string, o bigint, v bigint")
    with pytest.raises(Exception, match="no place in the order"):
        running(bad, ["k"], "o", {"s": ("sum", F.col("v"))}).collect()
    with pytest.raises(Exception, match="no place in the order"):
        number_by_position(bad, "o").collect()


def test_quota_refuses_ties_at_the_cut(spark):
    df = spark.createDataFrame([(o, i) for o in (1, 2) for i in range(10)], "o bigint, i int")
    with pytest.raises(ValueError, match="not unique"):
        quota_cutoff(df, "o", F.lit(True), 5)
    assert quota_cutoff(df, "o", F.lit(True), 10) == 1


def test_quota_edges(spark):
    df = spark.range(10).withColumnRenamed("id", "o")
    assert quota_cutoff(df, "o", F.lit(True), 10) == 9
    assert quota_cutoff(df, "o", F.lit(True), 11) is None
    assert quota_cutoff(df.where("o < 0"), "o", F.lit(True), 1) is None
    with pytest.raises(ValueError):
        quota_cutoff(df, "o", F.lit(True), 0)


@pytest.mark.parametrize("shuffle", [True, False])
@pytest.mark.parametrize("n", [1, 8, 37])
def test_assign_batches(spark, shuffle, n):
    df = spark.range(n).withColumnRenamed("id", "ord")
    got = rows(ex.assign_batches(df, 8, shuffle=shuffle))
    assert sorted(r[0] for r in got) == list(range(n))
    assert sorted(r[1] * 8 + r[2] for r in got) == list(range(n))
    if not shuffle:
        assert all(o == b * 8 + p for o, b, p in got)
    dropped = rows(ex.assign_batches(df, 8, shuffle=shuffle, drop_last=True))
    assert sorted(r[1] * 8 + r[2] for r in dropped) == list(range(n - n % 8))
