"""Mixing: word counts, water filling, flow, and the seeded choice."""

import itertools
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sftlake.llm import mixing


def test_word_count_equals_pattern(spark):
    texts = [None, "", " ", "a", " a\tb\x0b\x0cc\r\nd ", "é　x y", "\x1cx", "a  b   c" * 300]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", mixing.word_count(F.col("t")).alias("n")).collect()
    assert all(r.n == len(re.findall(r"[^\x20\x09-\x0D]+", r.t or "")) for r in got)


@given(st.lists(st.integers(0, 50), min_size=1, max_size=9))
@settings(max_examples=100, deadline=None)
def test_water_fill_equals_resharing(sizes):
    names = [None if i == 3 else f"s{i}" for i in range(len(sizes))]
    size, w = dict(zip(names, sizes)), mixing.cyclic_weights(names)
    got = mixing.water_fill(size, w)
    full, left = {}, set(names)
    while left:
        rest = sum(sizes) - sum(full.values())
        share = {s: rest * w[s] / sum(w[t] for t in left) for s in left}
        over = {s for s in left if share[s] > 3 * size[s]}
        if not over:
            full |= share
            break
        full |= {s: 3.0 * size[s] for s in over}
        left -= over
    assert all(abs(got[s] - full[s]) < 1e-6 * (1 + sum(sizes)) for s in names)


def test_null_source_comes_last_in_code_point_order():
    assert mixing.cyclic_weights([None, "b", "a", "\U0001f600", "￰"]) == {"a": 5.0, "b": 2.0, "￰": 1.0, "\U0001f600": 5.0, None: 2.0}


@given(st.lists(st.integers(1, 4), min_size=3, max_size=3), st.lists(st.integers(0, 6), min_size=2, max_size=2))
@settings(max_examples=60, deadline=None)
def test_flow_is_cheapest(sizes, quotas):
    patterns = dict(zip([("a",), ("b",), ("a", "b")], sizes))
    want = dict(zip(("a", "b"), quotas))
    words = mixing.route(patterns, want)
    cost = lambda p, n: sum(k * (k + 1) // 2 * max(0, min(patterns[p], n - k * patterns[p])) for k in range(3))
    best = None
    for a, b, x, y in itertools.product(range(13), range(13), range(13), range(13)):
        if a > 3 * sizes[0] or b > 3 * sizes[1] or x + y > 3 * sizes[2] or a + x > quotas[0] or b + y > quotas[1]:
            continue
        found = (-(a + b + x + y), cost(("a",), a) + cost(("b",), b) + cost(("a", "b"), x + y))
        best = found if best is None else min(best, found)
    assert (-sum(words.values()), sum(cost(p, n) for p, n in words.items())) == best


def test_sources_come_near_their_targets(spark):
    rng = random.Random(2)
    rows = [(i, "w " * rng.randint(0, 60), rng.choice(["a"] * 9 + ["b", "c", None]), i) for i in range(3000)]
    rows += [(None, "no id here", "c", 1), (3, None, "b", 2), (4, "same row", "d", 3), (4, "same row", "d", 3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, size int")
    mixed, plan = mixing.mix(df)
    assert mixed.columns[: len(df.columns)] == df.columns
    got = mixing.mix_report(plan).collect()
    assert len(got) == len(rows)
    again = mixing.mix_report(mixing.mix(df)[1])
    assert sorted(map(str, got)) == sorted(map(str, again.collect())) == sorted(map(str, mixed.select(again.columns).collect()))
    for s, target in plan["targets"].items():
        own = [r for r in got if r._sources == [s]]
        assert abs(sum(r._taken for r in own) - target) <= max(r._size for r in own) / 2 + 1
    assert all(0 <= r._taken <= 3 * r._size and (r._size == 0 or r._taken % r._size == 0) for r in got)


def test_overlapping_sources(spark):
    rows = [(i, "x y z", ["a", "b"] if i % 2 else ["a"] if i % 4 else []) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, tags array<string>")
    _, plan = mixing.mix(df, sources=F.col("tags"))
    taken = {tuple(r.s): r.t for r in mixing.mix_report(plan).groupBy(F.col("_sources").alias("s")).agg(F.sum("_taken").alias("t")).collect()}
    assert taken[()] == 0 and abs(sum(taken.values()) - 900) <= 6
    assert mixing.mix_report(mixing.mix(df.where("false"), sources=F.col("tags"))[1]).count() == 0


def test_columns_of_the_operators_own_names(spark):
    rows = [(i, "a b c d", "ab"[i % 2], f"own {i}", i, [i], "x", "y", "z", "p", "q", "r") for i in range(30)]
    names = "_size, _rest, _sources, _doc, _order, _p, _base, _cut, _last".split(", ")
    df = spark.createDataFrame(rows, ["doc_id", "text", "source", *names])
    mixed, _ = mixing.mix_rows(df)
    assert sorted(map(tuple, mixed.select("_row.*").collect())) == sorted(map(tuple, df.collect()))
    added, plan = mixing.mix(df)
    assert added.columns == [c for c in df.columns if c not in ("_doc", "_size", "_sources", "_taken")] + ["_doc", "_size", "_sources", "_taken"]
    assert {(r.doc_id, r._size) for r in added.collect()} == {(i, 4) for i in range(30)}
    counts, _ = mixing.mix_counts(df)
    assert sorted(map(str, counts.collect())) == sorted(map(str, mixing.mix_report(plan).collect()))


def test_many_patterns_are_routed_in_time():
    import time

    rng = random.Random(3)
    names = [f"s{i}" for i in range(16)]
    patterns = {tuple(sorted(rng.sample(names, rng.randint(1, 8)))): rng.randint(1, 10_000) for _ in range(20_000)}
    total = sum(patterns.values())
    began = time.process_time()
    words = mixing.route(patterns, {s: total // 16 for s in names})
    assert time.process_time() - began < 60
    assert sum(words.values()) == total // 16 * 16 and all(0 <= words[p] <= 3 * n for p, n in patterns.items())
