"""Near-dedup against brute force, and the guarantee of the multi-index join."""

import random
import re

import numpy as np
import pytest

from sftlake.llm import near
from sftlake.llm.components import components

SCHEMA = "doc_id bigint, text string, comp string, n bigint"


def sets_of(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows, k):
    ids = [i for i, _ in rows]
    sets = [sets_of(t, k) for _, t in rows]
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(ids[i]), find(ids[j])
                root[max(a, b)] = min(a, b)
    return sorted((i, len(s), find(i), find(i) == i) for i, s in zip(ids, sets))


def corpus(seed=0):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    passage = " ".join(rng.choice(words) for _ in range(60))
    for i in range(40):  # texts that share a passage but are no copies
        rows.append(passage + " " + " ".join(rng.choice(words) for _ in range(60 + i)))
    base = [rng.choice(words) for _ in range(150)]
    for _ in range(60):  # one large group of near copies
        own = list(base)
        for _ in range(rng.randint(0, 7)):
            own[rng.randrange(len(own))] = rng.choice(words)
        rows.append(" ".join(own))
    chain = [rng.choice(words) for _ in range(120)]
    for _ in range(12):  # each near the one before, ends far apart
        for _ in range(6):
            chain[rng.randrange(len(chain))] = rng.choice(words)
        rows.append(" ".join(chain))
    rows += ["Exact  Copy of\ttext here"] * 9 + ["one", "One", "two words", "TWO  words", "", "  \n ", "three little words", "a b a b a b"]
    rng.shuffle(rows)
    return list(enumerate(rows, 10))


@pytest.mark.parametrize("words", [2, 5])
def test_equals_brute_force(spark, words):
    rows = corpus(words)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    got = near.near_duplicates(df, words=words)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect())) == brute(rows, words)


def test_nulls_and_repeated_rows(spark):
    a, b = "a b c d e f g h", "other words that are here now"
    df = spark.createDataFrame(
        [(1, None, "x", 1), (None, a, "x", 1), (2, a, "x", 1), (2, a, "x", 1), (3, b, "x", 1), (3, a, "x", 1), (4, b, "x", 1)], SCHEMA
    )
    got = sorted(map(tuple, near.near_duplicates(df, words=2).collect()), key=str)
    # Rows of one id are one document, so 4 reaches 2 through both texts of 3.
    want = [(1, 0, 1, True), (None, 7, None, True), (2, 7, 2, True), (2, 7, 2, True), (3, 5, 2, False), (3, 7, 2, False), (4, 5, 2, False)]
    assert got == sorted(want, key=str)
    assert near.near_duplicates(df.where("false")).count() == 0


def test_pigeonhole_guarantee():
    rng = np.random.default_rng(3)
    for _ in range(300):
        a = rng.integers(0, 1 << 16, near.SYMBOLS).astype("<u2")
        b = a.copy()
        at = rng.choice(near.SYMBOLS, near.MAX_DISTANCE, replace=False)
        b[at] ^= rng.integers(1, 1 << 16, len(at)).astype("<u2")
        assert np.intersect1d(near.chunk_keys(a), near.chunk_keys(b)).size


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    x = np.unique(rng.integers(0, 1 << 63, 4000).astype(np.uint64))
    y = np.concatenate([x[:3600], rng.integers(0, 1 << 63, 500).astype(np.uint64)])
    exact = 3600 / (len(x) + 500)
    same = (near.minima(x) == near.minima(y)).mean()
    assert abs(same - exact) < 0.15


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 300)] + [(7, 7), (8, 9), (9, 8)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()))
    assert {v for k, v in got.items() if 100 <= k <= 160} == {100} and {v for k, v in got.items() if k >= 200} == {5}
    assert got[8] == got[9] == 8 and 7 not in got


@pytest.mark.parametrize("block_rows", [7, 1000])
def test_cells_hold_each_pair_across_components_once(spark, block_rows):
    # Key 1: a component of 40 rows, one of 9, and 25 rows of small ones. Key 2 lies in one component, key 3 in two.
    comps = [1] * 40 + [2] * 9 + [100 + i // 2 for i in range(25)]
    placed = [(r, c, 1, 5, *[0] * 8) for r, c in enumerate(comps)]
    keys = [(1, r) for r in range(len(comps))] + [(2, r) for r in range(30)] + [(3, 0), (3, 45)]
    names = ", ".join(f"{c} bigint" for c in ("rep", "comp", "members", "n", *near.WORDS))
    cells = near._cells(spark.createDataFrame(keys, "key bigint, rep bigint"), spark.createDataFrame(placed, names), block_rows).collect()
    groups = {}
    for r in cells:
        groups.setdefault((r.key, r.a, r.b), ([], []))[r.side].append(r.rep)
    assert {k for k, _, _ in groups} == {1, 3}
    met = []
    for (key, a, b), (x, y) in groups.items():
        assert len(x) <= 5 * block_rows and len(y) <= 5 * block_rows
        met += [(key, *sorted((i, j))) for i in x for j in (y if a != b else x) if comps[i] != comps[j] and (a != b or i < j)]
    want = {(k, i, j) for k in (1, 3) for _, i in filter(lambda t: t[0] == k, keys) for _, j in filter(lambda t: t[0] == k, keys) if i < j and comps[i] != comps[j]}
    assert len(met) == len(set(met)) and set(met) == want
    if block_rows == 7:  # the large component's rows are met by others, never by one another
        assert max(len(x) + len(y) for x, y in groups.values()) < 40


def test_equals_brute_force_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(near._cells, "__defaults__", (4,))
    rows = corpus(7)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    assert sorted(map(tuple, near.near_duplicates(df, words=2).collect())) == brute(rows, 2)


def test_refuses_a_similarity_below_its_layout(spark):
    with pytest.raises(ValueError, match="80 or more"):
        near.near_duplicates(spark.createDataFrame([], SCHEMA), percent=60)


def test_parts_of_frequent_keys(spark, monkeypatch):
    """A key with many rows is cut into parts that all have its smallest row, and the result stays the same."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(near, "STAR_ROWS", 7)
    rows = corpus(2)
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    assert sorted(map(tuple, near.near_duplicates(df, words=2).collect())) == brute(rows, 2)
    monkeypatch.setattr(near, "STAR_ROWS", 100)
    shared = spark.range(3000).selectExpr("if(id < 2000, 1, id div 2) key", "id rep")
    parts = near._parts(shared)
    sizes = parts.groupBy("key").agg(F.count("*").alias("n"), F.min("rep").alias("least")).collect()
    hot = [r for r in sizes if r.least == 0]
    assert len(hot) == 20 and max(r.n for r in hot) < 160 and sum(r.n for r in hot) == 2000 + 19
    assert {r.n for r in sizes if r.least != 0} == {2}


def test_shared_keys_equal_counting(spark, monkeypatch):
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 1 << 16, (200, near.SYMBOLS)).astype("<u2")
    symbols[50:120, :40] = symbols[3, :40]  # a frequent part
    reps = spark.createDataFrame([(i, bytes(s.tobytes())) for i, s in enumerate(symbols)], "rep bigint, symbols binary")
    keys = near.chunk_keys(symbols).view(np.int64)
    held = {}
    for i, own in enumerate(keys):
        for k in set(own.tolist()):
            held.setdefault(k, []).append(i)
    want = sorted((k, i) for k, own in held.items() if len(own) > 1 for i in own)
    sliced = near.sliced
    for rows in (4096, 30, 1):  # one batch, several, a row each
        monkeypatch.setattr(near, "sliced", lambda batches, most: sliced(batches, min(most, rows)))  # noqa: B023
        assert sorted(map(tuple, near._shared_keys(reps).collect())) == want and len(want) > 1000


def test_a_very_long_text(spark):
    rng = random.Random(8)
    long = [f"w{rng.randint(0, 50_000)}" for _ in range(120_000)]
    other = list(long)
    for i in range(0, len(other), 40):
        other[i] = "changed"
    rows = [(1, " ".join(long)), (2, " ".join(other)), (3, " ".join(long[:60_000]))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, near.near_duplicates(df).collect())) == brute(rows, 5)
