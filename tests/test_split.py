import hashlib

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from sftlake.operators import split as sp


def brute_force(prompts, frac=0.2, seed=42):
    groups = {}
    for i, p in enumerate(prompts):
        groups.setdefault(p or "", []).append(i)
    target, val = int(frac * len(prompts)), set()
    for p in sorted(groups, key=lambda p: hashlib.md5(f"{seed}|{p}".encode()).hexdigest()):
        if len(val) < target:
            val.update(groups[p])
    return [(i, "val" if i in val else "train") for i in range(len(prompts))]


@pytest.mark.parametrize("prompts", [
    [f"p{i % 37}" for i in range(400)],
    ["hot"] * 200 + [f"p{i}" for i in range(100)],
    [None] * 30 + [""] * 30 + [f"p{i}" for i in range(40)],
    ["same"] * 50,
    ["a", "b", "c", "d"],
    ["a", "b", "c", "d", "e"],
])
@pytest.mark.parametrize("frac, seed", [(0.2, 42), (0.5, 1), (0.0, 42), (1.0, 3)])
def test_group_split(spark, prompts, frac, seed):
    df = spark.createDataFrame(list(enumerate(prompts)), "i int, prompt string")
    out = sp.group_split(df, val_frac=frac, seed=seed)
    assert sorted(rows(out.select("i", "split"))) == brute_force(prompts, frac, seed)
    assert sp.split_leakage(out).first().leaked_prompts == 0


def test_small_sets_have_no_validation(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "prompt string")
    assert {r.split for r in sp.group_split(df).collect()} == {"train"}


def test_rows_are_not_shuffled(spark, tmp_path):
    spark.range(1000).select(F.concat(F.lit("p"), F.col("id") % 50).alias("prompt"), F.repeat(F.lit("x"), 50).alias("response")).write.parquet(str(tmp_path / "t"))
    out = sp.group_split(spark.read.parquet(str(tmp_path / "t")))
    out.collect()
    main = plan(out).split("Subquery")[0]
    assert "Exchange" not in main and "Join" not in main


def test_leakage_of_a_row_split(spark):
    df = spark.createDataFrame(
        [("a", "train"), ("a", "val"), ("a", "val"), ("b", "val"), ("c", "train"), (None, "train"), ("", "val")],
        "prompt string, split string",
    )
    assert tuple(sp.split_leakage(df).first()) == (2, 3, 4, 0.75)
    assert tuple(sp.split_report(df).first()) == (4, 3, 4)
