"""Merkle manifest against brute force."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from sftlake.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def enc(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes, arity):
    """The root, and each leaf's siblings level by level as (left, right)."""
    at, proofs = [[i] for i in range(len(nodes))], [[] for _ in nodes]
    while len(nodes) > 1:
        up, below = [], []
        for lo in range(0, len(nodes), arity):
            run = nodes[lo : lo + arity]
            for k in range(len(run)):
                for leaf in at[lo + k]:
                    proofs[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(h(*run))
            below.append(sum(at[lo : lo + arity], []))
        nodes, at = up, below
    return nodes[0], proofs


def brute(rows, arity):
    """{(id, leaf): (subroot, root, path)}"""
    groups = {}
    for i, g, x in rows:
        groups.setdefault(g, []).append((i is not None, i or 0, h(enc(i), enc(g), enc(x))))
    names = sorted(groups, key=lambda g: b"" if g is None else b"=" + g.encode())
    trees = {g: climb([leaf for *_, leaf in sorted(groups[g])], arity) for g in names}
    root, upper = climb([trees[g][0] for g in names], arity)
    out = []
    for g, above in zip(names, upper):
        for (some, i, leaf), own in zip(sorted(groups[g]), trees[g][1]):
            out.append((i if some else None, g, leaf, trees[g][0], root, own + above))
    return sorted(out, key=str)


def got(spark, rows, arity):
    df = spark.createDataFrame([(i, g, x, 5, 6, 7) for i, g, x in rows], "id bigint, g string, text string, pos int, n int, h int")
    found = merkle.manifest(df, ["id", "g", "text"], "g", "id", arity).collect()
    return sorted(((r.id, r.g, r.leaf, r.subroot, r.root, [tuple(s) for s in r.path]) for r in found), key=str)


@pytest.mark.parametrize("arity", [2, 3])
def test_equals_brute_force(spark, arity, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_BITS", 3)  # several passes
    rng = random.Random(arity)
    rows = [(i, rng.choice(["en", "en", "en", None, "é", "z", ""]), "x" * rng.randint(0, 5)) for i in rng.sample(range(1000), 150)]
    rows += [(2000, "only", None), (None, "en", "a"), (None, "en", None), (3000, "en", "twin"), (3000, "en", "twin"), (3000, "en", "other")]
    assert got(spark, rows, arity) == brute(rows, arity)


def test_groups_of_small_sizes(spark):
    """Groups of one to nine rows; and one group alone, whose root is the root."""
    rows = [(10 * n + i, f"of {n}", str(i)) for n in range(1, 10) for i in range(n)]
    assert got(spark, rows, 2) == brute(rows, 2)
    alone = got(spark, rows[:1], 2)
    assert alone == brute(rows[:1], 2) and alone[0][2] == alone[0][3] == alone[0][4] and alone[0][5] == []


def test_empty_and_long(spark):
    assert got(spark, [], 2) == []
    rows = [(1, "en", "lang " * 300_000), (2, "de", "")]
    assert got(spark, rows, 2) == brute(rows, 2)


def test_folding_finds_tampering(spark):
    rows = [(i, "ab"[i % 2], str(i)) for i in range(11)]
    df = spark.createDataFrame(rows, "id bigint, g string, text string")
    found = merkle.manifest(df, ["id", "g", "text"], "g", "id")
    checked = found.select(
        (merkle.folded(F.col("leaf"), F.col("path")) == F.col("root")).alias("same"),
        (merkle.folded(F.sha2(F.concat("leaf"), 256), F.col("path")) == F.col("root")).alias("other"),
    ).collect()
    assert all(r.same and not r.other for r in checked) and len(checked) == 11


def test_a_window_holds_a_block_not_a_group(spark):
    df = spark.range(5000).selectExpr("id", "if(id % 10 < 9, 'hot', 'rare') g", "cast(id as string) text")
    leaves = merkle.placed(df.select(F.col("id"), merkle.group_key(F.col("g")).alias("g"), F.sha2("text", 256).alias("h")), ["id"])
    sizes = leaves.groupBy("g", F.expr(f"pos div {1 << merkle.BLOCK_BITS}")).count().agg(F.max("count")).first()[0]
    assert sizes == 1 << merkle.BLOCK_BITS and leaves.where("g = '=hot'").agg(F.countDistinct("pos"), F.max("pos")).first()[:] == (4500, 4499)


def test_audit_against_a_stored_manifest(spark, tmp_path):
    rows = [(i, "ab"[i % 2], str(i)) for i in range(12)] + [(20, "a", "twin"), (20, "a", "twin"), (None, "b", None)]
    schema = "id bigint, g string, text string"
    columns = ["id", "g", "text"]
    merkle.manifest(spark.createDataFrame(rows, schema), columns, "g", "id").write.parquet(str(tmp_path / "m"))
    proofs = spark.read.parquet(str(tmp_path / "m"))
    same = merkle.audit(spark.createDataFrame(rows, schema), proofs, columns, "id").collect()
    assert len(same) == 14 and all(r.n_now == r.n_then and r.proven for r in same)
    later = [r for r in rows if r[0] != 3] + [(30, "a", "new")]
    later[0] = (0, "a", "tampered")
    later.remove((20, "a", "twin"))
    found = {(r.id, r.n_now, r.n_then) for r in merkle.audit(spark.createDataFrame(later, schema), proofs, columns, "id").collect() if r.n_now != r.n_then}
    assert found == {(3, 0, 1), (0, 1, 0), (0, 0, 1), (20, 1, 2), (30, 1, 0)}
    forged = proofs.withColumn("leaf", F.when(F.col("id") == 5, F.sha2("leaf", 256)).otherwise(F.col("leaf")))
    assert [r.id for r in merkle.audit(spark.createDataFrame(rows, schema), forged, columns, "id").collect() if r.proven is False] == [5]
