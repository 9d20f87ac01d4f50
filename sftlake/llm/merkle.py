"""Merkle manifest of a dataset: group trees under one root, inclusion proofs, verification.

Each row is a leaf: the digest of its columns, every one written as its byte count, a colon and its value (a dash if null), so
no two different rows read alike. A group's leaves stand in order; while several nodes remain, every ``arity`` consecutive ones
(the last run may be shorter, even one) become their digest. The groups' roots, in group order, form one more tree.

Levels are lag/lead windows. Rows keep the place (``pos``) of their leaf; the node above it at level l is held by the run's first
row, the one whose place is divisible by ``arity**l``, so a node's siblings stand at fixed offsets, multiples of ``arity**l`` rows before
and after. Slot and run length mask what does not belong to the run. Going up, the first child hashes its parent; going down, a child
takes its parent's path from the first child by one more lag. A window holds an aligned block of ``arity**levels`` rows, never a whole
group: blocks' roots are the leaves of the next pass, of which log(rows) to the base of a block are needed, and a group with all
the rows is as many blocks as its rows fill. Places come from a range partition and one count per partition and group.

Defined cases: a null column is a dash, a null group is a group of its own, the first; groups are ordered by the UTF-8 bytes of their text;
rows of equal order values follow their digests, and repeated rows are leaves of their own; the root of a group of one row is its leaf; other columns of
the table play no part; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sftlake.llm.common import stored
from sftlake.operators.ordering import int_div

#: Leaves of a window, at the binary tree's arity: 2 ** 10.
BLOCK_BITS = 10
_STEP = "struct<left:string,right:string>"


def joined_digest(*parts: Column) -> Column:
    """H: lowercase hex SHA-256 of the parts one after another."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A column as the byte count of its text, a colon and the text; a dash if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return joined_digest(*map(field, columns))


def group_key(group: Column) -> Column:
    """A text that is never null and sorts as the group does, null first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``pos``, the place of a row in its group ``g`` by ``order`` (from 0), and ``n``, the rows of the group.

    Rows are dealt into ranges of group and order and numbered there; what a group has in the ranges before is added
    from one row per range and group. The last order key is the row's place in ``rows``: equal rows do not meet in one range.
    """
    keys = ["g", *order, "_scan"]
    ranged = rows.withColumn("_scan", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    table = stored(ranged.drop("_scan").withColumn("_at", F.monotonically_increasing_id()), "merkle-places")
    part = F.shiftright("_at", 33)
    counts = table.groupBy("g", part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    inside = W.partitionBy("g").orderBy("_part")
    before = F.coalesce(F.sum("_n").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    firsts = counts.select("g", "_part", (before - F.col("_first")).alias("_shift"), F.sum("_n").over(W.partitionBy("g")).alias("n"))
    return table.withColumn("_part", part).join(firsts, ["g", "_part"]).withColumn("pos", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")


def _step(level: int, arity: int) -> tuple[int, Column, Column, Column, Column]:
    """Rows between nodes, and of the node that a row holds at a level: is there one with others beside it, its slot, its run's length."""
    step = arity**level
    nodes = F.ceil(F.col("n") / F.lit(step))
    index = int_div(F.col("pos"), step)
    slot = F.pmod(index, F.lit(arity))
    run = F.least(F.lit(arity), nodes - (index - slot))
    return step, (F.pmod(F.col("pos"), F.lit(step)) == 0), nodes > 1, slot, run


def _up(rows: DataFrame, arity: int, levels: int) -> DataFrame:
    """Add ``_s0, _s1, ...``, the siblings to the left and right of each row's node at every level, and ``_top``, the digest of the block."""
    rows = rows.withColumn("_top", F.col("h"))
    block = W.partitionBy("g", "block").orderBy("pos")
    for level in range(levels):
        step, holds, several, slot, run = _step(level, arity)
        offsets = range(1, arity)
        rows = rows.withColumns(
            {f"_l{j}": F.lag("_top", j * step).over(block) for j in offsets} | {f"_r{j}": F.lead("_top", j * step).over(block) for j in offsets}
        )
        left = F.concat(*(F.when(slot >= j, F.col(f"_l{j}")).otherwise(F.lit("")) for j in reversed(offsets)))
        right = F.concat(*(F.when(slot + F.lit(j) < run, F.col(f"_r{j}")).otherwise(F.lit("")) for j in offsets))
        rows = rows.withColumn(f"_s{level}", F.when(holds & several, F.struct(left.alias("left"), right.alias("right"))))
        parent = F.when(several, joined_digest(F.col("_top"), F.col(f"_s{level}.right"))).otherwise(F.col("_top"))
        rows = rows.withColumn("_top", F.when(holds & (slot == 0), parent)).drop(*(f"_{side}{j}" for side in "lr" for j in offsets))
    return rows


def _down(rows: DataFrame, arity: int, levels: int) -> DataFrame:
    """Add ``path``: a row's siblings from its leaf to its block's digest, one struct a level."""
    empty = F.array().cast(f"array<{_STEP}>")
    block = W.partitionBy("g", "block").orderBy("pos")
    rows = rows.withColumn("path", empty)
    for level in range(levels - 1, -1, -1):
        step, holds, several, slot, _ = _step(level, arity)
        rows = rows.withColumns({f"_p{j}": F.lag("path", j * step).over(block) for j in range(1, arity)})
        parent = F.col("path")
        for j in range(1, arity):
            parent = F.when(slot == j, F.col(f"_p{j}")).otherwise(parent)
        own = F.when(several, F.concat(F.array(F.col(f"_s{level}")), parent)).otherwise(empty)
        rows = rows.withColumn("path", F.when(holds, own)).drop(f"_s{level}", *(f"_p{j}" for j in range(1, arity)))
    return rows


def paths(rows: DataFrame, arity: int, top=None) -> DataFrame:
    """Add ``root``, the digest of a row's group, and ``path``, its siblings on the way there, to placed rows (g, pos, n, h).

    ``top`` maps the groups' roots (g, h) to (g, h, root, path) and so carries all paths on.
    """
    most, levels = rows.agg(F.max("n")).first()[0] or 0, 1
    while arity**levels < most and arity ** (levels + 1) <= 1 << BLOCK_BITS:
        levels += 1
    size = arity**levels
    if most <= 1:
        if top is None:
            return rows.withColumns({"root": F.col("h"), "path": F.array().cast(f"array<{_STEP}>")})
        above = top(rows.select("g", "h")).select("g", "root", "path")
        return rows.join(above, "g")
    climbed = _up(rows.withColumn("block", int_div(F.col("pos"), size)), arity, levels)
    blocks = climbed.where(F.pmod(F.col("pos"), F.lit(size)) == 0).select(
        "g", F.col("block").alias("pos"), F.ceil(F.col("n") / F.lit(size)).alias("n"), F.col("_top").alias("h")
    )
    above = stored(paths(stored(blocks, "merkle-blocks"), arity, top), "merkle-paths")
    own = _down(climbed.drop("_top"), arity, levels)
    rest = above.select("g", F.col("pos").alias("block"), "root", F.col("path").alias("_rest"))
    return own.join(rest, ["g", "block"]).withColumn("path", F.concat("path", "_rest")).drop("_rest", "block")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    """H of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def manifest(
    rows: DataFrame, columns: Sequence[str], group: str, order: str, arity: int = 2, also: dict[str, Column] | None = None,
) -> DataFrame:
    """(order, group, leaf, subroot, root, path) of every row: the digest of ``columns``, the roots of its group and of all, and its
    inclusion proof. ``also`` adds columns that are computed from a row before only digests move on."""
    if arity < 2:
        raise ValueError("a node has two children at least")
    named = {"id": F.col(order), "grp": F.col(group), "g": group_key(F.col(group)), "h": leaf_digest([F.col(c) for c in columns])}
    leaves = stored(rows.select(*(c.alias(n) for n, c in {**named, **(also or {})}.items())), "merkle-leaves")

    def whole(subroots: DataFrame) -> DataFrame:
        single = subroots.select(F.lit("").alias("g"), F.col("g").alias("name"), "h")
        above = paths(placed(single, ["name", "h"]), arity)
        # The group's own digest goes along, as the root of its tree.
        return above.select(F.col("name").alias("g"), F.struct(F.col("h").alias("subroot"), "root").alias("root"), "path")

    found = paths(placed(leaves, ["id", "h"]), arity, whole)
    return found.select(
        F.col("id").alias(order), F.col("grp").alias(group), F.col("h").alias("leaf"), F.col("root.subroot").alias("subroot"),
        F.col("root.root").alias("root"), "path", *(also or {}),
    )


def audit(rows: DataFrame, proofs: DataFrame, columns: Sequence[str], order: str) -> DataFrame:
    """(order, leaf, n_now, n_then, proven) of every leaf that is in the table now or was in its manifest.

    ``proofs`` is a `manifest` as it was stored, with ``path`` and the ``root`` that is trusted. A row that is as it was has equal counts; a
    changed one shows as two leaves, of which one was and one is; ``proven`` tells whether the stored path leads from the leaf to the root.
    """
    now = rows.select(F.col(order).alias("_id"), leaf_digest([F.col(c) for c in columns]).alias("_leaf")).groupBy("_id", "_leaf").agg(F.count(F.lit(1)).alias("n_now"))
    then = proofs.select(F.col(order).alias("_at"), "leaf", (folded(F.col("leaf"), F.col("path")) == F.col("root")).alias("ok"))
    then = then.groupBy("_at", "leaf").agg(F.count(F.lit(1)).alias("n_then"), F.min("ok").alias("proven"))
    # The digest holds the order value, so equal leaves have equal ids.
    return now.join(then, F.col("_leaf") == F.col("leaf"), "full_outer").select(
        F.when(F.col("leaf").isNull(), F.col("_id")).otherwise(F.col("_at")).alias(order), F.coalesce("leaf", "_leaf").alias("leaf"),
        F.coalesce("n_now", F.lit(0)).cast("bigint").alias("n_now"), F.coalesce("n_then", F.lit(0)).cast("bigint").alias("n_then"), "proven",
    )
