"""Hard-negative mining on exact integer scores, multiplied tile by tile with Strassen's recursion.

A vector's components become floor(``scale`` * x), and a score is the integer inner product of two of them. Candidates are dealt by hash into tiles of
about ``TILE_ROWS`` rows and anchors into blocks of about ``BLOCK_ROWS``; a task multiplies one block, ``STEP_ROWS`` anchors at a time, with one tile, both
int64, padded with zeros to sides that halve evenly, by seven products of quarters a level instead of eight. Additions are integer additions, exact also where an intermediate
wraps around; a product at the end of the recursion is taken in double precision only where its operands prove that every
partial sum stays below 2**53, else in int64. So all scores are exact.

Two passes. The first multiplies an anchor with the tiles of its own label and keeps the best ``positives`` of each tile; the best
of the tiles' bests are the anchor's positives. The second multiplies it with all tiles; of each tile it keeps, per positive, the best
``negatives`` of other labels whose score lies in the positive's window, low to high per cent of its score. Both heaps merge: the best k of
all are among the best k of each tile, and `row_number` cuts them in every task before they move.

Tiles are dealt by hash of the row, so a label, or a group of equal vectors, with a third of all rows is a third of the tiles. The work is
anchors x rows, a stated set of anchors against all rows in blocks.

Defined cases: rows whose label, id or vector is null, or with a null or non-finite component, take no part; shorter vectors count as filled up with
zeros; repeated rows, and rows that share an id, are rows of their own, so a row is never its own positive, its copy may be; ties go to the
smaller id, then the smaller label, then the vector's hash; an anchor without positives, or a positive with an empty window, gives no rows; an empty table
gives none; components so large that a score could leave the range of exact window tests (about 9e16) raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sftlake.llm.common import stored

TILE_ROWS = 4096
BLOCK_ROWS = 4096
#: Anchors of a block that are multiplied with a tile at once.
STEP_ROWS = 256
#: The recursion ends where a side would fall below this.
LEAF_SIDE = 16
#: Scores stay below this, so that a hundred times a score is an int64.
MOST = (1 << 63) // 100


def _base(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two tiles at the end of the recursion, exact."""
    if a.size and b.size:
        reach = float(np.abs(a.astype(np.float64)).max()) * float(np.abs(b.astype(np.float64)).max()) * a.shape[1]
        if reach < 1 << 53:
            return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def _halves(a: np.ndarray) -> tuple[np.ndarray, ...]:
    m, k = a.shape[0] // 2, a.shape[1] // 2
    return a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]


def _recurse(a: np.ndarray, b: np.ndarray, levels: int) -> np.ndarray:
    if not levels:
        return _base(a, b)
    a11, a12, a21, a22 = _halves(a)
    b11, b12, b21, b22 = _halves(b)
    m1 = _recurse(a11 + a22, b11 + b22, levels - 1)
    m2 = _recurse(a21 + a22, b11, levels - 1)
    m3 = _recurse(a11, b12 - b22, levels - 1)
    m4 = _recurse(a22, b21 - b11, levels - 1)
    m5 = _recurse(a11 + a12, b22, levels - 1)
    m6 = _recurse(a21 - a11, b11 + b12, levels - 1)
    m7 = _recurse(a12 - a22, b21 + b22, levels - 1)
    out = np.empty((a.shape[0], b.shape[1]), np.int64)
    c11, c12, c21, c22 = _halves(out)
    c11[:] = m1 + m4
    c11 += m7 - m5
    c12[:] = m3 + m5
    c21[:] = m2 + m4
    c22[:] = m1 - m2
    c22 += m3 + m6
    return out


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF_SIDE) -> np.ndarray:
    """``a @ b`` of int64 matrices of any shape, modulo 2**64 like int64 itself."""
    levels, side = 0, min(*a.shape, b.shape[1])
    while side >= 2 * leaf:
        levels, side = levels + 1, side // 2
    unit = 1 << levels
    m, k, n = (-(-s // unit) * unit for s in (*a.shape, b.shape[1]))
    wide_a, wide_b = np.zeros((m, k), np.int64), np.zeros((k, n), np.int64)
    wide_a[: a.shape[0], : a.shape[1]], wide_b[: b.shape[0], : b.shape[1]] = a, b
    return _recurse(wide_a, wide_b, levels)[: a.shape[0], : b.shape[1]]


def usable_rows(df: DataFrame, vec_id: str, vector: str, label: Column, scale: float) -> DataFrame:
    """(id, label, v) of the rows that take part, components as integers."""
    rows = df.select(F.col(vec_id).cast("bigint").alias("id"), label.cast("bigint").alias("label"), F.col(vector).cast("array<double>").alias("x"))
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    least = F.coalesce(F.array_min(F.transform("x", lambda x: F.floor(F.lit(scale) * x))).cast("double"), F.lit(0.0))
    most = F.coalesce(F.array_max(F.transform("x", lambda x: F.floor(F.lit(scale) * x))).cast("double"), F.lit(0.0))
    reach = F.greatest(F.abs(least), F.abs(most))
    safe = F.when(reach * reach * F.greatest(F.size("x"), F.lit(1)) < F.lit(float(MOST)), F.col("x")).otherwise(
        F.raise_error(F.lit("components too large for exact scores"))
    )
    return rows.select("id", "label", F.transform(safe, lambda x: F.floor(F.lit(scale) * x).cast("bigint")).alias("v"))


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    """A row for each vector, filled up with zeros."""
    out = np.zeros((table.num_rows, width), np.int64)
    column = table.column("v").combine_chunks()
    if table.num_rows:
        sizes = column.value_lengths().to_numpy()
        row = np.repeat(np.arange(table.num_rows), sizes)
        at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[row, at] = column.flatten().to_numpy()
    return out


def _ints(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy()


class _Tile:
    """Candidates of one tile in tie order."""

    def __init__(self, rows: pa.Table, anchors: pa.Table):
        order = np.lexsort((_ints(rows, "tie"), _ints(rows, "label"), _ints(rows, "id")))
        rows = rows.take(pa.array(order))
        self.width = max([1, *(int(t.column("v").combine_chunks().value_lengths().to_numpy().max()) for t in (rows, anchors) if t.num_rows)])
        self.uid, self.id, self.label, self.tie = (_ints(rows, c) for c in ("uid", "id", "label", "tie"))
        self.matrix = np.ascontiguousarray(_matrix(rows, self.width).T)

    def scored(self, anchors: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
        """Each anchor with its scores, a step of anchors being multiplied at once."""
        for lo in range(0, anchors.num_rows, STEP_ROWS):
            for i, scores in enumerate(strassen(_matrix(anchors.slice(lo, STEP_ROWS), self.width), self.matrix), lo):
                yield i, scores


def _descending(scores: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Allowed candidates by score, best first, ties in tie order; and their scores."""
    at = np.flatnonzero(allowed)
    at = at[np.argsort(-scores[at], kind="stable")]
    return at, scores[at]


POSITIVE = "anchor bigint, uid bigint, id bigint, label bigint, tie bigint, score bigint"
NEGATIVE = "anchor bigint, anchor_id bigint, nth int, positive_id bigint, positive_score bigint, id bigint, label bigint, tie bigint, score bigint"


def _table(parts: list[tuple], schema: str) -> pa.Table:
    names, types = zip(*(f.strip().split() for f in schema.split(",")))
    kinds = [pa.int32() if t == "int" else pa.int64() for t in types]
    columns = [np.concatenate([np.atleast_1d(p[i]) for p in parts]) if parts else [] for i in range(len(names))]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names))


def _best_positives(k: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and anchors.num_rows:
            tile = _Tile(rows, anchors)
            uids = _ints(anchors, "uid")
            for i, scores in tile.scored(anchors):
                at, score = _descending(scores, tile.uid != uids[i])
                at, score = at[:k], score[:k]
                out.append((np.full(len(at), uids[i]), tile.uid[at], tile.id[at], tile.label[at], tile.tie[at], score))
        return _table(out, POSITIVE)

    return run


def _best_negatives(k: int, low: int, high: int):
    def run(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = []
        if rows.num_rows and anchors.num_rows:
            tile = _Tile(rows, anchors)
            ids, labels, uids = (_ints(anchors, c) for c in ("id", "label", "uid"))
            heaps = anchors.column("positives").to_pylist()
            for i, scores in tile.scored(anchors):
                at, score = _descending(scores, tile.label != labels[i])
                for nth, p in enumerate(heaps[i]):
                    # low * p <= 100 * s <= high * p, as whole numbers
                    most, least = high * p["score"] // 100, -(-low * p["score"] // 100)
                    lo = np.searchsorted(-score, -most, "left")
                    hi = np.searchsorted(-score, -least, "right")
                    own = at[lo : min(hi, lo + k)]
                    n = len(own)
                    if n:
                        out.append((
                            np.full(n, uids[i]), np.full(n, ids[i]), np.full(n, nth), np.full(n, p["id"]), np.full(n, p["score"]),
                            tile.id[own], tile.label[own], tile.tie[own], score[lo : lo + n],
                        ))
        return _table(out, NEGATIVE)

    return run


def _every(n: int | Column) -> Column:
    return F.explode(F.sequence(F.lit(0), (F.lit(n) if isinstance(n, int) else n) - F.lit(1)))


def _renamed(df: DataFrame) -> DataFrame:
    """The frame with columns of its own, which a join with its source can tell apart."""
    return df.select(*(F.col(c).alias(c) for c in df.columns))


def hard_negatives(
    df: DataFrame, is_anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: Column | str = "label", positives: int = 5,
    negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0, tile_rows: int | None = None, block_rows: int | None = None,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every row that meets ``is_anchor`` (a condition on ``id``)
    and each of its ``positives`` nearest rows of the same label, the ``negatives`` nearest rows of other labels whose score is ``low`` to ``high`` per cent
    of the positive's."""
    tile_rows, block_rows = tile_rows or TILE_ROWS, block_rows or BLOCK_ROWS
    label = F.col(label) if isinstance(label, str) else label
    rows = usable_rows(df, vec_id, vector, label, scale).withColumns({"tie": F.xxhash64("v"), "uid": F.monotonically_increasing_id()})
    rows = stored(rows, "negatives-rows")
    n, asked = rows.agg(F.count(F.lit(1)), F.count_if(is_anchor)).first()
    tiles, blocks = max(1, -(-n // tile_rows)), max(1, -(-asked // block_rows))
    dealt = F.xxhash64("uid")
    block = F.pmod(F.xxhash64(F.lit(3), "uid"), F.lit(blocks)).cast("int")
    anchors = rows.where(is_anchor)

    sizes = rows.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile_rows)).cast("int").alias("tiles"))
    own = F.pmod(dealt, F.col("tiles")).cast("int").alias("tile")
    same = rows.join(sizes, "label").select("label", own, _every(blocks).alias("block"), "uid", "id", "tie", "v")
    searching = _renamed(anchors).join(_renamed(sizes), "label").select("label", _every(F.col("tiles")).alias("tile"), block.alias("block"), "uid", "v")
    keys = ["label", "tile", "block"]
    found = same.groupBy(*keys).cogroup(searching.groupBy(*keys)).applyInArrow(_best_positives(positives), POSITIVE)
    first = F.row_number().over(W.partitionBy("anchor").orderBy(F.desc("score"), "id", "label", "tie", "uid"))
    best = found.withColumn("nth", first).where(F.col("nth") <= positives)
    heaps = best.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("nth", "id", "score"))).alias("positives"))
    mined = stored(anchors.join(heaps, F.col("uid") == F.col("anchor")).drop("anchor"), "negatives-positives")

    everything = rows.select(F.pmod(dealt, F.lit(tiles)).cast("int").alias("tile"), _every(blocks).alias("block"), "uid", "id", "label", "tie", "v")
    searching = _renamed(mined).select(_every(tiles).alias("tile"), block.alias("block"), "uid", "id", "label", "v", "positives")
    keys = ["tile", "block"]
    found = everything.groupBy(*keys).cogroup(searching.groupBy(*keys)).applyInArrow(_best_negatives(negatives, low, high), NEGATIVE)
    rank = F.row_number().over(W.partitionBy("anchor", "nth").orderBy(F.desc("score"), "id", "label", "tie"))
    return found.withColumn("rank", rank).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
