"""Approximate nearest neighbours by a hash-prefix forest.

Vectors are dealt by hash into shards of about ``SHARD_ROWS`` rows. Each shard has ``TREES`` trees; a tree is the sorted array
of its vectors' hash strings (``BITS`` signs of projections, centred at medians). A query descends every tree of every shard by binary search to
the longest prefix that it shares with stored strings, and then ascends in all trees at once, one bit a step; at each
step the stored strings that share the prefix form one range per tree. It stops when the union of the ranges holds ``share`` of
the shard and scores all of the union exactly. The best of all shards are the answer. The share is the same at every size.

Inner products are turned into angles by one more coordinate, sqrt(M^2 - |x|^2) with the greatest norm M, which is 0 for
queries; for vectors of one length nothing changes. Projections' medians come from a bounded sample (``FIT_ROWS`` rows, the first by hash);
every vector is indexed. Dealing by hash spreads a group of equal or close vectors over all shards. Queries go to the
shards in blocks of ``QUERY_ROWS``: a task holds one shard and one block, whatever the sizes of the tables. Each query
looks at ``share`` of the rows: in data without neighbours that stand out, as random vectors, recall costs that much.

Defined cases: vectors that are null, zero, or hold null or non-finite components, or whose id is null, take no part; nor do vectors
of another length than the most frequent one; an id is one vector, of several the first by hash; a query's own id is no candidate of it; equal scores go to the smaller id; with
fewer candidates than asked for, all found are returned; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sftlake.llm.common import stored

TREES, BITS = 64, 24
SHARD_ROWS = 4096
QUERY_ROWS = 4096
FIT_ROWS = 4096
SHARE = 0.45
RESULT = "query_id bigint, vec_id bigint, score double"


def valid_vectors(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, v): the rows that take part, one per id."""
    rows = df.select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("id").isNotNull() & F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False)))
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    rows = rows.where(F.size("v") == (sizes[0]["size"] if sizes else 0))
    return rows.groupBy("id").agg(F.min_by("v", F.struct(F.xxhash64("v"), "v")).alias("v"))


class Projections:
    """Hash strings of vectors: per tree ``BITS`` signs of random projections about their medians."""

    def __init__(self, sample: np.ndarray, norm: float, trees: int = TREES, bits: int = BITS, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.norm, self.trees, self.bits = norm, trees, bits
        self.directions = rng.standard_normal((sample.shape[1] + 1, trees * bits))
        self.medians = np.median(self.lifted(sample) @ self.directions, axis=0) if len(sample) else np.zeros(trees * bits)

    def lifted(self, x: np.ndarray) -> np.ndarray:
        room = np.sqrt(np.maximum(self.norm**2 - (x * x).sum(axis=1), 0))
        return np.concatenate([x, room[:, None]], axis=1)

    def codes(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """(tree, row) codes, the first bit of the string highest."""
        if query:  # scaled to the data's length, with no last coordinate
            x = x * (self.norm / np.maximum(np.sqrt((x * x).sum(axis=1)), 1e-300))[:, None]
            wide = np.concatenate([x, np.zeros((len(x), 1))], axis=1)
        else:
            wide = self.lifted(x)
        signs = (wide @ self.directions > self.medians).reshape(len(x), self.trees, self.bits)
        return (signs @ (1 << np.arange(self.bits - 1, -1, -1)).astype(np.int64)).T.copy()


class Forest:
    """The sorted arrays of one shard."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projections: Projections):
        self.ids, self.vectors, self.projections = ids, vectors, projections
        codes = projections.codes(vectors)
        self.order = np.argsort(codes, axis=1, kind="stable")
        self.sorted = np.take_along_axis(codes, self.order, axis=1)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, wanted: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Query ids, found ids and exact scores of the ``k`` best of at least ``wanted`` candidates of each query in this shard."""
        p, n = self.projections, len(self.ids)
        codes = p.codes(queries, query=True)
        # Ranges of strings that share the first `level` bits, for every tree and query.
        low = np.empty((p.bits + 1, p.trees, len(queries)), np.int32)
        high = np.empty_like(low)
        for t in range(p.trees):
            for level in range(p.bits + 1):
                rest = p.bits - level
                base = (codes[t] >> rest) << rest
                low[level, t] = np.searchsorted(self.sorted[t], base, "left")
                high[level, t] = np.searchsorted(self.sorted[t], base + (1 << rest), "left")
        reach = (high - low).sum(axis=1)  # candidates of all trees, those of several trees counted for each
        wanted = min(n, wanted + k)
        for q in range(len(queries)):
            level = int(np.flatnonzero(reach[:, q] >= wanted)[-1])
            while True:
                seen = np.zeros(n, bool)
                for order, a, b in zip(self.order, low[level, :, q].tolist(), high[level, :, q].tolist()):
                    seen[order[a:b]] = True
                if level == 0 or np.count_nonzero(seen) >= wanted:
                    break
                level -= 1
            seen[self.ids == query_ids[q]] = False
            at = np.flatnonzero(seen)
            # A row-wise sum gives equal vectors equal scores, wherever they are stored.
            score = (self.vectors[at] * queries[q]).sum(axis=1)
            if len(at) > k:
                keep = score >= np.partition(score, len(at) - k)[len(at) - k]
                at, score = at[keep], score[keep]
            best = np.lexsort((self.ids[at], -score))[:k]
            yield np.full(len(best), query_ids[q]), self.ids[at[best]], score[best]


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(rows, -1) if rows else np.empty((0, 0))


def nearest(
    df: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding", k: int = 20, share: float = SHARE,
    shard_rows: int = SHARD_ROWS, trees: int = TREES, bits: int = BITS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row that meets ``is_query`` (a condition on ``id``), among
    all other rows, by inner product in double precision."""
    spark = df.sparkSession
    rows = stored(valid_vectors(df, vec_id, vector), "vectors")
    n, queries, norm = rows.agg(
        F.count(F.lit(1)), F.count_if(is_query), F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))
    ).first()
    sample = rows.orderBy(F.xxhash64(F.lit(5), "id"), "id").limit(FIT_ROWS).select("v").toArrow()
    sent = spark.sparkContext.broadcast(Projections(_matrix(sample.column("v"), sample.num_rows), norm or 0.0, trees, bits))
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-queries // QUERY_ROWS))

    def run(index: pa.Table, asked: pa.Table) -> pa.Table:
        out = []
        if index.num_rows and asked.num_rows:
            forest = Forest(index.column("id").to_numpy(), _matrix(index.column("v"), index.num_rows), sent.value)
            wanted = math.ceil(share * index.num_rows)
            for lo in range(0, asked.num_rows, 256):
                part = asked.slice(lo, 256)
                out += forest.search(part.column("id").to_numpy(), _matrix(part.column("v"), part.num_rows), k, wanted)
        joined = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        return pa.table([pa.array(c) for c in joined], names=["query_id", "vec_id", "score"])

    hashed = F.pmod(F.xxhash64("id", "v"), F.lit(shards))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    index = rows.select(hashed.cast("int").alias("shard"), every(blocks).alias("block"), "id", "v")
    asked = rows.where(is_query).select(every(shards).alias("shard"), F.pmod(F.xxhash64(F.lit(9), "id"), F.lit(blocks)).cast("int").alias("block"), "id", "v")
    found = index.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInArrow(run, RESULT)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
