"""Line dedup on range-partitioned hashes.

Every line of every document becomes (128-bit key hash, document, position). The rows are partitioned by
ranges of (hash, document) and sorted by (hash, document, position) inside; a stream over each partition
sees the lines of a key together, documents in order, and decides. A key with a third of all lines spreads
over as many partitions as its rows fill, because the document is part of the range key. Only a
partition's first and last key can continue elsewhere; their counts (two per partition) are added up, and
their undecided lines wait for the sum. No text moves with the lines. The result is one zlib-compressed
bitmap per document with a bit per line, most significant first, 1 for a line that stays.

A document is told by its key columns and a 64-bit hash of its text, so an id given twice with different
texts is two documents, and equal rows share one bitmap. A null or empty text is one empty line.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftlake.llm.common import LOWER, SPACES, UPPER, sliced, stored, utf8

#: kind 0: line to drop; 1: line that waits for its key's sum; 2: a key's first line and number of documents in one partition.
EVENT = "kind tinyint, h1 bigint, h2 bigint, doc bigint, uid bigint, pos int, n bigint"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_rows(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """(h1, h2, doc, uid, pos) of every line whose key has at least ``min_chars`` code points."""
    lines = docs.select(
        F.col(doc_id).cast("bigint").alias("doc"), F.xxhash64(text).alias("uid"),
        F.posexplode(text_lines(F.col(text))).alias("pos", "line"),
    ).select("doc", "uid", "pos", line_key(F.col("line")).alias("key"))
    return lines.where(F.length("key") >= min_chars).select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(17), "key").alias("h2"), "doc", "uid", "pos"
    )


def _nulls_low(column: pa.Array) -> np.ndarray:
    """Ids as integers; a null id takes the place that the sort gives it, before all others."""
    return column.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)


class _Runs:
    """Decides the lines of one sorted partition, key by key, holding fewer than ``least`` documents' lines."""

    def __init__(self, least: int, keep_first: bool):
        self.least, self.keep_first = least, keep_first
        self.key = None
        self.first_key = True
        self.out: list[tuple[np.ndarray, ...]] = []

    def _emit(self, kind: int, rows: list[np.ndarray]) -> None:
        if rows:
            self.out.append((kind, np.concatenate(rows)))

    def feed(self, rows: np.ndarray) -> None:
        """Rows of columns h1, h2, doc, uid, pos (and null marks) in order."""
        change = np.flatnonzero((rows["h1"][1:] != rows["h1"][:-1]) | (rows["h2"][1:] != rows["h2"][:-1])) + 1
        for part in np.split(rows, change):
            key = (int(part["h1"][0]), int(part["h2"][0]))
            if key != self.key:
                self.close(last=False)
                self.key, self.n, self.doc, self.held, self.seen, self.begin = key, 0, None, [], False, part[:1]
            fresh = (part["doc"][1:] != part["doc"][:-1]) | (part["uid"][1:] != part["uid"][:-1])
            begins = (int(part["doc"][0]), int(part["uid"][0])) != self.doc
            self.n += int(fresh.sum()) + begins
            self.doc = (int(part["doc"][-1]), int(part["uid"][-1]))
            self.held.append(part)
            if self.n >= self.least:
                self._decide()

    def _decide(self) -> None:
        """The key has enough documents here: what is held goes."""
        rows = np.concatenate(self.held)
        self.held = []
        if self.keep_first and not self.seen and len(rows):
            # The first occurrence of a partition's first key may not be the first of all.
            if self.first_key:
                self._emit(1, [rows[:1]])
            rows = rows[1:]
        self.seen = True
        self._emit(0, [rows])

    def close(self, last: bool) -> None:
        if self.key is None:
            return
        if self.first_key or last:
            self._emit(1, self.held)
            self.out.append((2, self.begin, self.n))
        self.first_key = False


ROW = np.dtype([("h1", "i8"), ("h2", "i8"), ("doc", "i8"), ("uid", "i8"), ("pos", "i4"), ("null", "?")])


def _decider(least: int, keep_first: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = _Runs(least, keep_first)

        def flush() -> Iterator[pa.RecordBatch]:
            for kind, r, *n in runs.out:
                size = len(r)
                arrays = [
                    pa.array(np.full(size, kind, np.int8)), pa.array(r["h1"]), pa.array(r["h2"]), pa.array(r["doc"], mask=r["null"]),
                    pa.array(r["uid"]), pa.array(r["pos"]), pa.array(n, pa.int64()) if n else pa.nulls(size, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=NAMES)
            runs.out = []

        for batch in sliced(batches, 1 << 16):
            if batch.num_rows:
                rows = np.empty(batch.num_rows, ROW)
                for name in ("h1", "h2", "uid", "pos"):
                    rows[name] = batch.column(name).to_numpy(zero_copy_only=False)
                rows["doc"], rows["null"] = _nulls_low(batch.column("doc")), batch.column("doc").is_null().to_numpy(zero_copy_only=False)
                runs.feed(rows)
                yield from flush()
        runs.close(last=True)
        yield from flush()

    return run


NAMES = [f.split()[0] for f in EVENT.split(", ")]


@F.pandas_udf(T.BinaryType())
def keep_bitmap(dropped: pd.Series, n_lines: pd.Series) -> pd.Series:
    """zlib-compressed bits, one per line, 1 for a line that stays; filled up to whole bytes with 1."""

    def one(positions, n: int) -> bytes:
        bits = np.ones(-(-int(n) // 8) * 8, np.uint8)
        if positions is not None:
            bits[np.asarray(positions, np.int64)] = 0
        return zlib.compress(np.packbits(bits).tobytes(), 6)

    return pd.Series([one(p, n) for p, n in zip(dropped, n_lines)])


def bitmap_bits(bitmap: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).view(bool)


def repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_docs: int = 2, min_chars: int = 1,
    keep: str = "first",
) -> DataFrame:
    """(doc, uid, dropped positions) of the documents that lose lines.

    A key counts when it is in at least ``min_docs`` documents. ``keep="first"`` leaves its first
    occurrence (smallest document, then position), ``keep="none"`` drops all of them. With
    ``min_docs=1`` and ``keep="first"`` repeats within one document go too.
    """
    if keep not in ("first", "none"):
        raise ValueError("keep is 'first' or 'none'")
    rows = stored(line_rows(docs, doc_id, text, min_chars), "lines")  # range bounds look at them too: texts are split once
    ranged = rows.repartitionByRange("h1", "h2", "doc", "uid").sortWithinPartitions("h1", "h2", "doc", "uid", "pos")
    events = stored(ranged.mapInArrow(_decider(min_docs, keep == "first"), EVENT), "line-events")
    # At most two rows per partition, and the keys they name.
    edge = events.where("kind = 2").groupBy("h1", "h2").agg(F.sum("n").alias("total"), F.min(F.struct("doc", "uid", "pos")).alias("first"))
    waiting = events.where("kind = 1").join(edge.where(F.col("total") >= min_docs), ["h1", "h2"])
    if keep == "first":
        waiting = waiting.where(F.struct("doc", "uid", "pos") > F.col("first"))
    gone = events.where("kind = 0").select("doc", "uid", "pos").unionByName(waiting.select("doc", "uid", "pos"))
    return gone.groupBy("doc", "uid").agg(F.array_sort(F.collect_set("pos")).alias("dropped"))


def line_bitmaps_of_losers(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(doc, uid, bitmap) of the documents that lose lines, one row per distinct (id, text). Lines after
    the last dropped one have no bit: they stay."""
    lost = repeated_lines(docs, doc_id, text, **options)
    return lost.select("doc", F.col("uid").alias("text_hash"), keep_bitmap("dropped", F.element_at("dropped", -1) + F.lit(1)).alias("bitmap"))


def line_bitmaps(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(doc_id, n_lines, n_dropped, bitmap) of every row, without its text; a bit for every line."""
    lost = repeated_lines(docs, doc_id, text, **options).withColumnRenamed("uid", "text_hash")
    sized = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("uid"),
        F.size(text_lines(F.col(text))).cast("bigint").alias("n_lines"),
    )
    return sized.join(lost, sized["doc_id"].eqNullSafe(lost["doc"]) & (sized["uid"] == lost["text_hash"]), "left").select(
        "doc_id", "n_lines", F.coalesce(F.array_size("dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
        keep_bitmap("dropped", "n_lines").alias("bitmap"),
    )


def _apply(text: bytes | None, bitmap: bytes | None) -> tuple[int, int, bytes]:
    text = text or b""
    if bitmap is None:
        return text.count(b"\n") + 1, 0, text
    parts = text.split(b"\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))[: len(parts)]
    gone = set(np.flatnonzero(bits == 0).tolist())
    kept = b"\n".join(p for i, p in enumerate(parts) if i not in gone)
    return len(parts), len(gone), kept


@F.arrow_udf(T.StructType().add("n_lines", "long").add("n_dropped", "long").add("kept_sha256", "string"))
def applied_digest(text: pa.Array, bitmap: pa.Array) -> pa.Array:
    """Lines before, lines dropped, and the SHA-256 of the lines that stay, joined by newlines."""
    found = [_apply(t, b) for t, b in zip(utf8(text), bitmap.to_pylist())]
    return pa.StructArray.from_arrays(
        [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
         pa.array([hashlib.sha256(f[2]).hexdigest() for f in found], pa.string())],
        names=["n_lines", "n_dropped", "kept_sha256"],
    )


@F.arrow_udf(T.StringType())
def applied_text(text: pa.Array, bitmap: pa.Array) -> pa.Array:
    """The lines that stay, joined by newlines."""
    return pa.array([_apply(t, b)[2].decode("utf-8", "replace") for t, b in zip(utf8(text), bitmap.to_pylist())], pa.string())
