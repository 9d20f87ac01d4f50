"""Repeated passages removed by longest-previous-factor arrays.

Every byte that a string of ``need`` bytes covers goes, if that string also starts earlier: in a document of smaller (id, hash of the text),
or in the same document further ahead. The first copy stays. Strings are judged on the input, and never cross documents.

The longest previous factor of a position is the longest string there that also starts earlier. In suffix order the earlier start it is
shared with longest is the nearest suffix before or the nearest behind that has a smaller position: previous and next smaller positions, found for all positions
at once by pointer jumping. Suffixes are ordered by prefix doubling, and the doubling's ranks give the lengths.

No suffix array over all texts is needed, since equal strings are brought together first:

1. Windows of ``need`` bytes that follow one another share their anchor, the ``ANCHOR`` bytes of least hash in them, and make up a fragment (some 32
   windows). Equal windows have equal anchors, so a window's copies lie in fragments of the same anchor only.
2. Anchors that occur once are left out. A batch of documents (about ``BATCH_BYTES``) names each anchor once, so a frequent one is as many
   rows as there are batches.
3. Fragments of an anchor that are equal as a whole are one class, told by two 64-bit hashes: all but its first are later copies in all their windows.
4. Anchors with several classes get suffix arrays over the bytes of each class's first fragment; in this order, (document, place), the fragments' starts
   ascend, so a smaller position is an earlier start. An anchor of more than ``GROUP_FRAGMENTS`` fragments is dealt over several
   arrays by class; windows without an earlier copy in their own array are then compared by two 64-bit hashes across those.
5. Removed windows return to their documents.

Texts move once, dealt by batch, and that exchange serves all steps. Nothing is gathered per anchor, passage or class of copies beyond the bounds above.

Defined cases: a null text is empty; texts shorter than ``need`` lose nothing; documents of equal id are ordered by a hash of their text, null ids come first; rows of
equal id and text are one document and get the same result; texts of any length are worked through in pieces of ``PIECE``
bytes; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from sftlake.llm.common import mix64, utf8

NEED = 100
ANCHOR = 32
PIECE = 1 << 20
BATCH_BYTES = 4 << 20
GROUP_FRAGMENTS = 4096
#: Positions of one suffix array; anchors are kept together.
ARRAY_BYTES = 1 << 20
_PLACE = np.uint64((1 << 23) - 1)


def _u(x: int) -> np.uint64:
    return np.uint64(x)


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring strings from theirs."""
    x = a ^ (a >> _u(32))
    x *= _u(0x9E3779B97F4A7C15)
    x += b * _u(0xC2B2AE3D27D4EB4F)
    x ^= x >> _u(29)
    return x


def anchor_hashes(raw: np.ndarray) -> np.ndarray:
    """Hash of the ``ANCHOR`` (32) bytes from each position on."""
    x = raw.astype(np.uint64)
    for k in (1, 2, 4):
        x = (x[:-k] << _u(8 * k)) | x[k:]  # eight bytes as one number
    for k in (8, 16):
        x = _joined(x[:-k], x[k:])
    return x


def _slid_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each ``width`` neighbours."""
    k = 1
    while 2 * k <= width:
        x = np.minimum(x[:-k], x[k:])
        k *= 2
    return x if k == width else np.minimum(x[: len(x) - (width - k)], x[width - k :])


def _pieces(texts: list[bytes], need: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Lists of (text, offset, bytes), each of about ``PIECE`` bytes. A long text's pieces overlap so that each window lies in one."""
    held, size = [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(len(t) - need + 1, 0), PIECE):
            own = t[at : at + PIECE + need - 1]
            if held and size + len(own) > PIECE + need:
                yield held
                held, size = [], 0
            held.append((i, at, own))
            size += len(own)
    if held:
        yield held


def _windows_hash(hashes: np.ndarray, at: np.ndarray, need: int, salt: int) -> np.ndarray:
    """Hash of the ``need`` bytes from each of some positions on, from the anchors' hashes that cover them."""
    x = np.full(len(at), salt, np.uint64)
    for k in sorted({*range(0, need - ANCHOR + 1, ANCHOR), need - ANCHOR}):
        x = mix64(_joined(x, hashes[at + k]))
    return x


FRAGMENT = np.dtype([("h", "i8"), ("f", "i8"), ("text", "i8"), ("start", "i8"), ("windows", "i8")])


def fragments(texts: list[bytes], need: int) -> np.ndarray:
    """Fragments of texts: anchor hash h, class f, text, start, and number of windows, in order of text and start."""
    out = []
    for piece in _pieces(texts, need):
        sizes = np.array([len(b) for *_, b in piece])
        offset = np.cumsum(sizes) - sizes
        hashes = anchor_hashes(np.frombuffer(b"".join(b for *_, b in piece), np.uint8))
        keys = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)  # the leftmost of equal hashes
        least = _slid_minimum(keys, need - ANCHOR + 1)
        windows = sizes - need + 1
        own = np.repeat(np.arange(len(piece)), windows)
        at = np.arange(len(own)) + np.repeat(offset - (np.cumsum(windows) - windows), windows)
        anchor = (least[at] & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (own[1:] != own[:-1]))))
        count = np.diff(np.concatenate((first, [len(own)])))
        start, anchor, own = at[first], anchor[first], own[first]
        f = _windows_hash(hashes, start, need, 1) ^ (mix64(_windows_hash(hashes, start + count - 1, need, 2)) + (anchor - start).astype(np.uint64))
        rows = np.empty(len(first), FRAGMENT)
        rows["h"], rows["f"] = hashes[anchor].view(np.int64), mix64(f + count.astype(np.uint64)).view(np.int64)
        rows["text"] = np.array([i for i, *_ in piece])[own]
        rows["start"] = start - offset[own] + np.array([a for _, a, _ in piece])[own]
        rows["windows"] = count
        out.append(rows)
    return np.concatenate(out) if out else np.empty(0, FRAGMENT)


# ---------------------------------------------------------------- suffix order


def smaller_before(order: np.ndarray) -> np.ndarray:
    """For each place in ``order``, the nearest place before that holds a smaller value, or -1."""
    p = np.arange(len(order)) - 1
    todo = np.arange(len(order))
    while len(todo):
        at = p[todo]
        todo = todo[(at >= 0) & (order[np.maximum(at, 0)] > order[todo])]
        p[todo] = p[p[todo]]  # what lies between is larger still
    return p


class SuffixRanks:
    """Suffixes of strings laid end to end, ranked by their first 8, 16, 32, ... bytes, as far as ``need``; nothing reaches over a string's end."""

    def __init__(self, raw: np.ndarray, rest: np.ndarray, need: int):
        """``rest``: bytes from each position to the end of its string."""
        self.rest, self.need = rest, need
        word, self.levels = raw.astype(np.uint64), []
        for k in (1, 2, 4):
            self.levels.append((k, word))
            word = (word << _u(8 * k)) | self._ahead(word, k)
        # A string that ends within the word comes before one that goes on with zero bytes; without such bytes the word tells.
        rank, k = self._ranked(word, None if raw.all() else np.minimum(rest, 8).astype(np.uint8)), 8
        self.levels.append((k, rank))
        while 2 * k <= need:
            rank = self._ranked((rank << _u(32)) | self._ahead(rank, k))
            k *= 2
            self.levels.append((k, rank))
        self.key = (rank << _u(32)) | self._ahead(rank, need - k) if need > k else rank

    def _ahead(self, x: np.ndarray, k: int) -> np.ndarray:
        out = np.zeros_like(x)
        if k < len(x):
            out[:-k] = x[k:]
        out[self.rest <= k] = 0
        return out

    @staticmethod
    def _ranked(key: np.ndarray, size: np.ndarray | None = None) -> np.ndarray:
        """Ranks from 1 by key, then size; equal ones have equal ranks."""
        new = np.empty(len(key), np.uint64)
        if not len(key):
            return new
        if size is None:
            order = np.argsort(key)
            step = np.diff(key[order]) != 0
        else:
            order = np.argsort(size, kind="stable")
            order = order[np.argsort(key[order], kind="stable")]
            step = (np.diff(key[order]) != 0) | (np.diff(size[order]) != 0)
        new[order] = np.cumsum(np.concatenate(([True], step)))
        return new

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of pairs of suffixes, ``need`` at most."""
        a, b = a.copy(), b.copy()
        most = np.minimum(self.need, np.minimum(self.rest[a], self.rest[b]))
        got, last = np.zeros(len(a), np.int64), len(self.rest) - 1
        for k, rank in reversed(self.levels):
            same = (rank[np.minimum(a + got, last)] == rank[np.minimum(b + got, last)]) & (got < most)
            got[same] += k
        return np.minimum(got, most)


def _previous(sa: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (suffix, earlier suffix): for the places of a suffix order, the nearest smaller position before, then the nearest behind."""
    for near in (smaller_before(sa), len(sa) - 1 - smaller_before(sa[::-1])[::-1]):
        has = np.flatnonzero((near >= 0) & (near < len(sa)))
        yield sa[has], sa[near[has]]


def longest_previous_factors(raw: np.ndarray, rest: np.ndarray, need: int) -> np.ndarray:
    """Of each position, the length of the longest string there that also starts at a smaller one, ``need`` at most."""
    found = np.zeros(len(raw), np.int64)
    if len(raw):
        ranks = SuffixRanks(raw, rest, need)
        for here, earlier in _previous(np.argsort(ranks.key, kind="stable")):
            found[here] = np.maximum(found[here], ranks.common(here, earlier))
    return found


def previous_factor_reaches(raw: np.ndarray, rest: np.ndarray, need: int) -> np.ndarray:
    """Is a position's longest previous factor ``need`` long? Only positions with that much left can be, or be the earlier start."""
    found = np.zeros(len(raw), bool)
    at = np.flatnonzero(rest >= need)
    if len(at):
        key = SuffixRanks(raw, rest, need).key[at]  # equal for equal strings of ``need`` bytes
        for here, earlier in _previous(np.argsort(key, kind="stable")):
            found[at[here]] |= key[here] == key[earlier]
    return found


# ---------------------------------------------------------------- steps on Spark

ANCHORS = "h bigint, batch int, n bigint"
CLASSES = "h bigint, spread bigint, f bigint, doc bigint, th bigint, start bigint, windows bigint, batch int, later boolean, sub int"
BYTES = "h bigint, sub int, batch int, doc bigint, th bigint, start bigint, raw binary, hot boolean"
FOUND = "k1 bigint, k2 bigint, batch int, doc bigint, th bigint, start bigint, windows bigint, repeated boolean"
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start:bigint,stop:bigint>>"


class _Batch:
    """The distinct documents of a batch in order of (id, hash), null ids first."""

    def __init__(self, docs: pa.Table):
        ids, hashes = docs.column("doc").to_pylist(), docs.column("th").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, hashes[i]))
        self.row = [i for k, i in enumerate(order) if not k or (ids[i], hashes[i]) != (ids[order[k - 1]], hashes[order[k - 1]])]
        self.ids, self.hashes = [ids[i] for i in self.row], [hashes[i] for i in self.row]
        self.place = {k: i for i, k in enumerate(zip(self.ids, self.hashes))}
        texts = utf8(docs.column("text"))
        self.texts = [texts[i] or b"" for i in self.row]


def _first_of_each(values: np.ndarray) -> np.ndarray:
    """Marks the first occurrence of each value."""
    out = np.zeros(len(values), bool)
    out[np.unique(values, return_index=True)[1]] = True
    return out


def _name_anchors(need: int):
    def run(docs: pa.Table) -> pa.Table:
        h, n = np.unique(fragments(_Batch(docs).texts, need)["h"], return_counts=True)
        return pa.table([pa.array(h), pa.array(np.full(len(h), docs.column("batch")[0].as_py() if docs.num_rows else 0, np.int32)), pa.array(n)], names=["h", "batch", "n"])

    return run


def _name_classes(need: int, group: int):
    def run(docs: pa.Table, anchors: pa.Table) -> pa.Table:
        batch = _Batch(docs)
        rows = fragments(batch.texts, need) if anchors.num_rows else np.empty(0, FRAGMENT)
        known, total = (anchors.column(c).combine_chunks().to_numpy() for c in ("h", "total"))
        order = np.argsort(known)
        known, total = known[order], total[order]
        at = np.searchsorted(known, rows["h"])
        keep = (at < len(known)) & (known[np.minimum(at, max(len(known) - 1, 0))] == rows["h"]) if len(known) else np.zeros(0, bool)
        rows, total = rows[keep], total[at[keep]]
        hot = total > group
        later = ~_first_of_each(rows["h"].view(np.uint64) ^ mix64(rows["f"].view(np.uint64)))
        place = mix64(rows["start"].astype(np.uint64) + (rows["text"].astype(np.uint64) << _u(40)) + mix64(rows["h"].view(np.uint64)))
        # Fragments of an anchor meet; a hot anchor's only with those of their class; later copies of this batch with none.
        spread = np.where(later, place.view(np.int64), np.where(hot, rows["f"], 0))
        sub = np.where(hot, rows["f"].view(np.uint64) % -(-total // group).astype(np.uint64), 0).astype(np.int32) + hot
        text = rows["text"].tolist()
        columns = [
            pa.array(rows["h"]), pa.array(spread), pa.array(rows["f"]), pa.array([batch.ids[t] for t in text], pa.int64()),
            pa.array([batch.hashes[t] for t in text], pa.int64()), pa.array(rows["start"]), pa.array(rows["windows"]),
            pa.array(np.full(len(rows), docs.column("batch")[0].as_py() if docs.num_rows else 0, np.int32)), pa.array(later), pa.array(sub),
        ]
        return pa.table(columns, names=[c.split()[0] for c in CLASSES.split(", ")])

    return run


def _cut_bytes(need: int):
    def run(docs: pa.Table, wanted: pa.Table) -> pa.Table:
        batch = _Batch(docs) if wanted.num_rows else None
        keys = ("doc", "th", "start", "windows")
        raw = [
            batch.texts[batch.place[d, t]][a : a + n + need - 1] for d, t, a, n in zip(*(wanted.column(c).to_pylist() for c in keys))
        ]
        cut = {"raw": pa.array(raw, pa.binary()), "hot": pa.array([s > 0 for s in wanted.column("sub").to_pylist()], pa.bool_())}
        return pa.table({c.split()[0]: cut[c.split()[0]] if c.split()[0] in cut else wanted.column(c.split()[0]) for c in BYTES.split(", ")})

    return run


def _runs(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of true marks."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], marks.view(np.int8), [0]))))
    return edge[::2], edge[1::2] - edge[::2]


def _compare(need: int):
    """Windows that have an earlier copy in the suffix array of their anchor (``repeated``); of hot anchors also the others, with their hashes."""
    def array(rows: pa.Table) -> Iterator[list[np.ndarray]]:
        raw = rows.column("raw").to_pylist()
        sizes = np.array([len(b) for b in raw], np.int64)
        text = np.frombuffer(b"".join(raw), np.uint8)
        own = np.repeat(np.arange(len(raw)), sizes)
        offset = np.cumsum(sizes) - sizes
        rest = np.repeat(offset + sizes, sizes) - np.arange(len(text))
        again = previous_factor_reaches(text, rest, need)
        start, windows = _runs(again)  # a string's last windows end `need` before it, so no run goes over to the next
        yield [own[start], start - offset[own[start]], windows, np.zeros(len(start), np.int64), np.zeros(len(start), np.int64), np.ones(len(start), bool)]
        hot = np.array(rows.column("hot").to_pylist(), bool)
        left = np.flatnonzero(hot[own] & (rest >= need) & ~again)
        if len(left):
            hashes = anchor_hashes(text)
            k = [_windows_hash(hashes, left, need, salt).view(np.int64) for salt in (11, 13)]
            yield [own[left], left - offset[own[left]], np.ones(len(left), np.int64), *k, np.zeros(len(left), bool)]

    def run(table: pa.Table) -> pa.Table:
        # In order of documents, null ids first: the smaller position is the earlier start.
        order = pc.sort_indices(table, sort_keys=[(c, "ascending") for c in ("h", "doc", "th", "start")], null_placement="at_start")
        table = table.take(order)
        h = table.column("h").combine_chunks().to_numpy()
        sizes = np.array([len(b) for b in table.column("raw").to_pylist()], np.int64)
        ends, out, lo = np.cumsum(sizes), [], 0
        while lo < len(h):
            # As many whole anchors as fit into one array, one at least.
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] - sizes[lo] + ARRAY_BYTES, "right")))
            if hi < len(h):
                cut = int(np.searchsorted(h, h[hi], "left"))
                hi = cut if cut > lo else int(np.searchsorted(h, h[lo], "right"))
            part = table.slice(lo, hi - lo)
            for own, start, windows, k1, k2, repeated in array(part):
                rows = part.take(pa.array(own, pa.int64()))
                begin = rows.column("start").combine_chunks().to_numpy() + start if len(own) else start
                out.append(pa.table(
                    [pa.array(k1), pa.array(k2), rows.column("batch"), rows.column("doc"), rows.column("th"), pa.array(begin), pa.array(windows), pa.array(repeated)],
                    names=[c.split()[0] for c in FOUND.split(", ")],
                ))
            lo = hi
        return pa.concat_tables(out)

    return run


def merged(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Maximal runs of overlapping or adjacent intervals, as (start, stop) rows."""
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    first = np.concatenate(([True], start[1:] > stop[:-1])) if len(start) else np.empty(0, bool)
    last = np.concatenate((first[1:], [True])) if len(start) else first
    return np.stack([start[first], stop[last]], axis=1)


def _apply(need: int):
    def run(docs: pa.Table, removed: pa.Table) -> pa.Table:
        places: dict[tuple, list[int]] = {}
        for i, key in enumerate(zip(removed.column("doc").to_pylist(), removed.column("th").to_pylist())):
            places.setdefault(key, []).append(i)
        start = removed.column("start").combine_chunks().to_numpy()
        stop = start + removed.column("windows").combine_chunks().to_numpy() + need - 1
        out = []
        for doc, th, text in zip(docs.column("doc").to_pylist(), docs.column("th").to_pylist(), utf8(docs.column("text"))):
            at = places.get((doc, th), [])
            spans = merged(start[at], stop[at])
            edges = [0, *spans.ravel().tolist(), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
            out.append((doc, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), [{"start": a, "stop": b} for a, b in spans.tolist()]))
        columns = list(zip(*out)) if out else [[]] * 6
        kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return run


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", need: int = NEED, batch_bytes: int | None = None, group_fragments: int | None = None,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) of every row; ``spans`` are the maximal runs of removed bytes."""
    if need < 2 * ANCHOR:
        raise ValueError(f"strings of {2 * ANCHOR} bytes at least")
    group = group_fragments or GROUP_FRAGMENTS
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    long = F.octet_length("text") >= need
    total = rows.agg(F.sum(F.when(long, F.octet_length("text").cast("bigint")))).first()[0] or 0
    batches = max(1, -(-total // (batch_bytes or BATCH_BYTES)))
    texts = rows.where(long).withColumn("th", F.xxhash64("text"))
    texts = texts.withColumn("batch", F.pmod(F.xxhash64("doc", "th"), F.lit(batches)).cast("int"))

    named = texts.groupBy("batch").applyInArrow(_name_anchors(need), ANCHORS)
    everywhere = W.partitionBy("h")
    common = named.withColumn("total", F.sum("n").over(everywhere)).where(F.col("total") > 1).select("batch", "h", "total")

    classes = texts.groupBy("batch").cogroup(common.groupBy("batch")).applyInArrow(_name_classes(need, group), CLASSES)
    # One exchange for all that follows: both frames below use all columns of it.
    met = classes.repartition("h", "spread")
    place = F.row_number().over(W.partitionBy("h", "spread", "f").orderBy("doc", "th", "start"))
    kin = W.partitionBy("h", "spread")
    placed = met.withColumn("nth", place)
    copies = placed.where((F.col("later") | (F.col("nth") > 1)) & (F.col("sub") >= 0)).select("batch", "doc", "th", "start", "windows")
    several = (F.min("f").over(kin) != F.max("f").over(kin)) | (F.col("sub") > 0)
    firsts = placed.withColumn("several", several).where(~F.col("later") & (F.col("nth") == 1) & F.col("several"))
    apart = firsts.select("h", "sub", "batch", "doc", "th", "start", "windows")

    cut = texts.groupBy("batch").cogroup(apart.groupBy("batch")).applyInArrow(_cut_bytes(need), BYTES)
    table = F.pmod(F.xxhash64("h", "sub"), F.lit(batches)).cast("int").alias("array")
    found = cut.groupBy(table).applyInArrow(_compare(need), FOUND)
    # Windows of hot anchors, compared across arrays; the others are partitions of their own.
    alone = F.when(F.col("repeated"), F.xxhash64("doc", "th", "start"))
    across = F.row_number().over(W.partitionBy("k1", "k2", alone).orderBy("doc", "th", "start"))
    more = found.withColumn("nth", across).where(F.col("repeated") | (F.col("nth") > 1)).select("batch", "doc", "th", "start", "windows")

    removed = copies.unionByName(more)
    applied = texts.groupBy("batch").cogroup(removed.groupBy("batch")).applyInArrow(_apply(need), RESULT)
    short = rows.where(~long).select(
        F.col("doc").alias("doc_id"), F.octet_length("text").cast("bigint").alias("n_bytes"), F.lit(0).cast("bigint").alias("n_removed"),
        F.lit(0).cast("bigint").alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"),
        F.array().cast("array<struct<start:bigint,stop:bigint>>").alias("spans"),
    )
    return applied.unionByName(short)


@F.arrow_udf(T.StringType())
def remaining_text(text: pa.Array, spans: pa.Array) -> pa.Array:
    """What is left of texts without their spans; a character that a cut leaves incomplete is replaced."""
    out = []
    for raw, own in zip(utf8(text), spans.to_pylist()):
        edges = [0, *(x for s in own or [] for x in (s["start"], s["stop"])), len(raw or b"")]
        out.append(b"".join((raw or b"")[a:b] for a, b in zip(edges[::2], edges[1::2])).decode("utf-8", "replace"))
    return pa.array(out, pa.string())
