"""MinHash near-dedup by a multi-index Hamming join.

1. Every text gets its set of word shingles and a signature of ``SYMBOLS`` b-bit (16-bit) minima. Rows of equal
   sets form a class with one representative, so exact copies, however many, are one row from here on.
2. Signatures are split into ``CHUNKS`` chunks of ``WIDTH`` symbols. By the pigeonhole principle two signatures
   that differ in at most ``MAX_DISTANCE = CHUNKS * (ERRORS + 1) - 1`` symbols have a chunk with at most ``ERRORS``
   differences. All ways to leave ``ERRORS`` symbols out of each chunk are enumerated as keys, so all those pairs share a key;
   nothing is left to chance but the signature itself. (Two texts at similarity 0.8 differ in 16 of 80 symbols on
   average, and in more than 31 once in 30,000 pairs; more alike ones far more rarely.)
3. Rows of a key (in parts of about ``STAR_ROWS`` that all have its first row) are seen in order by a stream that holds three rows of it: each row is
   compared with the first, the second and the row before, by the bounds on set size and on 256 two-bit minima. Of those each row keeps two, the most alike and the
   first, which are confirmed on full sets, and components are formed. That is linear, and unites most of a group of any size.
4. Keys whose rows lie in different components are looked at again, all pairs across components, never those within one. The rows
   of a key that has many are cut into blocks, and each pair of blocks is a group of its own, so one key's pairs are spread over tasks. Between
   small components plausible pairs are confirmed one by one. A row that is plausible for a member of a large component is
   compared with all its members at once, through an inverted index over blocks of them, and needs one row however many members
   it resembles. So no link is lost to step 3's choice, and a large group, linked or not linked with a text, makes no pairs by
   its square; what remains pair by pair are plausible texts (similarity 0.65 and more) that are linked with few others.

Membership is returned by row, with the class's component; pairs within classes are not expanded.

Defined cases: a null or wordless text has an empty set, is linked with nothing and stays; a text with fewer words than a shingle
has one shingle, its whole sequence; rows of one id are one document; a row with a null id is linked with nothing, has a null
component and stays; an empty table gives no rows. Texts are used whole, whatever their length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from sftlake.llm.common import ending, mix64, sliced, sliced_texts, stored, utf8
from sftlake.llm.components import components

SHINGLE_WORDS = 5
PERCENT = 80
WIDTH, CHUNKS, ERRORS = 5, 16, 1
SYMBOLS = WIDTH * CHUNKS
MAX_DISTANCE = CHUNKS * (ERRORS + 1) - 1
MINIMA = 256
#: Of 256 two-bit minima a pair at similarity 0.8 differs in 38.4 on average; in more than this once in 50,000.
MAX_DIFFERENT = 63
#: Components up to this size are compared pair by pair, larger ones through an index of their members.
SMALL = 16
#: Shingles in a block of members, and in a block of the rows that are compared with it.
BLOCK_SHINGLES = 1 << 20
#: Rows of one key in a block; a task compares two blocks at a time.
BLOCK_ROWS = 1 << 14
#: Rows of one key in a stream of step 3.
STAR_ROWS = 1 << 16
#: Ids sent to all tasks, at most; beyond that the texts are joined.
SEND_IDS = 2_000_000
WORD_CACHE = 150_000

_RNG = np.random.default_rng(20)
_A = (_RNG.integers(0, 1 << 32, MINIMA, dtype=np.uint64).astype(np.uint32) | np.uint32(1))[:, None]
_B = _RNG.integers(0, 1 << 32, MINIMA, dtype=np.uint64).astype(np.uint32)[:, None]
WORDS = tuple(f"b{i}" for i in range(8))
SKETCH = f"doc bigint, n bigint, s0 bigint, s1 bigint, symbols binary, {', '.join(f'{b} bigint' for b in WORDS)}"


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_WORDS = _Words()


def forget_words() -> None:
    _WORDS.clear()


def shingles(text: bytes | None, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles. bytes.lower and bytes.split know ASCII only: A-Z and [\\x20\\x09-\\x0D]."""
    w = text.lower().split() if text else []
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, w), np.uint64, len(w))
    k = min(words, len(h))
    out = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[j : len(h) - k + 1 + j]
    return np.unique(mix64(out + np.uint64(k)))


def minima(s: np.ndarray) -> np.ndarray:
    """The smallest value of each of 256 hash functions over a set, finalised to 32 well-mixed bits."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    best = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 512):
        best = np.minimum(best, (_A * x[None, at : at + 512] + _B).min(axis=1))
    best ^= best >> np.uint32(15)
    best *= np.uint32(0x2C1B3C6D)
    best ^= best >> np.uint32(13)
    best *= np.uint32(0x297A2D39)
    return best ^ (best >> np.uint32(16))


def sketches(docs: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """(doc, n, s0, s1, symbols, b0 to b7) of every row; s0, s1 are a 128-bit hash of the set."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced_texts(ending(batches, forget_words), "text", 512):
            sets = [shingles(t, words) for t in utf8(b.column("text"))]
            found = np.stack([minima(s) for s in sets]) if sets else np.empty((0, MINIMA), np.uint32)
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            # Two bits of each minimum side by side.
            top = np.stack([found >> np.uint32(31), (found >> np.uint32(30)) & np.uint32(1)], axis=2).astype(np.uint8)
            bits = np.packbits(top.reshape(len(sets), -1), axis=1).reshape(-1).view("<i8").reshape(-1, len(WORDS))
            symbols = (found[:, :SYMBOLS] & np.uint32(0xFFFF)).astype("<u2")
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), pa.array([len(s) for s in sets], pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1]),
                 pa.array([r.tobytes() for r in symbols], pa.binary()), *map(pa.array, bits.T.copy())],
                names=["doc", "n", "s0", "s1", "symbols", *WORDS],
            )

    return rows.mapInArrow(run, SKETCH)


def chunk_keys(symbols: np.ndarray) -> np.ndarray:
    """All keys of signatures (rows of 16-bit symbols): every chunk with every choice of one symbol left out."""
    s = symbols.reshape(-1, CHUNKS, WIDTH).astype(np.uint64)
    keys = []
    for out in range(WIDTH):
        packed = np.zeros(s.shape[:2], np.uint64)
        for j in range(WIDTH):
            if j != out:
                packed = (packed << np.uint64(16)) | s[:, :, j]
        salt = (np.arange(CHUNKS, dtype=np.uint64) * np.uint64(WIDTH) + np.uint64(out + 1)) * np.uint64(0xD6E8FEB86659FD93)
        keys.append(mix64(packed ^ mix64(salt)[None, :]))
    return np.concatenate(keys, axis=1)


KEYED = ", ".join(f"{c} bigint" for c in ("key", "rep", "comp", "members", "n", *WORDS))


def _shared_keys(reps: DataFrame) -> DataFrame:
    """(key, rep) of the keys that more than one representative (rep, symbols) has. Most keys are one text's own and
    go here, before anything wider moves.

    A key that several rows of a batch have is known to be shared: one of them stands for the batch where keys meet, and the others, with a number of
    their own for a key and the true one beside it (``own``), spread over all tasks. So of a frequent key a row per batch meets.
    """
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, 4096):
            symbols = np.frombuffer(b"".join(b.column("symbols").to_pylist()), "<u2").reshape(-1, SYMBOLS)
            found = chunk_keys(symbols).view(np.int64)
            rep = np.repeat(b.column("rep").to_numpy(zero_copy_only=False), found.shape[1])
            found = found.reshape(-1)
            order = np.argsort(found, kind="stable")
            same = found[order][1:] == found[order][:-1]
            again, known = np.zeros(len(found), bool), np.zeros(len(found), bool)
            again[order[1:][same]] = True
            known[order[:-1][same]] = True
            alone = mix64(found.view(np.uint64) ^ mix64(rep.view(np.uint64))).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.where(again, alone, found)), pa.array(rep), pa.array(found, mask=~(again | known))], names=["key", "rep", "own"]
            )

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, and whether it has been passed on
        for b in sliced(batches, 1 << 18):
            if not b.num_rows:
                continue
            key, rep = (b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "rep"))
            known = b.column("own").is_valid().to_numpy(zero_copy_only=False)
            true = np.where(known, b.column("own").fill_null(0).to_numpy(zero_copy_only=False), key)
            done = np.zeros(len(key), bool)
            if held is not None:
                key, rep, true, known, done = (np.append(x, y) for x, y in zip(held, (key, rep, true, known, done)))
            same = key[1:] == key[:-1]
            take = np.append(same, False) | np.append(False, same) | known
            passed = take & ~done
            held = key[-1:], rep[-1:], true[-1:], known[-1:], (take | done)[-1:]
            if passed.any():
                yield pa.RecordBatch.from_arrays([pa.array(true[passed]), pa.array(rep[passed])], names=["key", "rep"])

    narrow = reps.select("rep", "symbols").mapInArrow(keys, "key bigint, rep bigint, own bigint")
    return narrow.repartition("key").sortWithinPartitions("key").mapInArrow(shared, "key bigint, rep bigint")


def _parts(shared: DataFrame) -> DataFrame:
    """(key, rep) with keys of more than ``STAR_ROWS`` rows cut into parts, each a key of its own that has the key's smallest row too."""
    counts = shared.groupBy(F.col("key").alias("_key")).agg(F.count(F.lit(1)).alias("rows"), F.min("rep").alias("least"))
    frequent = stored(counts.where(F.col("rows") > STAR_ROWS), "frequent")  # at most one key per STAR_ROWS rows
    rows = shared.join(F.broadcast(frequent), F.col("key") == F.col("_key"), "left")
    parts = F.ceil(F.col("rows") / F.lit(STAR_ROWS)).cast("int")
    own = F.array(F.coalesce(F.pmod(F.xxhash64("rep"), parts).cast("int"), F.lit(0)))
    part = F.explode(F.when(F.col("rep") == F.col("least"), F.sequence(F.lit(0), parts - F.lit(1))).otherwise(own))
    cut = rows.select("key", "rep", "rows", part.alias("part"))
    return cut.select(F.when(F.col("rows").isNotNull(), F.xxhash64("key", "part")).otherwise(F.col("key")).alias("key"), "rep")


def _keyed(shared: DataFrame, reps: DataFrame) -> DataFrame:
    """The shared keys with (comp, members, n, b0 to b7) of their representatives."""
    own = reps.select(F.col("rep").alias("_rep"), "comp", "members", "n", *WORDS)
    return shared.join(own, F.col("rep") == F.col("_rep")).select("key", "rep", "comp", "members", "n", *WORDS)


ROW = np.dtype([(c.split()[0], "i8") for c in KEYED.split(", ")])


def _rows(batch: pa.RecordBatch, dtype: np.dtype = ROW) -> np.ndarray:
    rows = np.empty(batch.num_rows, dtype)
    for name in dtype.names:
        rows[name] = batch.column(name).to_numpy(zero_copy_only=False)
    return rows


def _different(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many of the two-bit minima differ."""
    total = np.zeros(len(x), np.int64)
    for c in WORDS:
        d = (x[c] ^ y[c]).view(np.uint64)  # unsigned: bitwise_count takes the absolute value of signed integers
        total += np.bitwise_count((d | (d >> np.uint64(1))) & np.uint64(0x5555555555555555))
    return total


def _plausible(x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Pairs whose set sizes and one-bit minima allow the similarity."""
    small, large = np.minimum(x["n"], y["n"]), np.maximum(x["n"], y["n"])
    return (100 * small >= percent * large) & (_different(x, y) <= MAX_DIFFERENT) & (x["rep"] != y["rep"])


def _batch(names: str, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names.split())


def _star(percent: int):
    """(a, b, bits): each row b of a key with the key's first and second row and the row before it, where plausible."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty(0, ROW)  # first, second and latest row of the open key
        for b in sliced(batches, 1 << 18):
            rows = np.concatenate([held, _rows(b)])
            if not len(rows):
                continue
            begins = np.concatenate(([True], rows["key"][1:] != rows["key"][:-1]))
            first = np.maximum.accumulate(np.where(begins, np.arange(len(rows)), 0))
            at = np.flatnonzero(~begins)
            found = []
            for other in (first[at], np.minimum(first[at] + 1, at), at - 1):
                x, y = rows[at], rows[other]
                ok = _plausible(x, y, percent)
                found.append(np.stack([y["rep"][ok], x["rep"][ok], _different(x[ok], y[ok])], axis=1))
            out = np.unique(np.concatenate(found), axis=0)
            if len(out):
                yield _batch("a b bits", *out.T.copy())
            start = first[-1]
            held = rows[np.unique([start, min(start + 1, len(rows) - 1), len(rows) - 1])]

    return run


CELL = np.dtype([("a", "i8"), ("b", "i8"), ("side", "i8"), *ROW.descr])


def _cells(shared: DataFrame, placed: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(a, b, side) and the columns of ROW: the rows of keys that span components, dealt into cells of two blocks (a <= b).

    A key of at most ``block_rows`` rows is one block. In a larger one each component of more rows than that has blocks of its
    own, and the other rows share blocks. A row goes with its block to the cell of every block of the key, save those
    of its own large component, so any two rows in different components meet in exactly one cell.
    ``side`` is 0 for the rows of block a and 1 for those of block b.
    """
    where = placed.select(F.col("rep").alias("_rep"), "comp")
    spans = shared.join(where, F.col("rep") == F.col("_rep")).groupBy(F.col("key").alias("_key")).agg(
        F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("rows")
    )
    several = stored(spans.where("lo <> hi").select("_key", "rows"), "spanning")
    blocks = lambda n: F.ceil(n / F.lit(block_rows)).cast("bigint")
    # At most one key, and one component of a key, per block_rows shared rows.
    long = F.broadcast(several.where(F.col("rows") > block_rows))
    large = stored(
        shared.join(long, F.col("key") == F.col("_key")).join(where, F.col("rep") == F.col("_rep"))
        .groupBy(F.col("key").alias("_k"), F.col("comp").alias("_c")).agg(F.count(F.lit(1)).alias("held"))
        .where(F.col("held") > block_rows).withColumn("own", blocks(F.col("held"))), "large",
    )
    taken = large.groupBy("_k").agg(F.sum("held").alias("held"), F.sum("own").alias("large"))
    counts = long.join(taken, F.col("_key") == F.col("_k"), "left").select(
        F.col("_key").alias("_long"), blocks(F.col("rows") - F.coalesce("held", F.lit(0))).alias("rest"), F.coalesce("large", F.lit(0)).alias("large")
    )
    counts = stored(counts, "blocks")
    before = F.sum("own").over(W.partitionBy("_k").orderBy("_c")) - F.col("own")
    ranges = large.join(counts, F.col("_k") == F.col("_long")).select("_k", "_c", "own", (F.col("rest") + before).alias("start"))

    rows = _keyed(shared.join(several, F.col("key") == F.col("_key"), "left_semi"), placed)
    rows = rows.join(F.broadcast(counts), F.col("key") == F.col("_long"), "left")
    rows = rows.join(F.broadcast(stored(ranges, "ranges")), (F.col("key") == F.col("_k")) & (F.col("comp") == F.col("_c")), "left")
    total = F.coalesce(F.col("rest") + F.col("large"), F.lit(1))
    mine = F.coalesce("start", F.lit(0)) + F.pmod(F.xxhash64("rep"), F.coalesce("own", "rest", F.lit(1)))
    rows = rows.withColumn("_mine", mine).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), total - 1)))
    apart = F.col("start").isNull() | (F.col("_other") < F.col("start")) | (F.col("_other") >= F.col("start") + F.col("own"))
    return rows.where(apart).select(
        F.least("_mine", "_other").alias("a"), F.greatest("_mine", "_other").alias("b"),
        (F.col("_mine") > F.col("_other")).cast("bigint").alias("side"), *ROW.names,
    )


def _across(percent: int, step: int = 1 << 18):
    """Plausible pairs of a cell's rows in different components; rows come by (key, a, b, side, comp). A row of the smaller
    component is ``a``; ``b`` is its partner, or null where that lies in a large component, which ``comp`` then names."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty(0, CELL)  # the open cell: two blocks at most

        def pairs(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            if len(rows) < 2:
                return
            changes = lambda *names: np.any([rows[c][1:] != rows[c][:-1] for c in names], axis=0)
            ends = lambda cuts: np.repeat(np.append(cuts, len(rows)), np.diff(np.concatenate(([0], cuts, [len(rows)]))))
            new_cell = changes("key", "a", "b")
            new_side = new_cell | changes("side")
            cell_end, side_end, comp_end = (ends(np.flatnonzero(c) + 1) for c in (new_cell, new_side, new_side | changes("comp")))
            # Partners: in a block with itself the rows of later components, else the other block's rows.
            begin = np.where(rows["a"] == rows["b"], comp_end, side_end)
            partners = cell_end - begin
            total = np.cumsum(partners)
            lo = 0
            while lo < len(rows):
                hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + step, "right")))
                n = partners[lo:hi]
                if n.sum():
                    left = np.repeat(np.arange(lo, hi), n)
                    right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + begin[left]
                    other = rows["comp"][left] != rows["comp"][right]
                    left, right = left[other], right[other]
                    ok = _plausible(rows[left], rows[right], percent)
                    if ok.any():
                        x, y = rows[left[ok]], rows[right[ok]]
                        swap = (x["members"] > y["members"]) | ((x["members"] == y["members"]) & (x["comp"] < y["comp"]))
                        x, y = np.where(swap, y, x), np.where(swap, x, y)  # y lies in the larger component
                        large = y["members"] > SMALL
                        out = np.stack([x["rep"], np.where(large, -1, y["rep"]), np.where(large, y["comp"], -1), large], axis=1)
                        out = np.unique(out, axis=0)
                        large = out[:, 3].astype(bool)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(out[:, 0]), pa.array(out[:, 1], mask=large), pa.array(out[:, 2], mask=~large)], names=["a", "b", "comp"]
                        )
                lo = hi

        for b in sliced(batches, 1 << 18):
            rows = np.concatenate([held, _rows(b, CELL)])
            if not len(rows):
                continue
            last = rows[-1]
            whole = int(np.argmax((rows["key"] == last["key"]) & (rows["a"] == last["a"]) & (rows["b"] == last["b"])))
            yield from pairs(rows[:whole])
            held = rows[whole:].copy()
        yield from pairs(held)

    return run


@F.arrow_udf(T.BooleanType())
def similar(x: pa.Array, y: pa.Array, percent: pa.Array) -> pa.Array:
    """100 * |x & y| >= percent * |x | y| on full sets (packed, sorted)."""
    out = []
    for a, b, p in zip(x.to_pylist(), y.to_pylist(), percent.to_pylist()):
        s, t = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
        both = np.concatenate([s, t])
        both.sort(kind="stable")
        common = int((both[1:] == both[:-1]).sum())
        out.append(100 * common >= p * (len(s) + len(t) - common))
    return pa.array(out, pa.bool_())


def _sets(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(id, n, set) of the documents in ``ids`` (id), made anew from their texts."""
    ids = stored(ids.distinct(), "ids")
    if ids.count() <= SEND_IDS:
        ids = F.broadcast(ids)  # 8 bytes each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced_texts(ending(batches, forget_words), "text", 512):
            sets = [shingles(t, words) for t in utf8(b.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), pa.array([len(x) for x in sets], pa.int64()), pa.array([x.astype("<u8").tobytes() for x in sets], pa.binary())],
                names=["id", "n", "set"],
            )

    return docs.select("doc", "text").join(ids, F.col("doc") == F.col("id"), "left_semi").mapInArrow(run, "id bigint, n bigint, set binary")


def _confirmed(docs: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    sets = _sets(docs, pairs.select(F.col("a").alias("id")).union(pairs.select("b")), words).drop("n")
    x, y = sets.toDF("a", "x"), sets.toDF("b", "y")
    return pairs.join(x, "a").join(y, "b").where(similar("x", "y", F.lit(percent))).select("a", "b").distinct()


def _search(percent: int):
    """(a, b): for each asked row one member of the block that is similar enough, if any is; by overlap counts."""
    def run(members: pa.Table, asked: pa.Table) -> pa.Table:
        found: list[tuple[int, int]] = []
        if members.num_rows and asked.num_rows:
            sets = [np.frombuffer(x, "<u8") for x in members.column("set").to_pylist()]
            sizes = np.array(list(map(len, sets)))
            flat = np.concatenate(sets)
            order = np.argsort(flat, kind="stable")
            flat, owner = flat[order], np.repeat(np.arange(len(sets)), sizes)[order]
            ids = members.column("id").to_numpy()
            for a, own in zip(asked.column("q").to_pylist(), asked.column("qset").to_pylist()):
                x = np.frombuffer(own, "<u8")
                lo, hi = np.searchsorted(flat, x, "left"), np.searchsorted(flat, x, "right")
                n = hi - lo
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
                common = np.bincount(owner[at], minlength=len(sets))
                ok = np.flatnonzero(100 * common >= percent * (len(x) + sizes - common))
                if len(ok):
                    found.append((a, int(ids[ok[0]])))
        return pa.table([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())], names=["a", "b"])

    return run


def _confirmed_members(docs: DataFrame, asked: DataFrame, member: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) of rows ``a`` with members of the large components ``comp`` named for them; ``member`` has (rep, comp)."""
    targets = asked.select("comp").distinct()
    members = member.join(targets, "comp", "left_semi")
    sets = stored(_sets(docs, members.select(F.col("rep").alias("id")).union(asked.select("a")), words), "sets")
    inside = sets.join(members, F.col("id") == F.col("rep")).select("id", "n", "set", "comp")
    outside = sets.join(asked, F.col("id") == F.col("a")).select(
        F.col("a").alias("q"), F.col("n").alias("qn"), F.col("set").alias("qset"), F.col("comp").alias("large")
    )
    blocks = lambda n: F.ceil(F.sum(n) / F.lit(BLOCK_SHINGLES)).cast("int")
    counts = inside.groupBy(F.col("comp").alias("_c")).agg(blocks("n").alias("mb")).join(
        outside.groupBy(F.col("large").alias("_l")).agg(blocks("qn").alias("ab")), F.col("_c") == F.col("_l")
    ).select("_c", "mb", "ab")
    counts = stored(counts, "blocks")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    mine = lambda i, n: F.pmod(F.xxhash64(i), F.col(n)).cast("int")
    left = inside.join(counts, F.col("comp") == F.col("_c")).select("id", "set", "comp", mine("id", "mb").alias("mk"), every("ab").alias("ak"))
    right = outside.join(counts, F.col("large") == F.col("_c")).select("q", "qset", "large", every("mb").alias("qm"), mine("q", "ab").alias("qa"))
    return left.groupBy("comp", "mk", "ak").cogroup(right.groupBy("large", "qm", "qa")).applyInArrow(_search(percent), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Keys and bounds are laid out for a ``percent`` of 80 and more; a lower one, whose pairs they would lose, is refused.
    """
    if percent < PERCENT:
        raise ValueError(f"percent is {PERCENT} or more")
    own = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).cast("string").alias("text"))
    sketch = stored(sketches(own, "doc", "text", words), "sketches")
    reps = stored(
        sketch.where("n > 0 and doc is not null").groupBy("s0", "s1").agg(
            F.min("doc").alias("rep"), *(F.first(c).alias(c) for c in ("n", "symbols", *WORDS))
        ), "classes",
    )
    single = reps.withColumn("comp", F.col("rep")).withColumn("members", F.lit(1).cast("bigint"))
    # Rows of one id are one document: its classes are tied by the id.
    twice = sketch.where("n > 0 and doc is not null").groupBy("doc").agg(
        F.min(F.struct("s0", "s1")).alias("x"), F.max(F.struct("s0", "s1")).alias("y")
    ).where("x <> y")
    tied = (
        sketch.join(twice.select("doc"), "doc").where("n > 0").select("doc", "s0", "s1").distinct()
        .join(reps.select("s0", "s1", "rep"), ["s0", "s1"]).select(F.col("doc").alias("a"), F.col("rep").alias("b")).where("a <> b")
    )
    shared = stored(_shared_keys(reps), "keys")
    keyed = _keyed(_parts(shared), single).repartition("key").sortWithinPartitions("key", "rep")
    close = keyed.mapInArrow(_star(percent), "a bigint, b bigint, bits bigint").groupBy("b").agg(
        F.min(F.struct("bits", "a"))["a"].alias("alike"), F.min("a").alias("first")
    )
    first = stored(close.select(F.col("alike").alias("a"), "b").union(close.where("first <> alike").select("first", "b")), "pairs")
    links = stored(_confirmed(own, first, words, percent).unionByName(tied), "links")
    found = stored(components(links, "a", "b"), "components")
    sizes = found.groupBy(F.col("component").alias("_c")).agg(F.count(F.lit(1)).alias("_members"))
    joined = reps.join(found, reps["rep"] == found["node"], "left").withColumn("comp", F.coalesce("component", "rep"))
    joined = joined.join(sizes, joined["comp"] == sizes["_c"], "left").withColumn("members", F.coalesce("_members", F.lit(1)).cast("bigint"))
    placed = stored(joined.select("rep", "comp", "members", "n", *WORDS), "placed")
    rest = _cells(shared, placed).repartition("key", "a", "b").sortWithinPartitions("key", "a", "b", "side", "comp")
    across = stored(rest.mapInArrow(_across(percent), "a bigint, b bigint, comp bigint").distinct(), "across")
    more = _confirmed(own, across.where("b is not null").select("a", "b"), words, percent)
    large = _confirmed_members(own, across.where("b is null").select("a", "comp"), placed.select("rep", "comp"), words, percent)
    links = links.unionByName(more).unionByName(large)
    final = stored(components(links, "a", "b"), "components")
    member = sketch.where("n > 0").select("doc", "n", "s0", "s1").join(reps.select("s0", "s1", "rep"), ["s0", "s1"], "left")
    result = member.join(final, member["rep"] == final["node"], "left").select(
        "doc", "n", F.when(F.col("doc").isNotNull(), F.coalesce("component", "rep")).alias("component_id")
    )
    alone = sketch.where("n = 0").select("doc", "n", F.col("doc").alias("component_id"))
    return result.unionByName(alone).select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id",
        F.coalesce(F.col("doc") == F.col("component_id"), F.lit(True)).alias("kept"),
    )
