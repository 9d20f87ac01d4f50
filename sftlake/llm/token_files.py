"""Token-id files compressed by Re-Pair.

Documents in ascending id order are cut into shards of bounded size. In each shard frequent pairs of
neighbouring symbols are replaced by new symbols (nonterminals), round after round; a pair never
crosses the end of a document. A shard is one row of a Parquet table: its documents' ids and places, the
rules (two symbols each), the rules' expansion lengths, and the remaining symbols. Expansion lengths say
where each token lies without decoding, so a document, or a range of its tokens, is decoded from its own symbols.

One round replaces pairs that occur at least ``min_count`` times, from left to right; new symbols take part in the next rounds. Rounds end when no such
pair is left, the symbol space is used up or ``rounds``, where given, is reached. Any outcome decodes to the input exactly.

Defined cases: a null or empty text is a document of only the end id; documents of equal id are put in the
order of a hash of their text; null ids come first; a document larger than a shard is a shard of its own; an
empty table gives no shards.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sftlake.llm.bpe import encoder
from sftlake.llm.common import gathered, give_back, sliced, sliced_texts

END_ID = 2
SHARD_IDS = 1 << 20
BINS = 1 << 19
#: Texts that are encoded at once: the more, the fewer pieces are looked up again.
SLICE_ROWS, SLICE_BYTES = 1024, 4 << 20
#: Up to so many pairs are counted by sorting them.
EXACT = 1 << 16
#: Rules of up to so many ids are written out in full when a shard is decoded.
FLAT = 64
SHARD = (
    "part int, shard int, before bigint, n_docs bigint, n_tokens bigint, doc_ids array<bigint>, doc_tokens array<bigint>, doc_symbols array<bigint>, "
    "first_rule bigint, width int, rules binary, rule_lengths binary, symbols binary"
)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, each position's key by number, and the keys' counts."""
    return np.unique(keys, return_inverse=True, return_counts=True)


def _frequent(a: np.ndarray, b: np.ndarray, min_count: int, most: int, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pairs (a, b) of symbols: the keys (first symbol << 32 | second) of the frequent ones, the places where they stand, and each of those places' key by number.
    The places in ``skip`` hold no pair.

    Few pairs are counted exactly, by sorting. Many are counted in hash bins, in linear time: of pairs that share a bin one is taken, the others
    wait; where no pair can be taken that way, those of the bins that are full enough are counted exactly.
    """
    skip = np.empty(0, np.int64) if skip is None else skip
    if len(a) - len(skip) < min_count:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    binned = len(a) - len(skip) > EXACT
    if binned:
        bins = a * np.uint32(0x9E3779B1)
        bins ^= b * np.uint32(0x85EBCA6B)
        bins >>= np.uint32(32 - BINS.bit_length() + 1)
        bins = bins.astype(np.intp)
        bins[skip] = BINS
        full = np.flatnonzero(np.bincount(bins, minlength=BINS + 1)[:BINS] >= min_count)
        number = np.full(BINS + 1, -1, np.int32)
        number[full] = np.arange(len(full))
        number = number[bins]
        del bins
        at = np.flatnonzero(number >= 0)
        number = number[at]
    else:
        at = np.delete(np.arange(len(a)), skip)
    keys = a[at].astype(np.uint64)
    keys <<= np.uint64(32)
    keys |= b[at]
    if binned:
        found = np.zeros(len(full), np.uint64)
        found[number] = keys
        same = found[number] == keys
        counts = np.bincount(number[same], minlength=len(full))
        binned = (counts >= min_count).any()
    if binned:
        at, number = at[same], number[same]
    else:
        found, number, counts = _counted(keys)
    good = np.flatnonzero(counts >= min_count)
    if len(good) > most:
        good = np.sort(good[np.argsort(-counts[good], kind="stable")[:most]])
    rank = np.full(len(counts), -1, np.int32)
    rank[good] = np.arange(len(good))
    rank = rank[number]
    stay = rank >= 0
    return found[good], at[stay], rank[stay]


def repair(ids: np.ndarray, ends: np.ndarray, first_rule: int, rounds: int | None = None, min_count: int = 24, most: int = 1 << 14) -> tuple:
    """Symbols, their document ends, and rules (left, right) of a shard. ``ends`` marks each document's last id.

    A round looks at pairs with a symbol of the round before; where none is frequent, at all pairs, since some may have waited. The arrays are
    worked on in place and closed up after each round.
    """
    symbols, last, rules = ids.astype(np.uint32), np.flatnonzero(ends), [np.empty((0, 2), np.uint32)]
    next_rule = newest = first_rule
    complete = True
    for _ in count() if rounds is None else range(rounds):
        room = most - (next_rule - first_rule)
        if room <= 0 or len(symbols) < 2:
            break
        if complete:  # no pair crosses the end of a document
            keys, at, rank = _frequent(symbols[:-1], symbols[1:], min_count, room, last[last < len(symbols) - 1])
        else:
            new = symbols >= newest
            look = new[:-1] | new[1:]
            look[last[last < len(look)]] = False
            look = np.flatnonzero(look)
            keys, at, rank = _frequent(symbols[look], symbols[look + 1], min_count, room)
            at = look[at]
        if not len(keys):
            if complete:
                break
            complete = True
            continue
        # Pairs that overlap form runs of neighbouring positions: every second one is replaced.
        starts = np.concatenate(([0], np.flatnonzero(np.diff(at) != 1) + 1))
        odd = (at & 1).astype(bool)
        take = odd == np.repeat(odd[starts], np.diff(starts, append=len(at)))
        at, rank = at[take], rank[take]
        used = np.flatnonzero(np.bincount(rank, minlength=len(keys)))
        rules.append(np.stack([keys[used] >> np.uint64(32), keys[used] & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32))
        symbol = np.zeros(len(keys), np.uint32)
        symbol[used] = np.arange(next_rule, next_rule + len(used))
        symbols[at] = symbol[rank]
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        symbols, last = symbols[stay], last - np.searchsorted(at + 1, last, "right")
        newest, next_rule, complete = next_rule, next_rule + len(used), False
    ends = np.zeros(len(symbols), bool)
    ends[last] = True
    return symbols, ends, np.concatenate(rules)


def rule_lengths(rules: np.ndarray, first_rule: int) -> np.ndarray:
    """Tokens behind each rule. A rule only uses earlier ones, so rounds resolve from the front."""
    lengths = np.zeros(len(rules), np.int64)
    todo = np.arange(len(rules))
    while len(todo):
        sides = rules[todo].astype(np.int64) - first_rule
        known = np.where(sides < 0, 1, lengths[np.maximum(sides, 0)])
        done = (known > 0).all(axis=1)
        lengths[todo[done]] = known[done].sum(axis=1)
        todo = todo[~done]
    return lengths


def expand(symbols: np.ndarray, rules: np.ndarray, first_rule: int, lengths: np.ndarray | None = None) -> np.ndarray:
    """Symbols to ids. Rules of up to ``FLAT`` ids are written out once, side by side, and copied from there; symbols of longer
    rules are first replaced by their two sides, one level at a time. So what is written out is bounded by the rules."""
    if not len(rules):
        return symbols
    lengths = rule_lengths(rules, first_rule) if lengths is None else lengths
    lasting = np.concatenate((np.zeros(first_rule, bool), lengths > FLAT))
    while lasting.any() and (long := lasting[symbols]).any():
        symbols = _split(symbols, long, rules, first_rule)
    flat = np.where(lengths <= FLAT, np.arange(len(rules)) + first_rule, 0).astype(np.uint32)
    while (nested := flat >= first_rule).any():
        flat = _split(flat, nested, rules, first_rule)
    # Ids stand for themselves: a symbol of either kind is a slice of one array.
    sizes = np.concatenate((np.ones(first_rule, np.int64), np.where(lengths <= FLAT, lengths, 1)))
    flat = np.concatenate((np.arange(first_rule, dtype=np.uint32), flat))
    return gathered(flat, np.cumsum(sizes) - sizes, sizes, symbols)[0]


def _split(symbols: np.ndarray, which: np.ndarray, rules: np.ndarray, first_rule: int) -> np.ndarray:
    """Some symbols replaced by the two sides of their rules."""
    out = np.repeat(symbols, 1 + which)
    at = np.flatnonzero(which) + np.arange(which.sum())
    pair = rules[symbols[which] - first_rule]
    out[at], out[at + 1] = pair[:, 0], pair[:, 1]
    return out


def _shard(part: int, no: int, docs: list[tuple[int | None, bytes]], vocab: int, options: dict, before: int = 0) -> dict:
    counts = np.array([len(b) // 4 for _, b in docs], np.int64)
    ids = np.frombuffer(b"".join(b for _, b in docs), "<u4")
    ends = np.zeros(len(ids), bool)
    ends[np.cumsum(counts) - 1] = True
    symbols, last, rules = repair(ids, ends, vocab, **options)
    width = 2 if vocab + len(rules) <= 1 << 16 else 4
    return {
        "part": part, "shard": no, "before": before, "n_docs": len(docs), "n_tokens": int(counts.sum()), "doc_ids": [d for d, _ in docs],
        "doc_tokens": counts, "doc_symbols": np.diff(np.concatenate(([0], np.flatnonzero(last) + 1))), "first_rule": vocab,
        "width": width, "rules": rules.astype("<u4").tobytes(),
        "rule_lengths": rule_lengths(rules, vocab).astype("<u4").tobytes(), "symbols": symbols.astype(f"<u{width}").tobytes(),
    }


_SCHEMA = pa.schema([
    ("part", pa.int32()), ("shard", pa.int32()), ("before", pa.int64()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("doc_tokens", pa.list_(pa.int64())), ("doc_symbols", pa.list_(pa.int64())), ("first_rule", pa.int64()), ("width", pa.int32()),
    ("rules", pa.binary()), ("rule_lengths", pa.binary()), ("symbols", pa.binary()),
])


def token_shards(
    docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID,
    shard_ids: int = SHARD_IDS, vocab: int = 50257, rounds: int | None = None, min_count: int = 24, special_tokens: bool = False,
    keep_pieces: bool = True,
) -> DataFrame:
    """Shards of the documents in ascending id order; (part, shard) is their order.

    Texts move once, into ranges of (id, text hash). ``tokenizer`` is a path on every executor. With symbols
    of at most 65,536 kinds a shard's symbols take two bytes each, so rules are limited to what is left of those.
    With ``special_tokens`` their strings in a text become their ids. Without ``keep_pieces`` a worker's tables of pieces are emptied
    when a task has encoded its texts, and free memory goes back slice by slice: each task learns its pieces anew, and the worker holds less.
    """
    most = max((1 << 16) - vocab, 0) or (1 << 20)
    options = {"rounds": rounds, "min_count": min_count, "most": most}
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = ["doc", F.xxhash64("text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, no, before, held, size = TaskContext.get().partitionId(), 0, 0, [], 0
        pieces = encoder(tokenizer, special_tokens)
        for batch in sliced_texts(batches, "text", SLICE_ROWS, SLICE_BYTES):
            ids = pieces.encode(batch.column("text").to_pylist())
            if not keep_pieces:
                give_back()
            for doc, own in zip(batch.column("doc").to_pylist(), ids):
                own += end
                if held and size + len(own) // 4 > shard_ids:
                    yield pa.RecordBatch.from_pylist([_shard(part, no, held, vocab, options, before)], _SCHEMA)
                    no, before, held, size = no + 1, before + size, [], 0
                held.append((doc, own))
                size += len(own) // 4
        if not keep_pieces:
            pieces.forget()
            give_back()
        if held:
            yield pa.RecordBatch.from_pylist([_shard(part, no, held, vocab, options, before)], _SCHEMA)
        if not keep_pieces:
            held = None
            give_back()

    return ranged.mapInArrow(run, SHARD)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, **options) -> None:
    token_shards(docs, tokenizer, **options).write.option("compression", "zstd").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD).parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """Add ``start``: ids in all shards before. A shard knows the ids before it in its own writing task, so all that is added up and
    joined is one number per writing task; shards do not move."""
    own = shards.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    ahead = F.sum("_n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    parts = own.select(F.col("part").alias("_part"), F.coalesce(ahead, F.lit(0)).alias("_ahead"))
    return shards.join(F.broadcast(parts), F.col("part") == F.col("_part")).withColumn(
        "start", (F.col("_ahead") + F.col("before")).cast("bigint")
    ).drop("_part", "_ahead")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Shards one at a time."""
    for batch in sliced(batches, 1):
        yield from batch.to_pylist()


def _arrays(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return (
        np.frombuffer(row["symbols"], f"<u{row['width']}").astype(np.uint32), np.frombuffer(row["rules"], "<u4").reshape(-1, 2),
    )


def decode_shard(row: dict) -> list[np.ndarray]:
    """The ids of each document of a shard."""
    symbols, rules = _arrays(row)
    ids = expand(symbols, rules, row["first_rule"], np.frombuffer(row["rule_lengths"], "<u4").astype(np.int64))
    return np.split(ids, np.cumsum(row["doc_tokens"])[:-1])


def decode_range(row: dict, doc: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a shard's ``doc``-th document, from the symbols that cover them only."""
    symbols, rules = _arrays(row)
    at = np.concatenate(([0], np.cumsum(row["doc_symbols"])))
    own = symbols[at[doc] : at[doc + 1]]
    lengths = np.frombuffer(row["rule_lengths"], "<u4").astype(np.int64)
    nested = own >= row["first_rule"]
    sizes = np.ones(len(own), np.int64)
    sizes[nested] = lengths[own[nested] - row["first_rule"]]
    stops = np.cumsum(sizes)
    lo, hi = np.searchsorted(stops, start, "right"), np.searchsorted(stops, stop, "left") + 1
    ids = expand(own[lo:hi], rules, row["first_rule"], lengths)
    before = int(stops[lo - 1]) if lo else 0
    return ids[start - before : stop - before]


def read_token_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            docs = decode_shard(row)
            counts = np.array(row["doc_tokens"], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + np.cumsum(counts) - counts), pa.array(counts),
                 pa.array([zlib.crc32(d.astype("<u4").tobytes()) for d in docs], pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    return shard_starts(read_shards(spark, path)).mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_documents(spark: SparkSession, path: str, doc_ids: DataFrame | None = None) -> DataFrame:
    """(doc_id, ids) of all documents, or of those in ``doc_ids`` (doc_id): only shards that hold one are decoded."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            wanted = None if row["wanted"] is None else set(row["wanted"])
            picks = [i for i, d in enumerate(row["doc_ids"]) if wanted is None or d in wanted]
            ids = [decode_range(row, i, 0, row["doc_tokens"][i]) for i in picks]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["doc_ids"][i] for i in picks], pa.int64()), pa.array([i.astype(np.int64) for i in ids], pa.list_(pa.int64()))],
                names=["doc_id", "ids"],
            )

    shards = read_shards(spark, path)
    if doc_ids is None:
        chosen = shards.withColumn("wanted", F.lit(None).cast("array<bigint>"))
    else:
        places = shards.select("part", "shard", F.explode("doc_ids").alias("doc_id"))
        named = places.join(doc_ids.select("doc_id").distinct(), "doc_id").groupBy("part", "shard").agg(F.collect_set("doc_id").alias("wanted"))
        chosen = shards.join(named, ["part", "shard"])
    return chosen.mapInArrow(run, "doc_id bigint, ids array<bigint>")
