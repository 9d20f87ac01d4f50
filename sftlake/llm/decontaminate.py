"""Benchmark decontamination: one Aho-Corasick automaton over windows of normalised test items.

Words are runs of letters, digits and non-ASCII characters, ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after
lower-casing A-Z. That rule works byte by byte on UTF-8, so a text is normalised by one table look-up and
keeps its byte offsets; the words are joined by single spaces, scanned once, and matches are mapped back
to words and, for reports, to character offsets of the original text.

The test items are the query set: they go to the tasks in blocks of at most ``block_bytes`` of windows.
Usually that is one block and one scan; a larger benchmark takes one scan per block, each with one automaton per task that is
built once. Between scans the documents are written with what was found in them.

Defined cases: a null or wordless text has 0 words and is clean; a null or wordless item has no window; an
item repeated (same id) counts once, items of equal text each count; an item with a null id cannot be
named and is left out; no benchmark rows leave all documents clean. A very long text is scanned whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftlake.llm.common import free_name, sliced_texts, stored, utf8

WINDOW = 10
BLOCK_BYTES = 64 << 20
RESULT = {
    "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string",
    "contaminated": "boolean", "item_ids": "array<bigint>", "spans": "array<struct<start:bigint,stop:bigint>>",
}


def _byte_table() -> bytes:
    table = bytearray(range(256))
    for b in range(128):
        c = chr(b)
        table[b] = ord(c.lower()) if c.isalnum() else 32
    return bytes(table)


TABLE = _byte_table()


def words(text: bytes | None) -> list[bytes]:
    return [] if text is None else text.translate(TABLE).split()


def windows(text: bytes | None, size: int = WINDOW) -> list[bytes]:
    """Each ``size`` consecutive words of an item; all its words if it has fewer."""
    w = words(text)
    if not w:
        return []
    return [b" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))]


def blocks(items: Iterator[tuple[int, bytes | None]], size: int, block_bytes: int) -> list[dict[bytes, tuple[int, ...]]]:
    """The items' windows with the ids they stand for, cut into blocks of bounded size."""
    out: list[dict] = [{}]
    held = 0
    for item, text in items:
        for w in dict.fromkeys(windows(text, size)):
            if held > block_bytes:
                out.append({})
                held = 0
            held += len(w) + 64
            out[-1].setdefault(w, []).append(item)
    return [{w: tuple(dict.fromkeys(ids)) for w, ids in b.items()} for b in out if b]


def _automaton(block: dict[bytes, tuple[int, ...]]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for w, ids in block.items():
        # Bytes as Latin-1 characters: the automaton then works on UTF-8 units.
        automaton.add_word(f" {w.decode('latin-1')} ", (w.count(b" ") + 1, ids))
    automaton.make_automaton()
    return automaton


def scan(automaton: ahocorasick.Automaton, normal: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
    """Word ranges hit (start, stop), unmerged, and the items that hit."""
    line = f" {b' '.join(normal).decode('latin-1')} "
    found = list(automaton.iter(line))
    if not found:
        return [], set()
    # Offset of the space after each word, so a match that ends there ends with that word.
    ends = np.cumsum(np.fromiter(map(len, normal), np.int64, len(normal)) + 1)
    at = np.searchsorted(ends, [end for end, _ in found])
    ids = {i for _, (_, own) in found for i in own}
    return [(int(k) + 1 - n, int(k) + 1) for k, (_, (n, _)) in zip(at, found)], ids


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def original_spans(text: bytes, ranges: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Character offsets, in the text as given, of ranges of words."""
    raw = np.frombuffer(text.translate(TABLE), np.uint8)
    word = np.diff(np.concatenate(([0], (raw != 32).view(np.int8), [0])))
    starts, stops = np.flatnonzero(word == 1), np.flatnonzero(word == -1)
    # Characters before each byte: all bytes that do not continue a character.
    before = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    return [{"start": int(before[starts[a]]), "stop": int(before[stops[b - 1]])} for a, b in ranges]


def _digest(ids: list[int]) -> str:
    return hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, text: str = "text",
    item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Add to each document how many of its words lie in windows of test items, which items those
    are, and where in the original text (``spans``, characters). Columns of the result's names are replaced."""
    spark = docs.sparkSession
    named = items.select(F.col(item_id).cast("bigint").alias("i"), F.col(item_text).alias("t")).where("i is not null")
    cut = blocks(((r.i, None if r.t is None else r.t.encode()) for r in named.toLocalIterator()), window, block_bytes) or [{}]
    added = list(RESULT)
    kept = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in added))
    where = kept.columns.index(text)
    # Between passes a document carries what the blocks before have found, in two columns of names that are free.
    state = ["_hits", "_hit_items"]
    while set(state) & set(kept.columns):
        state = [f"_{c}" for c in state]
    between = kept.select("*", F.lit(None).cast("array<bigint>").alias(state[0]), F.lit(None).cast("array<bigint>").alias(state[1])).schema
    result = kept.select("*", *(F.lit(None).cast(kind).alias(name) for name, kind in RESULT.items())).schema

    def scanner(block, first: bool, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = _automaton(block.value) if block.value else None
            for batch in sliced_texts(batches, where, 512):
                texts = utf8(batch.column(where))
                normal = [words(t) for t in texts]
                found = [scan(automaton, w) if w and automaton else ([], set()) for w in normal]
                own, held = batch.columns, batch.schema.names
                if not first:
                    *own, hits, ids = own
                    held = held[:-2]
                    for (ranges, items_), r, i in zip(found, hits.to_pylist(), ids.to_pylist()):
                        ranges += zip(r[::2], r[1::2])
                        items_.update(i)
                joined = [merged(r) for r, _ in found]
                ids = [sorted(i) for _, i in found]
                if last:
                    columns, names = _report(texts, normal, joined, ids), added
                else:
                    columns = [pa.array([[x for p in r for x in p] for r in joined], pa.list_(pa.int64())), pa.array(ids, pa.list_(pa.int64()))]
                    names = state
                yield pa.RecordBatch.from_arrays([*own, *columns], names=[*held, *names])

        return run

    found = kept
    for i, block in enumerate(cut):
        last = i == len(cut) - 1
        found = found.mapInArrow(scanner(spark.sparkContext.broadcast(block), i == 0, last), result if last else between)
        if not last:
            found = stored(found, "hits")
    return found


def _report(texts: list, normal: list, joined: list, ids: list) -> list[pa.Array]:
    """The result's columns."""
    n_hit = [sum(b - a for a, b in r) for r in joined]
    spans = [original_spans(t, r) if r else [] for t, r in zip(texts, joined)]
    return [
        pa.array([len(w) for w in normal], pa.int64()), pa.array(n_hit, pa.int64()),
        pa.array([len(i) for i in ids], pa.int64()), pa.array([_digest(i) for i in ids], pa.string()),
        pa.array([n > 0 for n in n_hit], pa.bool_()), pa.array(ids, pa.list_(pa.int64())),
        pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
    ]


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents without a test item's window, in their own columns, also those that `contamination` would replace."""
    others = {c: free_name(docs.columns, f"_own_{c}") for c in docs.columns if c in RESULT}
    found = contamination(docs.withColumnsRenamed(others), items, **options)
    return found.where("not contaminated").select(*(F.col(f"`{others.get(c, c)}`").alias(c) for c in docs.columns))
