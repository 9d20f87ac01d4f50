"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftlake.session import shared_dir

#: The six ASCII white-space characters of the contracts' patterns, [\x20\x09-\x0D].
SPACES = " \t\n\v\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """A public tokenizer's file; the package that holds it is installed on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame into the shared folder and read it back: lineage ends in replicated files."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def narrow(df: DataFrame, **columns: Column) -> DataFrame:
    """Only the columns an operator needs, under its own names, so that others cannot clash."""
    return df.select(*(c.alias(name) for name, c in columns.items()))


def free_name(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores before it until no column (in any case) has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text (crc32 0)."""
    return F.pmod(F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")), F.lit(modulus))


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """The texts of an Arrow string column as UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: Slices that are gathered at once, so that what is held beside the result stays in a core's cache.
GATHERED = 1 << 14


def gathered(values: np.ndarray, start: np.ndarray, size: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slices of some numbers, told by their starts and sizes, one after another; and the size of each."""
    sizes = size[which]
    out, at = np.empty(int(sizes.sum()), values.dtype), 0
    for i in range(0, len(which), GATHERED):
        own = sizes[i : i + GATHERED]
        place = np.repeat(start[which[i : i + GATHERED]] - (np.cumsum(own) - own), own)
        place += np.arange(len(place))
        out[at : at + len(place)] = values[place]
        at += len(place)
    return out, sizes


def sliced(batches: Iterable[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, so that what a task holds beside its input stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


#: Bytes of text that a task works on at once.
WORK_BYTES = 2 << 20


#: What empties the caches of this worker that outlive a task.
_KEPT: list[Callable[[], None]] = []


def keeps(forget: Callable[[], None]) -> None:
    """Tell that a cache outlives the task; ``forget`` empties it when the worker turns to another operator."""
    if forget not in _KEPT:
        _KEPT.append(forget)


def release() -> None:
    for forget in _KEPT:
        forget()


def give_back() -> None:
    """Hand memory that is free in this process to the system, so that a worker does not go on holding what a task has needed once."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim:
        trim(0)


def ending(batches: Iterator[pa.RecordBatch], forget: Callable[[], None]) -> Iterator[pa.RecordBatch]:
    """The batches, after the worker has emptied what other operators have kept; when the task is done, ``forget`` empties its own caches, and
    their memory goes back. These are functions of modules, so that they reach the worker's caches and not copies."""
    release()
    try:
        yield from batches
    finally:
        forget()
        give_back()


def sliced_texts(batches: Iterable[pa.RecordBatch], column: str, rows: int, most: int = WORK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows and ``most`` bytes of a text column, one row at least: what a task holds beside its
    input is bounded by these, or by its longest text."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            stop = min(max(at + 1, int(np.searchsorted(ends, before + most, "right"))), at + rows)
            yield batch.slice(at, stop - at)
            at = stop
