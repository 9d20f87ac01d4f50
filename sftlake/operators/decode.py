"""Ids and back to text, exactly: a vocabulary of pieces with the 256 bytes under it.

A text is cut into pieces that cover it (`text.pieces`). A piece that the vocabulary has is one id, another is the ids of its UTF-8 bytes, so
every text has ids and every list of ids has a text. Decoding joins the bytes behind the ids first and reads them as UTF-8 then: a character whose bytes
come from several ids is whole again, and one of which bytes are missing becomes U+FFFD. Ids that the vocabulary does not have are an error.

A vocabulary table is joined, whatever its size; one that the caller holds travels to the tasks. Neither texts nor ids are joined piece by piece: a
task cuts its rows into blocks, and a block's distinct pieces (or ids) are looked up. The table paths tell rows by
``key``, which has to be unique and not null: anything else is an error where it is found.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, DataType, IntegerType, LongType, StringType, StructField, StructType

from sftlake.functions import text as tx
from sftlake.operators.ordering import digest, number_by_digest, required

BYTES = 256
#: Items (pieces or ids) and rows of a block; a longer row is a block of its own.
BLOCK, BLOCK_ROWS = 1 << 20, 8192


def byte_vocabulary(words: DataFrame, special_tokens: Sequence[str] = ()) -> DataFrame:
    """(id, piece, hex) of the single bytes (0 to 255, no piece), the special tokens, and the distinct pieces of ``words`` (piece) in digest order."""
    spark = words.sparkSession
    single = spark.range(BYTES).select(
        F.col("id").cast("bigint").alias("id"), F.lit(None).cast("string").alias("piece"), F.lpad(F.hex("id"), 2, "0").alias("hex")
    )
    fixed = spark.createDataFrame([(BYTES + i, t) for i, t in enumerate(special_tokens)], "id bigint, piece string")
    own = words.select("piece").where(F.col("piece").isNotNull() & ~F.col("piece").isin("", *special_tokens)).distinct()
    numbered = number_by_digest(own, digest(F.col("piece"), 0), "piece")
    pieces = fixed.unionByName(numbered.select((F.col("_rn") + F.lit(BYTES + len(special_tokens))).cast("bigint").alias("id"), "piece"))
    return single.unionByName(pieces.withColumn("hex", F.hex(F.encode("piece", "UTF-8"))))


def _unique(df: DataFrame, key: str, like: DataFrame) -> DataFrame:
    """No rows, with the columns of ``like``; an error where a key comes twice. Only the keys are read."""
    counted = df.select(required(key).alias("_key")).groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    told = F.raise_error(F.concat(F.lit(f"{key} is not unique: "), F.col("_key").cast("string"), F.lit(", rows: "), F.col("_n").cast("string")))
    none = counted.where(F.when(F.col("_n") > 1, told).isNotNull())
    return none.select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema))


#: Of distinct items and what the vocabulary has for them: the values of all, one after another, and how many each has.
Emit = Callable[[pa.Array, pa.Array], tuple[np.ndarray, np.ndarray]]


def _blocks(batches: Iterator[pa.RecordBatch], shape: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Of rows (key, items): per block its own row (pos -1) with keys, lengths and numbers of the items, and a row for each distinct item.

    The block's own row is bytes, not lists: what Spark hands to the next worker it measures row by row, and a list column without values is gone through again each time.
    """
    from pyspark import TaskContext

    part, no = TaskContext.get().partitionId(), 0
    for batch in batches:
        lengths = pc.list_value_length(batch.column("items"))  # none of a null list
        ends = np.cumsum(lengths.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            stop = min(max(at + 1, int(np.searchsorted(ends, before + BLOCK, "right"))), at + BLOCK_ROWS)
            rows = pa.RecordBatch.from_arrays([batch.column("key").slice(at, stop - at), lengths.slice(at, stop - at)], names=["key", "size"])
            numbered = pc.list_flatten(batch.column("items").slice(at, stop - at)).dictionary_encode(null_encoding="encode")
            n = len(numbered.dictionary)
            codes = numbered.indices.to_numpy(zero_copy_only=False).astype("<u2" if n <= 1 << 16 else "<u4").tobytes()
            with pa.BufferOutputStream() as sink:
                with pa.ipc.new_stream(sink, rows.schema) as out:
                    out.write_batch(rows)
                head = sink.getvalue().to_pybytes()
            own = _HEAD.pack(n, len(head)) + head + codes
            # Named by its digest, a block of a task that is repeated with its rows in another order is not mistaken for this one.
            name = hashlib.blake2b(own, digest_size=8, salt=_HEAD.pack(part, no)).digest()
            block = int.from_bytes(name, "little", signed=True)
            yield pa.RecordBatch.from_pydict({"block": [block], "pos": [-1], "entry": [None], "own": [own]}, shape)
            for lo in range(0, n, 1 << 14):
                entries = numbered.dictionary.slice(lo, 1 << 14)
                m = len(entries)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(m, block)), pa.array(np.arange(lo, lo + m, dtype=np.int32)), entries.cast(shape.field("entry").type), pa.nulls(m, pa.binary())], schema=shape
                )
            at, no = stop, no + 1


#: How many distinct items a block has, and how long its table of rows is.
_HEAD = struct.Struct("<qq")


def _put_together(table: pa.Table, emit: Emit) -> tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]:
    """Of a block with what its items were found to be: keys, lengths in items, all values, and where each row's values end."""
    pos = table.column("pos").to_numpy()
    order = np.argsort(pos, kind="stable")
    own = table.column("own")[int(order[0])].as_py()
    n, size = _HEAD.unpack_from(own) if own is not None else (-1, 0)
    if n + 1 != len(pos) or not np.array_equal(pos[order], np.arange(-1, n)):
        raise ValueError(f"block {table.column('block')[0]} is not whole: a task was repeated with its rows in another order")
    rows = pa.ipc.open_stream(own[_HEAD.size:_HEAD.size + size]).read_next_batch()
    codes = np.frombuffer(own, "<u2" if n <= 1 << 16 else "<u4", offset=_HEAD.size + size)
    values, sizes = emit(*(table.column(c).combine_chunks().take(pa.array(order[1:])) for c in ("entry", "value")))
    size = sizes[codes]
    within = np.cumsum(size)
    total = int(within[-1]) if len(within) else 0
    kind = np.int32 if max(total, len(values)) < 1 << 31 else np.int64
    at = np.repeat(((np.cumsum(sizes) - sizes)[codes] - (within - size)).astype(kind), size)
    at += np.arange(total, dtype=kind)
    flat = values[at]
    ends = np.cumsum(rows.column("size").fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    return rows.column("key"), rows.column("size"), flat, np.concatenate(([0], within))[ends]


def _looked_up(rows: DataFrame, known: DataFrame, put: Callable[[pa.Table], pa.Table], out: DataType) -> DataFrame:
    """(key, out) of rows (key, items), made by ``put`` from blocks of which each distinct item was looked up in ``known`` (entry, value).

    A row for each distinct item of a block is joined, and keeps its item only where that is not known; beside them a block moves as keys, lengths
    and numbers of two or four bytes.
    """
    cut = StructType([
        StructField("block", LongType()), StructField("pos", IntegerType()), StructField("entry", rows.schema["items"].dataType.elementType), StructField("own", BinaryType()),
    ])
    shape = to_arrow_schema(cut)
    blocks = rows.mapInArrow(lambda batches: _blocks(batches, shape), cut)
    # A block's own row is no entry, and finds nothing: its name only spreads these rows.
    by = F.coalesce("entry", F.col("block").cast(cut["entry"].dataType))
    found = blocks.withColumn("_by", by).join(known.select(F.col("entry").alias("_by"), "value"), "_by", "left")
    value = F.when(F.col("entry").isNotNull(), F.col("value"))
    told = found.select("block", "pos", F.when(value.isNull(), F.col("entry")).alias("entry"), "own", value.alias("value"))
    return told.groupBy("block").applyInArrow(put, StructType([StructField("key", rows.schema["key"].dataType), StructField("out", out)]))


def encode_exact(df: DataFrame, vocab: DataFrame, key: str, text: str, special_tokens: Sequence[str] = (), ids: str = "ids") -> DataFrame:
    """(key, ids) of every row; a null text has no ids. Texts are cut once, and do not move."""
    rows = df.select(required(key).alias("key"), tx.pieces(F.coalesce(F.col(text), F.lit("")), special_tokens).alias("items"))
    known = vocab.where("piece is not null").groupBy(F.col("piece").alias("entry")).agg(F.min("id").cast("bigint").alias("value"))
    key_type = to_arrow_schema(rows.select("key").schema).field("key").type

    def own_ids(pieces: pa.Array, found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        unknown = found.is_null()
        spelt, is_spelt = pieces.filter(unknown), unknown.to_numpy(zero_copy_only=False)
        sizes = np.ones(len(found), np.int64)
        sizes[is_spelt] = pc.binary_length(spelt).to_numpy(zero_copy_only=False)
        flat, of_spelt = np.empty(int(sizes.sum()), np.int64), np.repeat(is_spelt, sizes)
        flat[of_spelt] = np.frombuffer(b"".join(spelt.cast(pa.binary()).to_pylist()), np.uint8)
        flat[~of_spelt] = found.drop_null().to_numpy(zero_copy_only=False)
        return flat, sizes

    def put(table: pa.Table) -> pa.Table:
        keys, _, flat, ends = _put_together(table, own_ids)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), pa.array(flat))
        return pa.table([keys.cast(key_type), lists], names=["key", "out"])

    coded = _looked_up(rows, known, put, ArrayType(LongType())).select(F.col("key").alias(key), F.col("out").alias(ids))
    return coded.unionByName(_unique(df, key, coded))


def decode_ids(df: DataFrame, vocab: DataFrame, key: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """(key, text) of every row; null ids are no text, an empty list is the empty one. The rows are read twice, for their ids and for their keys: store them."""
    rows = df.select(required(key).alias("key"), F.col(ids).cast("array<bigint>").alias("items"))
    known = vocab.groupBy(F.col("id").cast("bigint").alias("entry")).agg(F.first("hex").alias("value"))
    key_type = to_arrow_schema(rows.select("key").schema).field("key").type

    def own_bytes(given: pa.Array, found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        for i in given.filter(found.is_null()).to_pylist():
            raise ValueError(f"no such id: {'null' if i is None else i}")
        return np.frombuffer(bytes.fromhex("".join(found.to_pylist())), np.uint8), pc.binary_length(found).to_numpy(zero_copy_only=False).astype(np.int64) // 2

    def put(table: pa.Table) -> pa.Table:
        keys, lengths, flat, ends = _put_together(table, own_bytes)
        data = flat.tobytes()
        texts = [None if n is None else data[a:b] for n, a, b in zip(lengths.to_pylist(), [0, *ends[:-1].tolist()], ends.tolist())]
        return pa.table([keys.cast(key_type), pa.array(texts, pa.binary())], names=["key", "out"])

    raw = _looked_up(rows, known, put, BinaryType())
    back = raw.select(F.col("key").alias(key), F.make_valid_utf8(F.col("out").cast("string")).alias(text))
    return back.unionByName(_unique(df, key, back))


def decode_ids_in_memory(df: DataFrame, vocab: Mapping[int, bytes], ids: str = "ids", text: str = "text") -> DataFrame:
    """`decode_ids` with a vocabulary that the caller holds; rows need no key and nothing is shuffled."""
    table = dict(vocab)

    @F.arrow_udf("string")
    def decoded(batch: pa.Array) -> pa.Array:
        lists = batch.to_pylist()
        return pa.array([None if own is None else b"".join([table[i] for i in own]).decode("utf-8", "replace") for own in lists], pa.string())

    return df.withColumn(text, decoded(F.col(ids)))


def round_trip(df: DataFrame, back: DataFrame, key: str, text: str) -> DataFrame:
    """Rows whose decoded text is not the text, with both lengths."""
    decoded = back.select(F.col(key), F.col(text).alias("_back"))
    same = F.coalesce(F.col(text), F.lit("")) == F.coalesce(F.col("_back"), F.lit(""))
    return df.select(key, text).join(decoded, key, "left").where(~same).select(
        key, F.length(text).alias("length"), F.length("_back").alias("decoded_length")
    )
