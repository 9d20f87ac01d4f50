"""Exact ids and their decoding."""

import random

import pytest

from sftlake.operators import decode as de
from sftlake.operators.examples import SPECIAL_TOKENS

TEXTS = [
    "<think>\nGrüße, 世界!\n</think>\n<answer>\nprint('👍🏽')\n</answer><|im_end|>", "", None, "   \t\n\n x", "naïve naïve café", "a<b <|odd|> <|",
    "　wide space\x0bvt\x85", "👍" * 50, "1234 x1y2",
]


@pytest.fixture
def vocab(spark):
    words = spark.createDataFrame([("naïve",), (" ",), ("print",), ("\n",), ("世",), (None,), ("",), ("<think>",)], "piece string")
    return de.byte_vocabulary(words, SPECIAL_TOKENS)


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "k bigint, text string")


def test_round_trip(spark, vocab):
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice("aé世👍 <>|\n\t1.") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    df = frame(spark, texts)
    ids = de.encode_exact(df, vocab, "k", "text", SPECIAL_TOKENS)
    back = de.decode_ids(ids, vocab, "k")
    assert {r.k: r.text for r in back.collect()} == {i: t or "" for i, t in enumerate(texts)}
    assert de.round_trip(df, back, "k", "text").count() == 0
    table = {r.id: bytes.fromhex(r.hex) for r in vocab.collect()}
    assert {r.k: r.text for r in de.decode_ids_in_memory(ids, table).collect()} == {i: t or "" for i, t in enumerate(texts)}


def test_vocabulary_is_a_bijection(spark, vocab):
    rows = vocab.collect()
    assert sorted(r.id for r in rows) == list(range(256 + len(SPECIAL_TOKENS) + 5))
    assert len({r.hex for r in rows if r.piece is not None}) == len([r for r in rows if r.piece is not None])
    ids = de.encode_exact(frame(spark, ["naïve", "<think>", "é"]), vocab, "k", "text", SPECIAL_TOKENS)
    got = {r.k: r.ids for r in ids.collect()}
    assert len(got[0]) == 1 and got[1] == [256] and got[2] == list("é".encode())


def test_characters_across_ids_and_broken_ones(spark, vocab):
    raw = "世".encode()
    lists = [list(raw), list(raw[:2]), [*raw[:1], 65], [0xFF], [65, *raw, 0xC3], [], None]
    df = spark.createDataFrame(list(enumerate(lists)), "k bigint, ids array<bigint>")
    want = {i: None if own is None else bytes(own).decode("utf-8", "replace") for i, own in enumerate(lists)}
    assert {r.k: r.text for r in de.decode_ids(df, vocab, "k").collect()} == want
    table = {r.id: bytes.fromhex(r.hex) for r in vocab.collect()}
    assert {r.k: r.text for r in de.decode_ids_in_memory(df, table).collect()} == want


@pytest.mark.parametrize("keys, message", [([1, 1], "not unique"), ([1, None], "null")])
def test_keys_that_tell_no_rows(spark, vocab, keys, message):
    for texts in (["a b", "c d"], ["", ""]):
        df = spark.createDataFrame(list(zip(keys, texts)), "k bigint, text string")
        with pytest.raises(Exception, match=message):
            de.encode_exact(df, vocab, "k", "text").collect()


def test_unknown_ids(spark, vocab):
    df = spark.createDataFrame([(1, [70, 99999])], "k bigint, ids array<bigint>")
    with pytest.raises(Exception, match="no such id: 99999"):
        de.decode_ids(df, vocab, "k").collect()


def test_texts_are_cut_once(spark, vocab, tmp_path):
    frame(spark, TEXTS).write.parquet(str(tmp_path / "texts"))
    ids = de.encode_exact(spark.read.parquet(str(tmp_path / "texts")), vocab, "k", "text", SPECIAL_TOKENS)
    text = ids._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("regexp_extract_all") == 1


def test_pieces_are_joined_once_per_block(spark, vocab):
    from itertools import islice, product

    from conftest import plan

    words = ["".join(w) for w in islice(product("abcdefghijklmnop", repeat=5), 70_000)]  # more than two bytes can number
    texts = [" ".join(words), *(f"naïve print {i % 7}" for i in range(5000)), None, ""]
    df = frame(spark, texts).coalesce(1)
    ids = de.encode_exact(df, vocab, "k", "text", SPECIAL_TOKENS)
    back = de.decode_ids(ids, vocab, "k")
    assert "Generate" not in plan(ids) + plan(back)  # no row per piece
    assert {r.k: r.text for r in back.collect()} == {i: t or "" for i, t in enumerate(texts)}


def nodes(plan):
    yield plan
    for i in range(plan.children().size()):
        yield from nodes(plan.children().apply(i))


def test_blocks_move_without_lists(spark, vocab):
    # What goes to the next worker is measured row by row, and a column of lists without values is gone through again each time.
    df = frame(spark, TEXTS).selectExpr("concat('key ', k) AS k", "text").repartition(3, "k")
    ids = de.encode_exact(df, vocab, "k", "text", SPECIAL_TOKENS)
    back = de.decode_ids(ids, vocab, "k")
    for made in (ids, back):
        grouped = [p for p in nodes(made._jdf.queryExecution().analyzed()) if p.nodeName() == "FlatMapGroupsInArrow"]
        assert grouped and not any("array" in p.children().apply(0).schema().json() for p in grouped)
    assert {r.k: r.text for r in back.collect()} == {f"key {i}": t or "" for i, t in enumerate(TEXTS)}
    table = {r.piece: [r.id] for r in vocab.collect() if r.piece is not None}
    assert {r.k: r.ids for r in ids.collect()}["key 3"] == [i for p in ("   \t\n\n ", "x") for i in table.get(p, list(p.encode()))]


def test_a_block_that_is_not_whole(spark, vocab):
    import pyarrow as pa

    lists = pa.RecordBatch.from_pydict({"key": [1, 2], "items": [["a", "b"], ["b"]]})
    shape = pa.schema([("block", pa.int64()), ("pos", pa.int32()), ("entry", pa.string()), ("own", pa.binary())])

    class Task:
        def partitionId(self):
            return 0

    import pyspark

    before, pyspark.TaskContext.get = pyspark.TaskContext.get, staticmethod(Task)
    try:
        whole = pa.Table.from_batches(de._blocks(iter([lists]), shape))
    finally:
        pyspark.TaskContext.get = before
    rows = whole.append_column("value", pa.array([None, 7, 8], pa.int64()))
    ones = lambda entry, value: (value.to_numpy(), value.is_valid().to_numpy(zero_copy_only=False).astype(int))
    keys, lengths, flat, ends = de._put_together(rows.take([2, 0, 1]), ones)
    assert (keys.to_pylist(), lengths.to_pylist(), flat.tolist(), ends.tolist()) == ([1, 2], [2, 1], [7, 8, 8], [2, 3])
    for some in ([0, 1], [1, 2], [0, 0, 1, 2], [0, 1, 1]):
        with pytest.raises(ValueError, match="not whole"):
            de._put_together(rows.take(some), ones)
