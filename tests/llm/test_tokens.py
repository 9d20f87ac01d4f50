"""Token files and token counts against the tokenizers library."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sftlake.llm import token_counts as tc
from sftlake.llm import token_files as tf
from sftlake.llm.bpe import ByteBpe
from sftlake.llm.common import vocabulary

DOCS = [
    (3, "The cat sat on the mat. " * 40, "a"), (1, None, "a"), (2, "", None), (5, "same\nline\n\nsame line", "b"),
    (5, "same\nline\n\nsame line", "b"), (4, "naïve 你好  two  spaces\t\r\n<|endoftext|> #", "c"), (None, "no id", "c"),
    (9, "x" * 5000 + " " + "word " * 4000, "d"),
]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(vocabulary())
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe(vocabulary())


def frame(spark, rows=DOCS):
    # Extra columns, one of which has a name that the operators use inside.
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id bigint, text string, source string, n_tokens int")


def test_encoder_equals_library(bpe, library):
    rng = random.Random(4)
    parts = ["a", "Bc", " ", "\n", "\t", "12", "'s", ".", "é", " ", " x", "\x1c", "\r\n", "\x00", "　", "<|endoftext|>", " "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    for got, text in zip(bpe.encode(texts), texts):
        assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), min_size=1, max_size=60), min_size=1, max_size=6), st.integers(1, 5))
def test_repair_round_trip(docs, rounds):
    row = tf._shard(0, 0, [(i, np.array(d, "<u4").tobytes()) for i, d in enumerate(docs)], 6, {"rounds": rounds, "min_count": 2, "most": 500})
    assert [d.tolist() for d in tf.decode_shard(row)] == docs
    rules = np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
    lengths = np.frombuffer(row["rule_lengths"], "<u4")
    for i, n in enumerate(lengths):
        assert len(tf.expand(np.array([6 + i], np.uint32), rules, 6)) == n
    for i, d in enumerate(docs):
        a, b = sorted((len(d) // 3, len(d) - len(d) // 4))
        if a < b:
            assert tf.decode_range(row, i, a, b).tolist() == d[a:b]


def test_repair_replaces_frequent_pairs():
    ids = np.tile(np.array([7, 8, 9], np.uint32), 400)
    ends = np.zeros(len(ids), bool)
    ends[[-1, 599]] = True
    symbols, last, rules = tf.repair(ids, ends, 50257)
    assert len(symbols) < len(ids) / 2 and last.sum() == 2 and len(rules)


def test_repair_leaves_no_frequent_pair():
    rng = np.random.default_rng(2)
    passage = rng.integers(0, 50257, 500).astype(np.uint32)
    docs = [np.concatenate([rng.integers(0, 50257, 40).astype(np.uint32), passage]) for _ in range(60)]
    ids, ends = np.concatenate(docs), np.zeros(540 * 60, bool)
    ends[539::540] = True
    symbols, last, rules = tf.repair(ids, ends, 50257)
    pairs = Counter(zip(symbols[:-1][~last[:-1]].tolist(), symbols[1:][~last[:-1]].tolist()))
    assert max(pairs.values()) < 24
    assert len(symbols) < 60 * (40 + 2)  # the passage is one symbol, up to what joins its start
    assert (tf.expand(symbols, rules, 50257) == ids).all() and last.sum() == 60


@pytest.mark.parametrize("shard_ids", [50, 1 << 20])
def test_files_round_trip(spark, library, tmp_path, shard_ids):
    path = str(tmp_path / "tokens")
    tf.write_tokens(frame(spark), path, vocabulary(), shard_ids=shard_ids, min_count=4)
    got = sorted(map(tuple, tf.read_token_digests(spark, path).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, 1, 2, 3, 4, 5, 5, 9]
    start = 0
    texts = {d: t for d, t, _ in DOCS}
    for doc, at, n, crc in got:
        ids = library.encode(texts[doc] or "", add_special_tokens=False).ids + [2]
        assert (at, n, crc) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += n
    some = tf.read_documents(spark, path, spark.createDataFrame([(3,), (9,)], "doc_id bigint")).collect()
    assert {r.doc_id: r.ids for r in some} == {
        d: library.encode(texts[d], add_special_tokens=False).ids + [2] for d in (3, 9)
    }
    assert tf.read_documents(spark, path).count() == len(DOCS)


def test_files_of_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    tf.write_tokens(frame(spark).where("false"), path, vocabulary())
    assert tf.read_token_digests(spark, path).count() == 0


def test_counts_equal_library_offsets(spark, library):
    got = Counter()
    for r in tc.token_counts(frame(spark), vocabulary(), fields=("source", "text")).collect():
        got[(r.doc_id, r.field, r.section)] += r.n_tokens
    want = Counter()
    for doc, text, source in DOCS:
        whole = (source or "") + "\n" + (text or "")
        for start, _ in library.encode(whole, add_special_tokens=False).offsets:
            k = whole.count("\n", 0, start)
            want[(doc, "source", 0) if k == 0 else (doc, "text", k - 1)] += 1
    assert {k: v for k, v in got.items() if v} == dict(want)
    assert (1, "text", 0) in got and (2, "source", 0) in got
    assert tc.token_counts(frame(spark).where("false"), vocabulary()).count() == 0


@given(st.lists(st.integers(1, 6), min_size=1, max_size=30), st.data())
@settings(max_examples=80, deadline=None)
def test_allocation_rules(tokens, data):
    total = sum(tokens)
    cuts = sorted(data.draw(st.lists(st.integers(0, total), max_size=8)))
    sections = np.diff([0, *cuts, total])
    owner = np.repeat(np.arange(len(sections)), sections)
    begin = np.cumsum(tokens) - tokens
    want = {r: np.zeros(len(sections)) for r in tc.RULES}
    crossing = np.zeros(len(sections), int)
    for b, n in zip(begin, tokens):
        own = owner[b : b + n]
        want["start"][own[0]] += 1
        want["end"][own[-1]] += 1
        want["majority"][np.bincount(own).argmax()] += 1
        for s in set(own):
            want["split"][s] += (own == s).sum() / n
            crossing[s] += len(set(own)) > 1
    for rule in tc.RULES:
        counts, crossed = tc.allocate(np.array(tokens), sections, rule)
        assert np.allclose(counts, want[rule]) and crossed.tolist() == crossing.tolist()
        assert abs(counts.sum() - len(tokens)) < 1e-9


@pytest.fixture(scope="module")
def default_library():
    return Tokenizer.from_file(vocabulary())


def test_encoder_equals_library_with_special_tokens(default_library):
    rng = random.Random(5)
    parts = ["a", "Bc", " ", "\n", "\t", "12", "'s", ".", "é", " ", " x", "\x1c", "\r\n", "\x00", "　", "<|endoftext|>", "<|endoftext|>", "  "]
    texts = ["end of page <|endoftext|> next"] + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(6000)]
    got = [np.frombuffer(b, "<u4").tolist() for b in ByteBpe(vocabulary(), special_tokens=True).encode(texts)]
    assert got[0] == [437, 286, 2443, 220, 50256, 1306]
    for ids, text in zip(got, texts):
        assert ids == default_library.encode(text, add_special_tokens=False).ids, repr(text)


def test_queries_equal_the_default_library(spark, default_library, tmp_path):
    import corpus_pipeline
    from sftlake.llm import queries

    docs = spark.createDataFrame(
        [(1, "end of page <|endoftext|> next", "en", "a", 30), (2, "x<|endoftext|>\n<|endoftext|>y z", "en", "b<|endoftext|>", 31)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    texts = {r.doc_id: r for r in docs.collect()}
    want = [default_library.encode(texts[i].text, add_special_tokens=False).ids + [2] for i in (1, 2)]
    files = [queries.op1_token_files(spark, str(tmp_path)), corpus_pipeline.write_token_files(spark, docs, str(tmp_path))]
    for found in files:
        rows = sorted(found.select("doc_id", "start", "n_tokens", "ids_crc32").collect())
        assert [r[1:] for r in map(tuple, rows)] == [
            (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for at, ids in zip((0, len(want[0])), want)
        ]
    counted = Counter()
    for r in queries.op10_token_counts(spark, str(tmp_path)).collect():
        counted[r.doc_id] += r.n_tokens
    assert counted == {i: len(default_library.encode(f"{r.source}\n{r.text}", add_special_tokens=False).ids) for i, r in texts.items()}


def test_chunks_without_spaces_are_kept_in_no_table(library):
    rng = random.Random(1)
    bpe = ByteBpe(vocabulary())
    texts = ["".join(chr(rng.randint(0x4E00, 0x9FFF)) for _ in range(1000)) for _ in range(300)] + ["short words here"] * 3
    ids = bpe.encode(texts)
    assert [np.frombuffer(b, "<u4").tolist() for b in ids[:20]] == [library.encode(t, add_special_tokens=False).ids for t in texts[:20]]
    assert sorted(bpe.known.place) == sorted(["\x00short", "words", "here"]) and bpe.known.bytes() < 1000 and bpe.known.entries == 3


def test_tables_are_bounded_by_bytes(monkeypatch, library):
    from sftlake.llm import bpe as module

    monkeypatch.setattr(module, "CACHE_BYTES", 20_000)
    bpe = ByteBpe(vocabulary())
    rng = random.Random(2)
    for _ in range(30):
        texts = [" ".join(f"w{rng.randint(0, 5000)}" for _ in range(60)) for _ in range(5)]
        got = bpe.encode(texts)
        assert [np.frombuffer(b, "<u4").tolist() for b in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]
        most = 20_000 + 300 * 250  # a table is left when it is full, after a batch
        assert bpe.known.bytes() <= most and bpe.older.bytes() <= most and bpe.known.entries == len(bpe.known.place)
    assert bpe.older.place


def test_shards_do_not_move_for_their_starts(spark, tmp_path):
    from conftest import plan

    rows = [(i, "word " * (i % 50), "s") for i in range(400)]
    tf.write_tokens(frame(spark, rows), str(tmp_path / "t"), vocabulary(), shard_ids=500)
    placed = tf.shard_starts(tf.read_shards(spark, str(tmp_path / "t")))
    text = plan(placed)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    got = placed.orderBy("part", "shard").collect()
    assert len(got) > 10 and [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]


def test_deep_rules_decode():
    """One token over and over: rules of ever more ids, written out level by level beyond the flat ones."""
    ids = np.full(100_000, 7, np.uint32)
    ends = np.zeros(len(ids), bool)
    ends[[49_999, 99_999]] = True
    symbols, last, rules = tf.repair(ids, ends, 50257, min_count=2)
    assert len(symbols) < 60 and last.sum() == 2 and (tf.rule_lengths(rules, 50257) > tf.FLAT).any()
    assert (tf.expand(symbols, rules, 50257) == ids).all()


def test_signs_around_words_make_no_new_pieces(library):
    """A word is learned once, whatever signs or digits stand around it."""
    words = ["".join(chr(97 + (i * k) % 26) for k in range(3, 9)) + "x" * (i % 3) for i in range(100)]
    ends = [",", ".", "!", "$$$", "***", ")", "%%%", "-7", "'s"]
    texts = [" ".join(f"{w}{e}" for w in words) + "\n" + "\n".join(f"{w}{e}" for w in words) for e in ends]
    bpe = ByteBpe(vocabulary())
    assert [np.frombuffer(b, "<u4").tolist() for b in bpe.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(bpe.known.place) <= 2 * len(set(words)) + 2 * len(ends)  # behind a space, and behind a newline


@pytest.mark.parametrize("special_tokens", [False, True])
def test_cuts_equal_library(special_tokens, library, default_library):
    """Letters, digits, signs, apostrophes and white space beyond ASCII in any order."""
    rng = random.Random(6)
    parts = ["a", "Bc", " ", "  ", "\n", "\t", "12", "'", "'s", "'re", "r", "e", ".", "$", "é", "à", "ñ", "ſ", "中", "Ж", "😀", "²", "̀", "\u0085", " ",
             " ", " ", " ", "　", "\x1c", "\x7f", "\x00", "\r\n", "<|", "|>", "-", "<|endoftext|>", " l'é"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    want = (default_library if special_tokens else library).encode_batch(texts, add_special_tokens=False)
    bpe = ByteBpe(vocabulary(), special_tokens)
    got = [b for at in range(0, len(texts), 500) for b in bpe.encode(texts[at : at + 500])]
    for ids, e, text in zip(got, want, texts):
        assert np.frombuffer(ids, "<u4").tolist() == e.ids, repr(text)


def test_slices_are_gathered_in_blocks(monkeypatch):
    from sftlake.llm import common

    monkeypatch.setattr(common, "GATHERED", 3)
    values, start, size = np.arange(20, dtype=np.uint32), np.array([5, 0, 17]), np.array([4, 0, 3])
    which = np.array([2, 1, 0, 0, 2, 1, 0])
    out, sizes = common.gathered(values, start, size, which)
    assert out.tolist() == [x for w in which for x in range(start[w], start[w] + size[w])] and sizes.tolist() == size[which].tolist()


@pytest.mark.parametrize("shard_ids", [40, 1 << 20])
def test_files_are_equal_whether_pieces_are_kept_or_not(spark, library, shard_ids):
    rows = frame(spark, [(i, f"{'lorem ipsum ' * (i % 7)}no{i}", "s") for i in range(300)] + [(None, None, None), (7, "", "s")])
    kept, anew = (
        sorted(map(str, tf.token_shards(rows, vocabulary(), shard_ids=shard_ids, min_count=4, keep_pieces=k).collect())) for k in (True, False)
    )
    assert kept and kept == anew
