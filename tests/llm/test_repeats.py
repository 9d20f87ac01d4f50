"""Repeated passages against brute force."""

import hashlib
import random

import numpy as np
import pytest

from sftlake.llm import repeats


def brute_factors(strings, need):
    """Per position of the strings laid end to end, the longest string that also starts earlier."""
    starts = [(s, i) for s in range(len(strings)) for i in range(len(strings[s]))]
    out = []
    for n, (s, i) in enumerate(starts):
        best = 0
        for t, j in starts[:n]:
            k = 0
            while k < need and i + k < len(strings[s]) and j + k < len(strings[t]) and strings[s][i + k] == strings[t][j + k]:
                k += 1
            best = max(best, k)
        out.append(best)
    return out


@pytest.mark.parametrize("need", [8, 11, 32])
def test_longest_previous_factors(need):
    rng = random.Random(need)
    strings = [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(1, 40))) for _ in range(12)]
    strings += [strings[3], strings[5] + b"ab", b"a" * 50, b"\0" * 20, b"\0" * 9]
    sizes = np.array([len(s) for s in strings])
    raw = np.frombuffer(b"".join(strings), np.uint8)
    rest = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(raw))
    want = brute_factors(strings, need)
    assert repeats.longest_previous_factors(raw, rest, need).tolist() == want
    assert repeats.previous_factor_reaches(raw, rest, need).tolist() == [x == need for x in want]


def test_previous_smaller_places():
    rng = np.random.default_rng(1)
    for order in (rng.permutation(500), np.arange(300), np.arange(300)[::-1], np.empty(0, np.int64)):
        want = [max((j for j in range(i) if order[j] < order[i]), default=-1) for i in range(len(order))]
        assert repeats.smaller_before(order).tolist() == want


def brute(rows, need):
    texts = [(d, t or "") for d, t in rows]
    order = sorted({(d is not None, d or 0, t.encode()) for d, t in texts})
    seen, gone = set(), {}
    for key in order:
        raw = key[2]
        marks = bytearray(len(raw))
        for i in range(len(raw) - need + 1):
            s = raw[i : i + need]
            if s in seen:
                marks[i : i + need] = b"\1" * need
            seen.add(s)
        gone[key] = bytes(marks)
    out = []
    for d, t in texts:
        raw, marks = t.encode(), gone[d is not None, d or 0, t.encode()]
        kept = bytes(b for b, m in zip(raw, marks) if not m)
        spans = sum(1 for i, m in enumerate(marks) if m and (i == 0 or not marks[i - 1]))
        out.append((d, len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, **options):
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id bigint, text string, batch int, th int")
    return sorted((tuple(r) for r in repeats.remove_repeats(df, **options).drop("spans").collect()), key=str)


def corpus(rng, n, words=300):
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9))) for _ in range(words)]
    prose = lambda k: " ".join(rng.choice(vocabulary) for _ in range(k))
    shared = [prose(rng.randint(8, 60)) for _ in range(6)]
    phrase = prose(8)[:45]
    rows = []
    for i in range(n):
        text = prose(rng.randint(0, 80))
        if i % 3 == 0:
            text += rng.choice(shared) + prose(rng.randint(0, 30)) + rng.choice(shared)
        if i % 4 == 0:  # a frequent phrase in contexts of its own
            text += " " + phrase + " " + prose(20)
        if i % 7 == 0 and rows:  # near copies
            text = rng.choice(rows)[1]
            at = rng.randrange(len(text) + 1)
            text = text[:at] + "#" + text[at:]
        rows.append((i, text))
    return rows


@pytest.mark.parametrize("group", [4096, 3])
def test_equals_brute_force(spark, monkeypatch, group):
    rng = random.Random(group)
    rows = corpus(rng, 150)
    rows += [(1000 + i, rows[9][1]) for i in range(20)]  # exact copies
    rows += [(2000, None), (2001, ""), (2002, "x" * 99), (2003, "y" * 100), (2004, "z" * 700), (2005, "ab" * 400), (2006, "q" + "z" * 300)]
    assert got(spark, rows, batch_bytes=4000, group_fragments=group) == brute(rows, 100)


def test_hot_anchors_across_arrays(spark, monkeypatch):
    """A third of all documents hold one passage, each with a context of its own on both sides."""
    monkeypatch.setattr(repeats, "ARRAY_BYTES", 500)
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(70))
    tail = "".join(rng.choice("abcdefgh ") for _ in range(60))
    rows = [(i, f"{i:040d}" + passage + (tail if i % 2 else "") + f"{i * 7919:060d}") for i in range(120)]
    assert got(spark, rows, batch_bytes=2000, group_fragments=4) == brute(rows, 100)


def test_ids_null_repeated_and_equal_rows(spark):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdef ") for _ in range(400))
    rows = [(None, text), (None, text[100:] + "x"), (5, text), (5, text), (5, text[:150] + "other"), (4, text[50:250])]
    found = got(spark, rows)
    # A null id comes before all others: one of its two documents keeps what they share, and no other document does.
    assert sorted(r[2] for r in found if r[0] is None) == [0, 300]
    assert sorted(r[2] for r in found if r[0] == 5) == [150, 400, 400] and [r[2] for r in found if r[0] == 4] == [200]
    assert got(spark, []) == []


def test_a_long_text_in_pieces(spark, monkeypatch):
    rng = random.Random(9)
    block = "".join(rng.choice("abcdefghij \n") for _ in range(3000))
    rows = [(1, block + "Ü" * 150 + block[:2500] + "!" + block[100:]), (2, block)]
    want = brute(rows, 100)
    monkeypatch.setattr(repeats, "PIECE", 512)
    assert repeats.fragments([r[1].encode() for r in rows], 100)["windows"].sum() == sum(len(r[1].encode()) - 99 for r in rows)
    assert got(spark, rows) == want


def test_remaining_text(spark):
    df = spark.createDataFrame([(1, "k" * 120 + "end"), (2, "k" * 120 + "fin")], "doc_id int, text string")
    spans = repeats.remove_repeats(df.selectExpr("doc_id", "text"))
    left = df.join(spans, "doc_id").select("doc_id", repeats.remaining_text("text", "spans"))
    # Equal letters repeat within the first text too.
    assert dict(map(tuple, left.collect())) == {1: "kend", 2: "fin"}
