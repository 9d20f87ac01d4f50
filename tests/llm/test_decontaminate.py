"""Decontamination against brute force, offsets into the original text, blocks of items."""

import hashlib
import re

import pytest

from sftlake.llm import decontaminate as dc

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LONG = " ".join(f"word{i}" for i in range(25))
ITEMS = [(1, "Alpha beta, GAMMA! delta e f g h i j k l"), (2, "short one"), (3, None), (4, "..."), (10, "short ONE"), (1, "Alpha beta, GAMMA! delta e f g h i j k l"), (None, "no name"), (20, LONG)]
DOCS = [
    (1, "xé alpha BETA gamma-delta e f g h i j tail"), (2, "alpha beta gamma delta e f g h i"), (3, None), (4, ""), (5, "a Short, one! and short one again"),
    (6, "pre " + LONG.replace(" ", "\n\t ") + " post"), (None, "short one"), (7, "shortone short-oneX"), (8, "ü" * 30 + " short one"), (5, "a Short, one! and short one again"),
]


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(text):
    w = WORD.findall(lowered(text))
    hit, items = set(), set()
    for item, t in ITEMS:
        v = WORD.findall(lowered(t))
        if item is None or not v:
            continue
        n = min(10, len(v))
        for i in range(len(v) - n + 1):
            for j in range(len(w) - n + 1):
                if w[j : j + n] == v[i : i + n]:
                    hit |= set(range(j, j + n))
                    items.add(item)
    ids = ",".join(sorted(map(str, items)))
    return len(w), len(hit), len(items), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block_bytes", [1, 1 << 20])
def test_equals_brute_force(spark, block_bytes):
    docs = spark.createDataFrame([(*d, 7, "z") for d in DOCS], "doc_id bigint, text string, n_hit int, item_id string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = dc.contamination(docs, items, block_bytes=block_bytes)
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    rows = sorted(map(tuple, got.select(*names).collect()), key=str)
    assert rows == sorted(((d, *brute(t)) for d, t in DOCS), key=str)
    for r in got.collect():
        for s in r.spans:
            part = lowered(r.text[s.start : s.stop])
            assert WORD.fullmatch(part[0]) and WORD.fullmatch(part[-1]) and brute(part)[4]
    clean = dc.decontaminate(docs, items)
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == [2, 3, 4, 7]


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert dc.contamination(docs.where("false"), items).count() == 0
    assert dc.contamination(docs, items.where("false")).where("contaminated").count() == 0


def test_two_blocks_are_two_scans(spark, monkeypatch):
    docs = spark.createDataFrame([(d, t, [1]) for d, t in DOCS], "doc_id bigint, text string, _hits array<int>")
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    written, stored = [], dc.stored
    monkeypatch.setattr(dc, "stored", lambda df, name: (written.append(name), stored(df, name))[1])
    whole = dc.contamination(docs, items)
    assert not written
    size = sum(len(w) + 64 for _, t in ITEMS if t for w in dict.fromkeys(dc.windows(t.encode())))
    halves = dc.contamination(docs, items, block_bytes=size // 2)
    assert len(written) == 1  # one scan before this one
    assert sorted(map(str, whole.collect())) == sorted(map(str, halves.collect())) and "_hits" in halves.columns


def test_a_very_long_text(spark):
    long = "filler words " * 200_000 + LONG + " filler" * 50_000
    docs = spark.createDataFrame([(1, long), (2, "short one")], "doc_id bigint, text string")
    got = {r.doc_id: r for r in dc.contamination(docs, spark.createDataFrame([(20, LONG)], "item_id bigint, text string")).collect()}
    assert (got[1].n_words, got[1].n_hit, got[2].contaminated) == (450_025, 25, False)
    assert long[got[1].spans[0].start : got[1].spans[0].stop] == LONG
