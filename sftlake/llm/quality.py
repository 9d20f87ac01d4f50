"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

The score of a document with features x is sigmoid(w0 + sum w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j). The pairwise
sum takes time linear in the features by the identity
sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ].

Features are words hashed into ``BUCKETS`` slots (square roots of counts, scaled to length one), statistics of the
text's structure, and the length that the table states. Neither labels nor ids, sources or languages are inputs of a
score. The model is fitted on the driver on at most ``sample`` labelled rows, chosen by a hash of their id; it
has a fixed size and goes to the tasks as a broadcast. Every document is scored whole, in one pass without a shuffle.

Defined cases: a null text is an empty one and is scored too; a null stated length counts as the text's own; a label that is null,
or for an id without a document, teaches nothing; several labels of one id count as their rounded mean; without labels of both
kinds every score is the share of good ones (1 if there is none), so nothing is rejected for lack of knowledge.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftlake.llm.common import ending, sliced_texts
from sftlake.llm.decontaminate import TABLE

BUCKETS = 1 << 15
FACTORS = 8
SAMPLE = 12_000
WORD_CACHE = 200_000

_LETTERS, _DIGITS, _BLANKS = (np.zeros(256, bool) for _ in range(3))
_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGITS[48:58] = True
_BLANKS[[32, *range(9, 14)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_SENTENCE = np.zeros(256, bool)
_SENTENCE[[ord(c) for c in ".,;:'\"()-"]] = True
_REPEATED_MARK = re.compile(rb"([!-/:-@\[-`{-~])\1")
_LINK = re.compile(rb"https?://|www\.|<[a-z/!]")
STATS = 22


class _Words(dict):
    """Slot of a word; a full table is emptied."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = slot = xxhash.xxh3_64_intdigest(word) & (BUCKETS - 1)
        return slot


_WORDS = _Words()


def forget_words() -> None:
    _WORDS.clear()


def structure(text: bytes, words: list[bytes], n_chars: float | None) -> list[float]:
    """Statistics of a text: shares of kinds of characters, repetition, lengths."""
    raw = np.frombuffer(text, np.uint8)
    n = max(1, len(raw))
    counts = np.bincount(raw, minlength=256)
    letters, digits, blanks = counts[_LETTERS].sum(), counts[_DIGITS].sum(), counts[_BLANKS].sum()
    upper, plain = counts[_UPPER].sum(), counts[_SENTENCE].sum()
    marks = n - letters - digits - blanks if len(raw) else 0
    lines = text.split(b"\n")
    spaced = text.split()
    k = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    distinct, lower = len(set(words)), text.count(b"\n") + 1
    top = counts[[i for i in range(33, 127) if not (chr(i).isalnum() or _SENTENCE[i])]]
    return [
        letters / n, digits / n, blanks / n, marks / n, (marks - plain) / n, top.max() / n, upper / max(1, letters),
        len(_REPEATED_MARK.findall(text)) / max(1, len(spaced)), len(_LINK.findall(text)) / max(1, len(spaced)),
        distinct / k, math.log1p(k - distinct), len(set(lines)) / lower, math.log1p(lower), math.log1p(k),
        k / lower / 50, float(lengths.mean()) / 10 if len(words) else 0.0, math.log1p(float(lengths.max())) if len(words) else 0.0,
        counts[33] / max(1, len(spaced)), counts[46] / max(1, len(spaced)), counts[124] / max(1, len(spaced)),
        math.log1p(max(0.0, float(n if n_chars is None else n_chars))) / 10, 1.0 if not words else 0.0,
    ]


class Features:
    """A batch's sparse word features (row, slot, value) and dense statistics."""

    def __init__(self, texts: list[str | None], n_chars: list[int | None]):
        data = [(t or "").encode() for t in texts]
        words = [t.translate(TABLE).split() for t in data]
        self.dense = np.array([structure(t, w, c) for t, w, c in zip(data, words, n_chars)]).reshape(-1, STATS)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        slots = np.fromiter((s for w in words for s in map(_WORDS.__getitem__, w)), np.int64, int(sizes.sum()))
        rows = np.repeat(np.arange(len(words)), sizes)
        keys, counts = np.unique(rows * BUCKETS + slots, return_counts=True)
        self.rows, self.slots, value = keys // BUCKETS, keys % BUCKETS, np.sqrt(counts)
        norm = np.sqrt(np.bincount(self.rows, value * value, len(words)))
        self.values = value / np.maximum(norm, 1e-12)[self.rows]


class Machine:
    """Parameters and the linear-time score. Words and statistics share the factor space."""

    def __init__(self, centre: np.ndarray, scale: np.ndarray, prior: float, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.centre, self.scale, self.prior = centre, scale, prior
        self.w = np.zeros(BUCKETS)
        self.v = rng.normal(0, 0.01, (BUCKETS, FACTORS))
        self.sw = np.zeros(STATS)
        self.sv = rng.normal(0, 0.01, (STATS, FACTORS))
        self.w0 = math.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
        self.constant = False

    def standard(self, dense: np.ndarray) -> np.ndarray:
        return np.clip((dense - self.centre) / self.scale, -8, 8)

    def parts(self, n: int, rows, slots, values, dense) -> tuple[np.ndarray, np.ndarray]:
        """Margins and factor sums (sum_i v_if x_i) per row."""
        linear = self.w0 + np.bincount(rows, self.w[slots] * values, n) + dense @ self.sw
        v = self.v[slots]
        sums = np.stack([np.bincount(rows, v[:, f] * values, n) for f in range(FACTORS)], axis=1) + dense @ self.sv
        squares = np.bincount(rows, (v * v).sum(axis=1) * values * values, n) + (dense * dense) @ (self.sv * self.sv).sum(axis=1)
        return linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums

    def score(self, f: Features) -> np.ndarray:
        n = len(f.dense)
        if self.constant:
            return np.full(n, self.prior)
        margin, _ = self.parts(n, f.rows, f.slots, f.values, self.standard(f.dense))
        return 1 / (1 + np.exp(-np.clip(margin, -40, 40)))


def fit(rows, slots, values, dense, labels: np.ndarray, epochs: int = 12, batch: int = 256, rate: float = 0.08, decay: float = 2e-4) -> Machine:
    """AdaGrad on the logistic loss; both kinds of label weigh the same in total."""
    prior = float(labels.mean()) if len(labels) else 1.0
    scale = dense.std(axis=0) + 1e-3 if len(dense) else np.ones(STATS)
    m = Machine(dense.mean(axis=0) if len(dense) else np.zeros(STATS), scale, prior)
    if not 0 < prior < 1:
        m.constant = True
        return m
    weight = np.where(labels > 0, 0.5 / prior, 0.5 / (1 - prior))
    m.w0 = 0.0
    x = m.standard(dense)
    begin = np.searchsorted(rows, np.arange(len(labels) + 1))
    grads = {"w": np.full(BUCKETS, 1e-6), "v": np.full((BUCKETS, FACTORS), 1e-6), "sw": np.full(STATS, 1e-6), "sv": np.full((STATS, FACTORS), 1e-6)}
    g0, rng = 1e-6, np.random.default_rng(5)

    def step(name: str, g: np.ndarray, at=slice(None)) -> None:
        p = getattr(m, name)
        g = g + decay * p[at]
        grads[name][at] += g * g
        p[at] -= rate * g / np.sqrt(grads[name][at])

    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for lo in range(0, len(order), batch):
            pick = np.sort(order[lo : lo + batch])
            n = len(pick)
            sizes = begin[pick + 1] - begin[pick]
            at = np.repeat(begin[pick] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            r, s, a, d = np.repeat(np.arange(n), sizes), slots[at], values[at], x[pick]
            margin, sums = m.parts(n, r, s, a, d)
            error = weight[pick] * (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - labels[pick]) / n
            used, inverse = np.unique(s, return_inverse=True)
            ea = error[r] * a
            gv = np.stack([np.bincount(inverse, ea * (sums[r, f] - m.v[s, f] * a), len(used)) for f in range(FACTORS)], axis=1)
            step("w", np.bincount(inverse, ea, len(used)), used)
            gsv = d.T @ (error[:, None] * sums) - m.sv * ((d * d).T @ error)[:, None]
            step("v", gv, used)
            step("sw", d.T @ error)
            step("sv", gsv)
            g = float(error.sum())
            g0 += g * g
            m.w0 -= rate * g / math.sqrt(g0)
    return m


def _columns(docs: DataFrame, text: str, n_chars: str) -> list[Column]:
    stated = F.col(n_chars).cast("bigint") if n_chars in docs.columns else F.lit(None).cast("bigint")
    return [F.col(text).cast("string").alias("_text"), stated.alias("_chars")]


def train(
    docs: DataFrame, labels: DataFrame, usable: Column | None = None, sample: int = SAMPLE, doc_id: str = "doc_id",
    text: str = "text", label: str = "quality", n_chars: str = "n_chars", seed: int = 3,
) -> Machine:
    """Fit on at most ``sample`` labelled documents, the first by a seeded hash of their id. Only labels that meet
    ``usable`` (a condition on ``doc_id``) are looked at."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    if usable is not None:
        known = known.where(usable)
    chosen = (
        known.groupBy(F.col(doc_id).alias("_id")).agg((F.avg(label) >= 0.5).cast("int").alias("_label"))
        .orderBy(F.xxhash64(F.lit(seed), "_id"), "_id").limit(sample)
    )
    rows = docs.select(F.col(doc_id).alias("_id"), *_columns(docs, text, n_chars)).join(F.broadcast(chosen), "_id")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced_texts(ending(batches, forget_words), "_text", 256):
            f = Features(b.column("_text").to_pylist(), b.column("_chars").to_pylist())
            cut = np.searchsorted(f.rows, np.arange(b.num_rows + 1))
            lists = lambda x: pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(x))
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), b.column("_label"), pa.array(f.dense.tolist(), pa.list_(pa.float64())),
                 lists(f.slots.astype(np.int32)), lists(f.values.astype(np.float32))],
                names=["id", "label", "dense", "slots", "values"],
            )

    # A repeated id contributes one of its rows; equal features whichever that is, if the rows are equal.
    table = rows.select("_id", "_label", "_text", "_chars").mapInArrow(
        features, "id bigint, label int, dense array<double>, slots array<int>, values array<float>"
    ).toArrow().sort_by("id")
    sizes = np.array([len(s) for s in table.column("slots")], np.int64)
    flat = lambda name, kind: (
        np.concatenate([np.asarray(x.values, kind) for x in table.column(name)]) if table.num_rows else np.empty(0, kind)
    )
    dense = np.array(table.column("dense").to_pylist(), float).reshape(-1, STATS)
    labels_ = np.array(table.column("label").to_pylist(), float)
    return fit(np.repeat(np.arange(len(sizes)), sizes), flat("slots", np.int64), flat("values", np.float64), dense, labels_)


def score(docs: DataFrame, machine: Machine, text: str = "text", n_chars: str = "n_chars", name: str = "score") -> DataFrame:
    """Add the score of every document. A column of that name is replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)
    kept = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c != name))
    where, stated = kept.columns.index(text), kept.columns.index(n_chars) if n_chars in kept.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced_texts(ending(batches, forget_words), where, 256):
            chars = b.column(stated).to_pylist() if stated is not None else [None] * b.num_rows
            s = sent.value.score(Features(b.column(where).to_pylist(), chars)) if b.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], names=[*b.schema.names, name])

    return kept.mapInArrow(run, kept.withColumn(name, F.lit(0.5)).schema)
