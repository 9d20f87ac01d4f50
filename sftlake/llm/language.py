"""Language identification by nearest centroid over normalised TF-IDF n-gram vectors.

A text is lower-cased, everything that is no letter becomes one space, and its byte trigrams are hashed into ``BUCKETS``
slots. The vector is the square root of each count times the slot's IDF, scaled to length one. Each language has
``CENTROIDS`` centroids, found by spherical k-means over its training texts, so a language of several styles is not
one average of them. The language of the nearest centroid by cosine is the answer and that cosine its score.
A text farther from its centroid than nearly all training texts of that centroid (``reject_share``) is marked as rejected.

The model is fitted on the driver on at most ``per_language`` texts of each language, chosen by a hash of their id; counts are held sparse
there, and one language is clustered at a time. It is of fixed size per language. Every text is classified whole, in one pass without a shuffle.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; a null language teaches nothing; without any
training text every answer is ``und``; equal cosines go to the language first in code-point order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sftlake.llm.common import sliced_texts

BUCKETS = 1 << 13
CENTROIDS = 4
PER_LANGUAGE = 1500
UNKNOWN = "und"
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def trigram_counts(texts: list[str | None]) -> np.ndarray:
    """Dense counts (text, slot). A text's trigrams do not reach into its neighbour."""
    data = [b" " + b" ".join((t or "").lower().encode().translate(_LETTERS).split()) + b" " for t in texts]
    sizes = np.fromiter(map(len, data), np.int64, len(data))
    raw = np.frombuffer(b"".join(data), np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros((len(texts), BUCKETS), np.float32)
    gram = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
    slot = (gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - 13)
    doc = np.repeat(np.arange(len(data)), sizes)
    inside = doc[:-2] == doc[2:]
    keys = doc[:-2][inside] * BUCKETS + slot[inside]
    return np.bincount(keys, minlength=len(data) * BUCKETS).reshape(len(data), BUCKETS).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)


def _cluster(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means; an empty cluster keeps its centre."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        nearest = (x @ centres.T).argmax(axis=1)
        for c in range(len(centres)):
            if (nearest == c).any():
                centres[c] = x[nearest == c].mean(axis=0)
        centres = _unit(centres)
    return centres


class Centroids:
    def __init__(self, names: list[str], idf: np.ndarray, centres: np.ndarray, owner: np.ndarray, limits: np.ndarray):
        self.names, self.idf, self.centres, self.owner, self.limits = names, idf, centres, owner, limits

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return _unit(np.sqrt(counts) * self.idf)

    def classify(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        if not self.names or not texts:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        cosine = self.vectors(trigram_counts(texts)) @ self.centres.T
        best = cosine.argmax(axis=1)
        score = np.clip(cosine[np.arange(len(texts)), best].astype(float), 0, 1)
        known = np.array([has_letter(t) for t in texts], bool)
        names = [self.names[self.owner[b]] if k else UNKNOWN for b, k in zip(best, known)]
        return names, np.where(known, score, 0.0), ~known | (score < self.limits[best])


class Counts:
    """Trigram counts of texts, of which only the slots that occur are held."""

    def __init__(self, slots: list[np.ndarray], counts: list[np.ndarray]):
        self.slots, self.counts = slots, counts

    def __len__(self) -> int:
        return len(self.slots)

    def seen(self) -> np.ndarray:
        """Texts that have each slot."""
        return np.bincount(np.concatenate([np.empty(0, np.int64), *self.slots]), minlength=BUCKETS)

    def dense(self) -> np.ndarray:
        out = np.zeros((len(self), BUCKETS), np.float32)
        for row, slots, counts in zip(out, self.slots, self.counts):
            row[slots] = counts
        return out

    @classmethod
    def of(cls, dense: np.ndarray) -> Counts:
        slots = [np.flatnonzero(row) for row in dense]
        return cls(slots, [row[s] for row, s in zip(dense, slots)])


def fit(counts_by_language: dict[str, np.ndarray | Counts], k: int = CENTROIDS, reject_share: float = 0.002, seed: int = 9) -> Centroids:
    names = sorted(counts_by_language)
    if not names:
        return Centroids([], np.zeros(BUCKETS, np.float32), np.zeros((0, BUCKETS), np.float32), np.zeros(0, int), np.zeros(0))
    sparse = {name: c if isinstance(c, Counts) else Counts.of(c) for name, c in counts_by_language.items()}
    total, seen = sum(map(len, sparse.values())), sum(c.seen() for c in sparse.values())
    model = Centroids(names, (np.log((1 + total) / (1 + seen)) + 1).astype(np.float32), None, None, None)
    centres, owner, limits = [], [], []
    for i, name in enumerate(names):
        x = model.vectors(sparse[name].dense())  # one language at a time
        own = _cluster(x, k, seed + i)
        cosine = x @ own.T
        nearest = cosine.argmax(axis=1)
        for c in range(len(own)):
            mine = cosine[nearest == c, c]
            centres.append(own[c])
            owner.append(i)
            limits.append(float(np.quantile(mine, reject_share)) if len(mine) else 0.0)
    model.centres, model.owner, model.limits = np.stack(centres).astype(np.float32), np.array(owner), np.array(limits)
    return model


def _picked(rows: DataFrame, most: int, seed: int) -> DataFrame:
    """(_id, _lang) of at most ``most`` ids of each language, the first by hash.

    Only ids whose hash lies in the share of all hashes that holds ``most`` of a language, and six deviations more, are put in order: so few that a language
    with all the rows is no hot key. Where many rows repeat an id that share can hold fewer.
    """
    share = F.lit(most + 6 * most**0.5 + 20) / F.col("_rows")
    shares = rows.groupBy("_lang").agg(F.count(F.lit(1)).alias("_rows")).select(F.col("_lang").alias("_of"), share.alias("_share"))
    place = F.xxhash64(F.lit(seed), "_id")
    near = rows.join(shares, F.col("_lang") == F.col("_of")).where(place.cast("double") / F.lit(2.0**64) + F.lit(0.5) <= F.col("_share"))
    order = F.row_number().over(W.partitionBy("_lang").orderBy(place, "_id"))
    return near.select("_id", "_lang").distinct().withColumn("_k", order).where(F.col("_k") <= most).drop("_k")


def train(
    docs: DataFrame, usable: Column | None = None, per_language: int = PER_LANGUAGE, doc_id: str = "doc_id", text: str = "text",
    lang: str = "lang", seed: int = 1, **options,
) -> Centroids:
    """Fit on at most ``per_language`` texts of each language, the first by a seeded hash of their id. Only rows that meet
    ``usable`` are looked at."""
    rows = docs.select(F.col(doc_id).alias("_id"), F.col(text).cast("string").alias("_text"), F.col(lang).cast("string").alias("_lang"), *([] if usable is None else [usable.alias("_use")]))
    rows = rows.where("_lang is not null and _text is not null" + ("" if usable is None else " and _use"))
    picked = F.broadcast(_picked(rows.select("_id", "_lang"), per_language, seed))  # a bounded number per language

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced_texts(batches, "_text", 256):
            counts = trigram_counts(b.column("_text").to_pylist())
            row, slot = np.nonzero(counts)
            cut = np.searchsorted(row, np.arange(b.num_rows + 1)).astype(np.int32)
            lists = lambda x: pa.ListArray.from_arrays(pa.array(cut), pa.array(x))
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), b.column("_lang"), lists(slot.astype(np.int32)), lists(counts[row, slot].astype(np.int32))],
                names=["id", "lang", "slots", "counts"],
            )

    same = rows["_id"].eqNullSafe(picked["_id"]) & (rows["_lang"] == picked["_lang"])
    table = rows.join(picked, same, "left_semi").select("_id", "_lang", "_text").mapInArrow(
        features, "id bigint, lang string, slots array<int>, counts array<int>"
    ).toArrow().sort_by([("lang", "ascending"), ("id", "ascending")])
    groups: dict[str, Counts] = {}
    langs = np.array(table.column("lang").to_pylist(), object)
    for name in sorted(set(langs)):
        part = table.filter(pa.array(langs == name)).slice(0, per_language)
        held = lambda column: [np.asarray(x.values) for x in part.column(column)]  # noqa: B023, E731
        groups[name] = Counts(held("slots"), held("counts"))
    return fit(groups, **options)


def identify(docs: DataFrame, model: Centroids, text: str = "text", reject: bool = True) -> DataFrame:
    """Add ``lang_pred``, ``lang_score`` and ``rejected``. With ``reject`` a rejected text's language is ``und``. Columns of
    these names are replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    added = {"lang_pred": "string", "lang_score": "double", "rejected": "boolean"}
    kept = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in added))
    where = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced_texts(batches, where, 128):
            names, score, rejected = sent.value.classify(b.column(where).to_pylist())
            if reject:
                names = [UNKNOWN if r else n for n, r in zip(names, rejected)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                names=[*b.schema.names, *added],
            )

    return kept.mapInArrow(run, kept.select("*", *(F.lit(None).cast(t).alias(n) for n, t in added.items())).schema)
