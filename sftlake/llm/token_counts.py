"""Token counts by field and section from one encoding of the whole document.

A document is its fields joined by newlines, encoded once, as a model would see it. A section is a line of a field
with the newline that ends it. Tokens and sections both cut the document's bytes into intervals; an
interval join (all boundaries merged, one search for each side) gives every overlap and its bytes. A token
that crosses a boundary is allocated by an explicit rule:

- ``start``: to the section where its first byte lies (the default);
- ``end``: to the section where its last byte lies;
- ``majority``: to the section with most of its bytes, the earlier one of equals;
- ``split``: to each section in proportion to its bytes.

Under every rule the counts of a document add up to its tokens.

Defined cases: a null field is empty and still has one section, so every document has at least one row per field; an
empty section counts no token; repeated rows are counted each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftlake.llm.bpe import encoder
from sftlake.llm.common import sliced_texts

RULES = ("start", "end", "majority", "split")
RESULT = "doc_id bigint, field string, section bigint, n_chars bigint, n_tokens double, n_crossing bigint"


def overlaps(tokens: np.ndarray, sections: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token, section and bytes of each overlap, in order. Arguments are the lengths of two partitions of the same bytes;
    lengths may be 0."""
    token_stops, section_stops = np.cumsum(tokens), np.cumsum(sections)
    stops = np.union1d(token_stops, section_stops)
    stops = stops[stops > 0]
    return (
        np.searchsorted(token_stops, stops, "left"), np.searchsorted(section_stops, stops, "left"),
        np.diff(np.concatenate(([0], stops))),
    )


def allocate(tokens: np.ndarray, sections: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section under a rule, and how many tokens with bytes in it have bytes elsewhere too."""
    token, section, size = overlaps(tokens, sections)
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    first = np.concatenate(([True], token[1:] != token[:-1])) if len(token) else np.empty(0, bool)
    last = np.concatenate((first[1:], [True])) if len(token) else first
    crossing = np.bincount(section[~(first & last)], minlength=len(sections))
    if rule == "split":
        return np.bincount(section, weights=size / tokens[token], minlength=len(sections)), crossing
    if rule == "majority":
        order = np.lexsort((section, -size, token))
        chosen = order[np.concatenate(([True], np.diff(token[order]) != 0))] if len(token) else order
    else:
        chosen = np.flatnonzero(first if rule == "start" else last)
    return np.bincount(section[chosen], minlength=len(sections)).astype(float), crossing


def _sized(batches: Iterator[pa.RecordBatch], fields: int) -> Iterator[pa.RecordBatch]:
    """Batches in which no field has more than a task's bytes of work."""
    for i in range(fields):
        batches = sliced_texts(batches, 1 + i, 256)
    return batches


def token_counts(
    docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", fields: Sequence[str] = ("text",), rule: str = "start",
    special_tokens: bool = False,
) -> DataFrame:
    """(doc_id, field, section, n_chars, n_tokens, n_crossing), sections numbered from 0 in each field. With ``special_tokens``
    their strings in a text count as one token each."""
    names = list(fields)
    rows = docs.select(
        F.col(doc_id).cast("bigint").alias("_doc"),
        *(F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f"_{i}") for i, f in enumerate(names)),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(tokenizer, special_tokens)
        for batch in _sized(batches, len(names)):
            parts = [batch.column(1 + i).to_pylist() for i in range(len(names))]
            texts = ["\n".join(p) for p in zip(*parts)]
            ids = np.frombuffer(b"".join(bpe.encode(texts)), "<u4")
            # A closing newline for each document, which is no token's byte, makes its last section end like the others.
            raw = np.frombuffer("".join(t + "\n" for t in texts).encode(), np.uint8)
            stops = np.flatnonzero(raw == 10) + 1
            lengths = np.diff(np.concatenate(([0], stops)))
            chars = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
            n_chars = chars[stops] - chars[stops - lengths]
            per_field = np.array([[p.count("\n") + 1 for p in part] for part in parts], np.int64).T.reshape(-1)
            closing = np.cumsum(per_field.reshape(len(texts), -1).sum(axis=1)) - 1
            lengths[closing] -= 1
            n_chars[closing] -= 1
            counts, crossing = allocate(bpe.lengths[ids], lengths, rule)
            group = np.repeat(np.arange(len(per_field)), per_field)
            begin = np.cumsum(per_field) - per_field
            doc = batch.column(0).take(pa.array(group // len(names)))
            field = pa.array(names, pa.string()).take(pa.array(group % len(names)))
            yield pa.RecordBatch.from_arrays(
                [doc, field, pa.array(np.arange(len(group)) - begin[group]), pa.array(n_chars), pa.array(counts), pa.array(crossing)],
                names=["doc_id", "field", "section", "n_chars", "n_tokens", "n_crossing"],
            )

    return rows.mapInArrow(run, RESULT)
