"""The pluggable tokenizer: the one Python boundary of the package."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

Encoder = Callable[[Sequence[str]], Sequence[Sequence[int]]]

#: An encoder gets at most so many texts, and so many bytes of text or else a single text, at once.
SLICE_ROWS, SLICE_BYTES = 1024, 1 << 20


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        before = int(ends[at - 1]) if at else 0
        stop = min(max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right"))), at + SLICE_ROWS)
        yield texts.slice(at, stop - at)
        at = stop


def with_tokenizer(factory: Callable[[], Encoder]) -> Callable[[Column], Column]:
    """Turn a tokenizer factory into a column function ``text -> array<int>``.

    The factory runs once per task, in the worker, so a tokenizer that cannot be
    pickled or is slow to load is fine. Texts arrive in Arrow batches, which are encoded and sent back
    in slices of bounded size: beside its batch a worker holds the ids of one slice, or of one long text.
    Null text is encoded as the empty text.
    """

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = factory()
        for batch in batches:
            for texts in _slices(batch.fill_null("")):
                yield pa.array([list(ids) for ids in encoder(texts.to_pylist())], pa.list_(pa.int32()))

    return encode
