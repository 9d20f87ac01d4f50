"""Global order without a single-partition sort.

A window with only an ``orderBy``, or one partitioned by a key that may hold a third of
all rows, puts that much data into one task. The helpers here cut the order into
buckets, add the buckets up, and finish inside each bucket.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Buckets of an order by an integer column.
POSITION_BUCKETS = 1 << 10
#: Upper bound on the buckets of a global order: 16**4 prefixes of a digest.
MAX_BUCKETS = 1 << 16
DIGEST_DIGITS = 4

def _latest(column: str) -> Column:
    return F.last(column, ignorenulls=True)


_COMBINE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max, "last": _latest}
_REDUCE = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "last": _latest}


def int_div(a: Column, b: Column | int) -> Column:
    """Exact integer division, also beyond 2**53."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b)).cast("bigint")


def digest(value: Column, seed: int) -> Column:
    """Seeded, uniform order key (32 hex digits). A null value counts as the empty text."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(value.cast("string"), F.lit(""))))


def digest_bucket(key: Column) -> Column:
    return F.substring(key, 1, DIGEST_DIGITS)


def required(column: str) -> Column:
    """The column, or an error where it is null: a row without a place cannot be ordered."""
    return F.when(F.col(column).isNotNull(), F.col(column)).otherwise(
        F.raise_error(F.lit(f"{column} is null: it has no place in the order"))
    )


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, null being equal to null; the keys are kept once."""
    named = right.select(*(F.col(k).alias(f"_right_{i}") for i, k in enumerate(keys)), *(c for c in right.columns if c not in keys))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_right_{i}"))
    return left.join(named, same, how).drop(*(f"_right_{i}" for i in range(len(keys))))


def _part(kind: str, column: str, order: str) -> Column:
    """One block's share of a running value; within a block only ``last`` depends on order."""
    if kind == "last":
        return F.max_by(column, F.when(F.col(column).isNotNull(), F.col(order)))
    return _REDUCE[kind](column)


def running(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    values: Mapping[str, tuple[str, Column]],
    exclusive: Sequence[str] = (),
    block: int = MAX_BUCKETS,
) -> DataFrame:
    """Running ``sum``/``count``/``min``/``max``/``last`` per ``by`` in the order of an integer column.

    ``values`` maps each new column to ``(kind, column)``; those named in ``exclusive`` leave
    the current row out. The order is cut into blocks
    of ``block`` consecutive values: blocks are reduced first (with map-side combine),
    their prefix is taken over one row per block, and only the last step sorts rows,
    within one block of one key. So a key of any size is spread over many tasks.
    ``order`` must be unique within ``by``; a null one is an error. A null in ``by`` is a key like any other.
    """
    by = list(by)
    rows = df.withColumn("_block", int_div(required(order), block))
    for name, (_, column) in values.items():
        rows = rows.withColumn(f"_in_{name}", column)
    per_block = rows.groupBy(*by, "_block").agg(
        *(_part(kind, f"_in_{name}", order).alias(f"_part_{name}") for name, (kind, _) in values.items())
    )
    earlier = W.partitionBy(*by).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    before = per_block.select(
        *by, "_block",
        *(_COMBINE[kind](f"_part_{name}").over(earlier).alias(f"_before_{name}")
          for name, (kind, _) in values.items()),
    )
    inside = W.partitionBy(*by, "_block").orderBy(order)
    out = null_safe(rows, before, [*by, "_block"])
    for name, (kind, _) in values.items():
        frame = inside.rowsBetween(W.unboundedPreceding, -1 if name in exclusive else W.currentRow)
        local, prior = _REDUCE[kind](f"_in_{name}").over(frame), F.col(f"_before_{name}")
        if kind in ("sum", "count"):
            total = F.coalesce(prior, F.lit(0)) + F.coalesce(local, F.lit(0))
        elif kind == "last":
            total = F.coalesce(local, prior)
        else:
            total = (F.least if kind == "min" else F.greatest)(prior, local)
        out = out.withColumn(name, total)
    return out.select(*df.columns, *values)


def number_by_digest(df: DataFrame, key: Column, tie: str) -> DataFrame:
    """Number all rows from 0 in the order of a digest: adds ``_rn`` and ``_total``, and
    the range of numbers ``_from`` to ``_to`` (exclusive) that the task's bucket covers.

    Rows are counted per digest prefix (at most 65,536 counts, so their running sum is
    one small task and their broadcast is bounded), then numbered inside each prefix.
    """
    rows = df.withColumn("_key", key).withColumn("_bucket", digest_bucket(F.col("_key")))
    return _number(rows, ["_bucket"], ["_key", tie]).drop("_key")


def number_by_position(df: DataFrame, order: str) -> DataFrame:
    """Number all rows from 0 in the order of an integer column: adds ``_rn`` and ``_total``.

    Buckets lie between quantiles of the column, so gaps and clusters in it do not pile up in
    one bucket. There are at most ``POSITION_BUCKETS`` of them, each with about as many rows. Equal values share a
    bucket, so the column should be nearly unique; a null is an error.
    """
    rows = df.withColumn("_at", required(order))
    shares = [i / POSITION_BUCKETS for i in range(1, POSITION_BUCKETS)]
    bounds = rows.agg(
        F.array_sort(F.array_distinct(F.coalesce(
            F.percentile_approx("_at", shares, 20 * POSITION_BUCKETS), F.array().cast("array<bigint>")
        )))
    ).first()[0]
    # How many bounds lie below a position: looked up among every 32nd of them, then among the 32 that follow.
    every = F.lit(bounds[31::32]).cast("array<bigint>")
    coarse = F.size(F.filter(every, lambda b: b < F.col("_at")))
    fine = F.slice(F.lit(bounds).cast("array<bigint>"), F.col("_coarse") * 32 + 1, 32)
    placed = rows.withColumn("_coarse", coarse).withColumn(
        "_bucket", F.col("_coarse") * 32 + F.size(F.filter(fine, lambda b: b < F.col("_at")))
    )
    return _number(placed, ["_bucket"], ["_at"]).drop("_at", "_coarse", "_bucket")


def _number(rows: DataFrame, bucket: list[str], order: list[str]) -> DataFrame:
    everything = W.orderBy(*bucket)
    offsets = rows.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_n")).select(
        *bucket,
        F.sum("_n").over(everything.rowsBetween(W.unboundedPreceding, W.currentRow)).alias("_to"),
        (
            F.sum("_n").over(everything.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_n")
        ).alias("_from"),
        F.sum("_n").over(
            everything.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        ).alias("_total"),
    )
    inside = F.row_number().over(W.partitionBy(*bucket).orderBy(*order))
    return rows.join(F.broadcast(offsets), bucket).withColumn("_rn", F.col("_from") + inside - F.lit(1))


def quota_cutoff(df: DataFrame, order: str, wanted: Column, n: int, parts: int = 1024) -> int | None:
    """Position of the ``n``-th row that meets ``wanted`` in the order of an integer column.

    Returns None when fewer rows meet it. The column is searched from its start in
    windows that grow eightfold, so the expensive predicate is evaluated on about the
    part of the data that fills the quota, not on all of it. Each probe brings back at
    most ``parts`` counts; the window that holds the answer is cut finer until it is one
    position wide. Rows without a position come after all others. Equal positions at the cut-off are an error,
    as "the first n rows" then says nothing.

    The probes run when this is called. Where the input is not stored in the order of the column, no
    row group can be skipped and each probe reads all of it; for a small ``n``, ``df.where(wanted).orderBy(order).limit(n)``
    is then the cheaper plan.
    """
    if n <= 0:
        raise ValueError("the quota must be positive")
    start, last = df.agg(F.min(order), F.max(order)).first()
    if start is None:
        return None
    reach = 4 * n
    while start <= last:
        end = min(start + reach - 1, last)
        width = -(-(end - start + 1) // parts)
        part = int_div(F.col(order) - F.lit(start), width)
        counts = (
            df.where(F.col(order).between(start, end)).where(wanted)
            .groupBy(part.alias("part")).count().orderBy("part").collect()
        )
        for row in counts:
            if row["count"] >= n:
                break
            n -= row["count"]
        else:
            start, reach = end + 1, reach * 8
            continue
        start = start + row["part"] * width
        if width == 1:
            if row["count"] > n:
                raise ValueError(f"{order} is not unique at the cut-off {start}: give an order without ties")
            return start
        last = min(start + width - 1, end)
        reach = width
    return None
