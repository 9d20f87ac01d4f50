"""Mergeable quantile sketches of an integer length.

A sketch is rows ``(slice..., x, weight)``: of the sorted lengths of a slice every value stays at which the running count passes a multiple of rows / points,
and stands for the rows since the value before it. So a slice keeps ``points`` rows at most, and the count of rows up to any value is
short by less than rows / points. Sketches of several slices merge by adding up, and so do their errors: a quantile of all is off in rank by less than
1 / points of all rows, however many slices there are. Unlike a sampling sketch it is the same on every run.

New slices are appended; nothing that is stored is read again for them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sftlake.operators.ordering import null_safe

POINTS = 1000


def _thinned(bars: DataFrame, by: Sequence[str], points: int) -> DataFrame:
    """At most ``points`` of the (x, weight) rows of each slice, standing for the others."""
    ascending = W.partitionBy(*by).orderBy("x")
    upto = F.sum("weight").over(ascending.rowsBetween(W.unboundedPreceding, W.currentRow))
    counted = bars.withColumns({"_upto": upto, "_total": F.sum("weight").over(W.partitionBy(*by))})
    mark = lambda n: F.call_function("div", n * F.lit(points), F.col("_total"))
    kept = counted.where(mark(F.col("_upto")) > mark(F.col("_upto") - F.col("weight")))
    since = F.col("_upto") - F.coalesce(F.lag("_upto").over(ascending), F.lit(0))
    return kept.select(*by, "x", since.cast("bigint").alias("weight"))


def sketch_lengths(df: DataFrame, length: Column | str, by: Sequence[str], points: int = POINTS) -> DataFrame:
    """Sketch of each slice of ``df``. Null lengths are left out; a histogram with map-side combine comes first, so rows do not move."""
    if points < 1:
        raise ValueError("a sketch has one point at least")
    value = F.col(length) if isinstance(length, str) else length
    bars = df.select(*by, value.cast("bigint").alias("x")).where("x is not null").groupBy(*by, "x").agg(F.count(F.lit(1)).alias("weight"))
    return _thinned(bars, by, points)


def merge_sketches(sketches: DataFrame, by: Sequence[str] = (), points: int | None = None) -> DataFrame:
    """Sketches of coarser slices. With ``points`` the result is thinned again, which adds another 1 / points to the error."""
    merged = sketches.groupBy(*by, "x").agg(F.sum("weight").alias("weight"))
    return merged if points is None else _thinned(merged, by, points)


def sketch_quantiles(sketches: DataFrame, quantiles: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by..., rows, q50, ...): of each quantile p the smallest kept value up to which at least p of the rows lie."""
    merged = merge_sketches(sketches, by)
    upto = F.sum("weight").over(W.partitionBy(*by).orderBy("x").rowsBetween(W.unboundedPreceding, W.currentRow))
    counted = merged.withColumns({"_upto": upto, "_total": F.sum("weight").over(W.partitionBy(*by))})
    reached = lambda p: F.col("_upto").cast("double") >= F.lit(float(p)) * F.col("_total")
    return counted.groupBy(*by).agg(
        F.sum("weight").alias("rows"), *(F.min(F.when(reached(p), F.col("x"))).alias(f"q{round(100 * p)}") for p in quantiles)
    )


def approximate_stats(
    df: DataFrame, length: Column | str, by: Sequence[str] = (), points: int = POINTS, quantiles: Sequence[float] = (0.25, 0.5, 0.75, 0.9, 0.95, 0.99),
) -> DataFrame:
    """(by..., rows, min, max, q25, ...): the opt-in form of `length_stats` for lengths of so many values that their exact histogram is large.
    Percentiles are off in rank by less than rows / points; rows, least and greatest are exact."""
    value = F.col(length) if isinstance(length, str) else length
    if not by:
        whole = df.select(F.lit(0).alias("slice"), value.alias("x"))
        return approximate_stats(whole, "x", ["slice"], points, quantiles).drop("slice")
    ends = df.select(*by, value.cast("bigint").alias("x")).where("x is not null").groupBy(*by).agg(F.min("x").alias("min"), F.max("x").alias("max"))
    found = sketch_quantiles(sketch_lengths(df, value, by, points), quantiles, by)
    names = [c for c in found.columns if c not in by]
    return null_safe(found, ends, list(by)).select(*by, "rows", "min", "max", *(n for n in names if n != "rows"))


def append_sketches(sketches: DataFrame, path: str, slice_column: str) -> None:
    """Add sketches of new slices to a table that is laid out by one of their columns."""
    sketches.write.mode("append").partitionBy(slice_column).parquet(path)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
