"""Profiling of a corpus: distinct values, row counts and length distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


PERCENTILES = (25, 50, 75, 90, 95, 99)


def dataset_preview(df: DataFrame, order: str = "ord", width: int = 100) -> DataFrame:
    """Row count, the first record's fields and the start of its prompt and response.

    A field that the record lacks reads as null, so fields without a value are not listed.
    """
    held = F.concat_ws(",", *(F.when(F.col(c).isNotNull(), F.lit(c)) for c in df.columns if c != order))
    return df.select(
        order, held.alias("keys"), F.left("prompt", F.lit(width)).alias("prompt"), F.left("response", F.lit(width)).alias("response")
    ).agg(
        F.count(F.lit(1)).alias("examples"),
        F.min_by("keys", order).alias("keys"),
        F.min_by("prompt", order).alias("prompt"),
        F.min_by("response", order).alias("response"),
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Unique values of a column, null included, in no order."""
    return df.select(column).distinct()


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def head(df: DataFrame, order: str = "ord", n: int = 5) -> DataFrame:
    return df.orderBy(order).limit(n)


def length_stats(df: DataFrame, length: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean, median, extremes, sample deviation and exact percentiles of an integer length.

    Rows are reduced to a histogram first. Lengths repeat, so the histogram is small at
    any row count, it is built with map-side combine, and a group that holds most rows
    costs no more than any other.
    """
    by = list(by)
    bars = df.select(*by, F.col(length).cast("bigint").alias("x")).where("x is not null")
    bars = bars.groupBy(*by, "x").agg(F.count(F.lit(1)).alias("n"))
    x, n = F.col("x").cast("decimal(19,0)"), F.col("n").cast("decimal(19,0)")
    sums = bars.groupBy(*by).agg(
        F.sum("n").alias("rows"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
        F.sum(x * n).cast("double").alias("s1"),
        F.sum((F.col("x").cast("decimal(12,0)") * F.col("x").cast("decimal(12,0)")) * F.col("n").cast("decimal(13,0)"))
        .cast("double").alias("s2"),
        F.percentile("x", F.array(*(F.lit(p / 100) for p in PERCENTILES)), F.col("n")).alias("p"),
    )
    rows = F.col("rows").cast("double")
    mean = F.col("s1") / rows
    spread = F.greatest(F.col("s2") - F.col("s1") * mean, F.lit(0.0))
    return sums.select(
        *by, "rows",
        mean.alias("mean"),
        F.col("p")[1].alias("median"),
        "min", "max",
        F.when(F.col("rows") > 1, F.sqrt(spread / (rows - F.lit(1.0)))).alias("std"),
        *(F.col("p")[i].alias(f"p{p}") for i, p in enumerate(PERCENTILES)),
    )
