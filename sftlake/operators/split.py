"""Train/validation split that keeps every prompt on one side."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sftlake.operators.ordering import DIGEST_DIGITS, digest, digest_bucket
from sftlake.session import stored


def _prompt(key: str) -> Column:
    return F.coalesce(F.col(key), F.lit(""))


#: Prompts that one task puts in order.
MOST_IN_ORDER = 1 << 16


def _edge(counts: DataFrame, missing: int) -> tuple[str, int, int] | None:
    """Of counts ``(bucket, n)`` in bucket order, the bucket in which the sum reaches ``missing``, what it still lacks there, and its count."""
    order = W.orderBy("bucket")
    upto = F.sum("n").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    found = counts.withColumn("upto", upto).where((F.col("upto") - F.col("n") < missing) & (F.col("upto") >= missing)).first()
    return None if found is None else (found["bucket"], missing - (found["upto"] - found["n"]), found["n"])


def split_cutoff(df: DataFrame, key: str, val_frac: float, seed: int, most: int | None = None) -> str | None:
    """The largest prompt digest that still goes to validation, or None if none does.

    Validation takes prompts in digest order while its rows are fewer than ``floor(val_frac * rows)``. This is a radix selection:
    rows are counted per digest prefix (four digits, at most 65,536 counts), and the prefix in which the target is reached is
    looked at one level deeper, until it has at most ``most`` prompts, which are put in order. So no window is larger, however
    many prompts there are and however their digests lie. The first level reads the rows, later ones a table of that prefix's prompts.
    """
    most = MOST_IN_ORDER if most is None else most
    keys = df.select(digest(F.col(key), seed).alias("h"))
    counts = keys.groupBy(digest_bucket(F.col("h")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    rows = counts.agg(F.sum("n")).first()[0] or 0
    edge = _edge(counts, math.floor(float(val_frac) * rows))
    if edge is None:
        return None
    prefix, missing, _ = edge
    prompts = stored(keys.where(F.col("h").startswith(prefix)).groupBy("h").agg(F.count(F.lit(1)).alias("n")), "split-prompts")
    while len(prefix) < 32 and prompts.where(F.col("h").startswith(prefix)).count() > most:
        deeper = F.substring("h", len(prefix) + 1, DIGEST_DIGITS)
        inside = prompts.where(F.col("h").startswith(prefix)).groupBy(deeper.alias("bucket")).agg(F.sum("n").alias("n"))
        more, missing, _ = _edge(inside, missing)
        prefix += more
    upto = F.sum("n").over(W.orderBy("h").rowsBetween(W.unboundedPreceding, -1))
    last = prompts.where(F.col("h").startswith(prefix)).withColumn("before", F.coalesce(upto, F.lit(0)))
    return last.where(F.col("before") < missing).agg(F.max("h")).first()[0]


def group_split(
    df: DataFrame, key: str = "prompt", val_frac: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add ``split`` (``train``/``val``) so that all rows of a prompt get the same one.

    A missing prompt counts as the empty one. Membership is a comparison of the prompt's
    digest with one cut-off value: the rows themselves are neither shuffled nor joined,
    and a prompt that holds a third of the rows needs no special care.
    """
    cutoff = F.lit(split_cutoff(df, key, val_frac, seed)).cast("string")
    return df.withColumn(
        "split", F.when(digest(F.col(key), seed) <= cutoff, "val").otherwise("train")
    )


def split_leakage(df: DataFrame, key: str = "prompt", split: str = "split") -> DataFrame:
    """Prompts present on both sides, and the share of validation rows they touch."""
    sides = df.groupBy(F.md5(_prompt(key)).alias("h")).agg(
        F.count_if(F.col(split) == "train").alias("train"),
        F.count_if(F.col(split) == "val").alias("val"),
    )
    leaked = F.when(F.col("train") > 0, F.col("val")).otherwise(F.lit(0))
    return sides.agg(
        F.count_if((F.col("train") > 0) & (F.col("val") > 0)).alias("leaked_prompts"),
        F.sum(leaked).alias("leaked_val_rows"),
        F.sum("val").alias("val_rows"),
    ).withColumn(
        "leaked_share",
        F.coalesce(F.try_divide(F.col("leaked_val_rows").cast("double"), F.col("val_rows")), F.lit(0.0)),
    )


def split_report(df: DataFrame, key: str = "prompt", split: str = "split") -> DataFrame:
    """Unique prompts and rows per side, reduced to one row per prompt first."""
    return (
        df.groupBy(F.md5(_prompt(key)).alias("h"))
        .agg(
            F.count_if(F.col(split) == "train").alias("train"),
            F.count_if(F.col(split) == "val").alias("val"),
        )
        .agg(
            F.count(F.lit(1)).alias("unique_prompts"),
            F.sum("train").alias("train_rows"),
            F.sum("val").alias("val_rows"),
        )
    )
