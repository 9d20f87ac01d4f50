"""Losses and accuracies over a long table ``(seq_id, pos, label, logits)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sftlake.functions import scoring as sc
from sftlake.operators.examples import MASKED


def with_target(df: DataFrame) -> DataFrame:
    """Add ``target``, the label of the next position; the last position is masked.

    The window holds one sequence. On a table bucketed by ``seq_id`` and sorted by
    ``(seq_id, pos)`` it needs neither a shuffle nor a sort; a table that already has a
    ``target`` column is taken as it is.
    """
    if "target" in df.columns:
        return df
    following = F.lead("label", 1, MASKED).over(W.partitionBy("seq_id").orderBy("pos"))
    return df.withColumn("target", following)


def _scored(df: DataFrame) -> DataFrame:
    """Log-probability of the target, null where it is masked."""
    counted = F.col("target") != F.lit(MASKED)
    return with_target(df).withColumn(
        "lp", F.when(counted, sc.log_prob(F.col("logits"), F.col("target")))
    )


def _masked_mean(df: DataFrame, value: Column, name: str, by: Sequence[str], num_items: float | None) -> DataFrame:
    items = F.greatest(F.count("lp"), F.lit(1)).cast("double") if num_items is None else F.lit(float(num_items))
    return df.groupBy(*by).agg(
        (F.coalesce(F.sum(value), F.lit(0.0)) / items).alias(name), F.count("lp").alias("tokens")
    )


def ce_loss(df: DataFrame, by: Sequence[str] = (), num_items: float | None = None) -> DataFrame:
    """Cross-entropy: mean of ``-log p`` over the target tokens of each batch."""
    return _masked_mean(_scored(df), -F.col("lp"), "ce_loss", by, num_items)


def dft_loss(df: DataFrame, by: Sequence[str] = (), num_items: float | None = None) -> DataFrame:
    """Cross-entropy weighted by the probability of the token: mean of ``-p log p``."""
    return _masked_mean(_scored(df), -F.exp("lp") * F.col("lp"), "dft_loss", by, num_items)


def token_accuracy(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of target tokens that are the most likely class."""
    counted = F.col("target") != F.lit(MASKED)
    rows = with_target(df).select(
        *by, counted.alias("counted"), F.when(counted, sc.top1(F.col("logits")) == F.col("target")).alias("hit")
    )
    return rows.groupBy(*by).agg(
        (F.count_if("hit").cast("double") / F.greatest(F.count_if("counted"), F.lit(1))).alias("token_accuracy"),
        F.count_if("counted").alias("tokens"),
    )


def masked_entropy(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean entropy where the label of the position itself (not the next) is not masked."""
    rows = df.select(
        *by, F.when(F.col("label") != F.lit(MASKED), sc.entropy(F.col("logits"))).alias("entropy")
    )
    return rows.groupBy(*by).agg(
        F.coalesce(F.avg("entropy"), F.lit(0.0)).alias("entropy"), F.count("entropy").alias("tokens")
    )
