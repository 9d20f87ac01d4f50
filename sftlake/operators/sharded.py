"""Scores of positions whose logits are cut into blocks of classes.

``shards`` has ``(seq_id, pos, first_class, logits, target)``: a row per position and block of classes, ``first_class`` being
the class of the block's first logit, and ``target`` the class to be predicted (`MASKED` where there is none), the same in all
blocks of a position. With a vocabulary of 150,000 a position then is no single row of half a megabyte.

Each block is reduced where it is read to its largest logit and class, and to sums of exponentials relative to a pivot, the multiple of
``PIVOT`` below the largest logit. Sums of equal pivots add up, so Spark combines them before the shuffle, and logits never move. A
position has as many pivots as its blocks' maxima spread over multiples of ``PIVOT``, mostly one; they are brought together last.

As with whole rows: a logit of -inf makes an entropy NaN, and the lowest class wins ties. Null logits in a block are left out, as if their class did
not exist; a position without any logit has null scores; a target outside of all blocks has a null log-probability.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftlake.functions.once import computed
from sftlake.operators.examples import MASKED

#: exp(PIVOT) times any number of classes is far from the largest double.
PIVOT = 256.0
_BY = ("seq_id", "pos")


def shard_logits(df: DataFrame, classes: int) -> DataFrame:
    """Rows of whole logits as blocks of ``classes``, for writing a table that `position_scores` reads."""
    blocks = F.sequence(F.lit(0), F.greatest(F.ceil(F.size("logits") / F.lit(classes)).cast("int") - F.lit(1), F.lit(0)))
    kept = [c for c in df.columns if c != "logits"]
    rows = df.select(*kept, "logits", F.explode(blocks).alias("_block"))
    return rows.select(
        *kept, (F.col("_block") * F.lit(classes)).alias("first_class"), F.slice("logits", F.col("_block") * F.lit(classes) + F.lit(1), classes).alias("logits")
    )


def _block(shards: DataFrame) -> DataFrame:
    """Each block as (largest logit, its class, pivot, sum of exponentials, weighted sum, value at the target)."""
    held = F.filter("logits", lambda x: x.isNotNull())
    rows = computed(shards.withColumn("_held", held), _top=F.array_max("_held").cast("double"))
    pivot = F.when(F.col("_top") == float("-inf"), F.lit(0.0)).otherwise(F.floor(F.col("_top") / F.lit(PIVOT)) * F.lit(PIVOT))
    # floor() is a whole number type, which has no place for NaN or infinity: those pass as they are.
    finite = ~F.isnan("_top") & (F.abs("_top") < F.lit(1e18))
    rows = rows.withColumn("_pivot", F.when(finite | (F.col("_top") == float("-inf")), pivot).otherwise(F.col("_top")))
    sums = F.aggregate(
        "_held", F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("t")),
        lambda acc, x: _added(acc, x.cast("double"), F.col("_pivot")),
    )
    index = F.col("target") - F.col("first_class")
    inside = (F.col("target") != MASKED) & (index >= 0) & (index < F.size("logits"))
    return computed(rows, _sums=sums).select(
        *_BY, "target", "_pivot", F.col("_sums.s").alias("s"), F.col("_sums.t").alias("t"),
        F.when(F.col("_top").isNotNull(), F.struct(F.col("_top").alias("top"), (-(F.col("first_class") + F.array_position("logits", F.array_max("logits")) - F.lit(1))).alias("cls"))).alias("best"),
        F.when(inside, F.get("logits", index.cast("int")).cast("double")).alias("at_target"),
    )


def _added(acc: Column, x: Column, pivot: Column) -> Column:
    e = F.exp(x - pivot)
    return F.struct((acc["s"] + e).alias("s"), (acc["t"] + e * (x - pivot)).alias("t"))


def position_scores(shards: DataFrame) -> DataFrame:
    """(seq_id, pos, target, lse, entropy, top1, lp) of every position; ``lp`` is null where the target is masked."""
    same = _block(shards).groupBy(*_BY, "_pivot").agg(
        F.max("target").alias("target"), F.sum("s").alias("s"), F.sum("t").alias("t"), F.max("best").alias("best"), F.max("at_target").alias("at_target")
    )
    # One row per pivot of a position: a list of one, seldom of a few.
    part = F.struct(F.col("_pivot").alias("p"), "s", "t")
    merged = same.groupBy(*_BY).agg(
        F.max("target").alias("target"), F.collect_list(F.when(F.col("_pivot").isNotNull(), part)).alias("parts"), F.max("_pivot").alias("p"),
        F.max("best").alias("best"), F.max("at_target").alias("at_target"),
    )
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("t"))
    # Sums relative to the largest pivot: a part's weight is exp(p - largest), and its weighted sum shifts by (p - largest) per unit.
    total = F.aggregate("parts", zero, lambda acc, x: _shifted(acc, x, F.col("p")))
    rows = computed(merged, _total=total)
    lse = F.when(F.col("p").isNotNull(), F.when(F.col("_total.s") > 0, F.col("p") + F.ln("_total.s")).otherwise(F.lit(float("nan"))))
    rows = rows.withColumn("lse", lse)
    entropy = F.col("lse") - (F.col("p") + F.col("_total.t") / F.col("_total.s"))
    return rows.select(
        *_BY, "target", "lse", F.when(F.col("p").isNotNull(), entropy).alias("entropy"), (-F.col("best.cls")).cast("int").alias("top1"),
        F.when(F.col("target") != MASKED, F.col("at_target") - F.col("lse")).alias("lp"),
    )


def _shifted(acc: Column, part: Column, largest: Column) -> Column:
    gap = F.when(part["p"] == largest, F.lit(0.0)).otherwise(part["p"] - largest)
    e = F.exp(gap)
    return F.struct((acc["s"] + e * part["s"]).alias("s"), (acc["t"] + e * (part["t"] + gap * part["s"])).alias("t"))


def score_losses(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Cross-entropy, its probability-weighted form, accuracy and entropy over the counted positions of `position_scores`."""
    counted = F.col("target") != MASKED
    items = F.greatest(F.count("lp"), F.lit(1)).cast("double")
    return scores.groupBy(*by).agg(
        F.count("lp").alias("tokens"),
        (F.coalesce(F.sum(-F.col("lp")), F.lit(0.0)) / items).alias("ce_loss"),
        (F.coalesce(F.sum(-F.exp("lp") * F.col("lp")), F.lit(0.0)) / items).alias("dft_loss"),
        (F.count_if(counted & (F.col("top1") == F.col("target"))).cast("double") / F.greatest(F.count_if(counted), F.lit(1))).alias("token_accuracy"),
        F.avg(F.when(counted, F.col("entropy"))).alias("entropy"),
    )
