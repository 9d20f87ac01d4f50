"""Order of examples, worker and step in every epoch, as arithmetic on row numbers.

Rows are numbered once. The place of row r in epoch e is a keyed permutation of the numbers 0 to n - 1: a Feistel network on pairs
(a, b) with a * b just above n, and a further round trip (cycle walking) for the few numbers that fall on the places beyond n. So an epoch is a bijection
for every key, a further epoch moves no row, and a resumed job finds any epoch, worker and step by computing it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftlake.functions.once import bind
from sftlake.operators.ordering import int_div, number_by_position

ROUNDS = 4


def _mixed(seed: int, epoch: Column, turn: Column, half: str, value: Column) -> Column:
    """A 32-bit number from a digest of the key and the other half."""
    text = F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), turn.cast("string"), F.lit(half), value.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def permuted(number: Column, total: Column, epoch: Column, seed: int) -> Column:
    """Place of row ``number`` (0 to ``total`` - 1) in an epoch."""
    left = F.greatest(F.ceil(F.sqrt(total.cast("double"))).cast("bigint"), F.lit(1).cast("bigint"))
    right = int_div(total + left - F.lit(1), left)

    def once(x: Column) -> Column:
        def turn(pair: Column, i: Column) -> Column:
            moved = F.pmod(pair["l"] + _mixed(seed, epoch, i, "l", pair["r"]), left)
            return bind(moved, lambda l: F.struct(l.alias("l"), F.pmod(pair["r"] + _mixed(seed, epoch, i, "r", l), right).alias("r")))  # noqa: E741

        start = F.struct(int_div(x, right).alias("l"), F.pmod(x, right).alias("r"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda p: p["l"] * right + p["r"])

    # The places beyond the last row are fewer than `left`, so a walk leaves them in fewer steps.
    walk = lambda x: F.aggregate(F.sequence(F.lit(1).cast("bigint"), left), x, lambda p, _: F.when(p < total, p).otherwise(once(p)))
    return bind(once(number.cast("bigint")), lambda x: F.when(x < total, x).otherwise(walk(x)))


def numbered_rows(df: DataFrame, order: str) -> DataFrame:
    """The rows with their number ``_rn`` and count ``_total``: write this once and give it to `epoch_batches`."""
    return number_by_position(df, order).select(*df.columns, "_rn", "_total")


def epoch_batches(numbered: DataFrame, epochs: int, batch_size: int, workers: int = 1, seed: int = 42, first_epoch: int = 0) -> DataFrame:
    """Every row once an epoch, with ``epoch`` (from ``first_epoch``), ``rank``, ``step`` (the worker's micro-batch) and ``pos_in_batch``.

    Batches go round the workers in turn. With several workers an incomplete last batch, and batches that do not go round, are left out, as in
    `step_plan`. Nothing is shuffled.
    """
    if min(epochs, batch_size, workers) < 1:
        raise ValueError("epochs, batch size and workers are positive")
    rows = numbered.select("*", F.explode(F.sequence(F.lit(first_epoch), F.lit(first_epoch + epochs - 1))).alias("epoch"))
    place = permuted(F.col("_rn"), F.col("_total"), F.col("epoch"), seed)
    rows = rows.withColumn("_place", place).withColumn("_batch", int_div(F.col("_place"), batch_size))
    if workers > 1:
        rounds = int_div(int_div(F.col("_total"), batch_size), workers)
        rows = rows.where(F.col("_batch") < rounds * workers)
    return rows.select(
        *(c for c in numbered.columns if c not in ("_rn", "_total")), "epoch", F.pmod(F.col("_batch"), F.lit(workers)).cast("int").alias("rank"),
        int_div(F.col("_batch"), workers).alias("step"), F.pmod(F.col("_place"), F.lit(batch_size)).cast("int").alias("pos_in_batch"),
    )
