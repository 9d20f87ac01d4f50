"""Analytics of training-run logs.

``batches`` has one row per micro-batch and worker: ``run_id, epoch`` (from 1)``, rank,
idx`` (from 0, per epoch)``, loss, tokens, ts_us`` and, for the full log, ``entropy,
token_acc, grad_norm, mem_alloc, mem_reserved``. A decimal ``loss`` makes every mean
independent of the order of addition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sftlake.functions import schedule as sd
from sftlake.functions.scoring import perplexity
from sftlake.operators.ordering import null_safe, running
from sftlake.session import stored


def metric_series(history: DataFrame, key: str, x: str = "_step") -> DataFrame:
    """The non-null points of one metric."""
    return history.where(F.col(key).isNotNull()).select("run_id", x, key)


def all_series(history: DataFrame, keys: Sequence[str], x: str = "_step") -> DataFrame:
    """The non-null points of many metrics as long rows, in one pass."""
    return history.unpivot(["run_id", x], list(keys), "key", "value").where("value is not null")


def log_step_sample(df: DataFrame, every: int, step: str = "_step") -> DataFrame:
    return df.where(F.pmod(F.col(step), F.lit(every)) == 0)


def unit_scale(history: DataFrame) -> DataFrame:
    """Seconds to hours and learning rate to units of 1e-5."""
    return history.withColumn("hours", sd.hours(F.col("_runtime"))).withColumn(
        "lr_e5", sd.lr_e5(F.col("train_lr"))
    )


# -- training log ----------------------------------------------------------------------


_LAST = ("entropy", "token_acc", "grad_norm")
_PEAK = ("mem_alloc", "mem_reserved")


def optimizer_steps(batches: DataFrame, accum: int) -> DataFrame:
    """One row per optimizer step: every ``accum`` batches, or at the end of an epoch.

    Loss is that of the first worker, tokens those of all; entropy, accuracy and gradient
    norm come from the step's last micro-batch on the first worker. Batches are read and
    shuffled once, reduced by ``accum`` times the number of workers, and the reduced rows are stored: the steps of earlier epochs
    are a running sum over one row per epoch, so a run of any length is no hot key.
    """
    first = F.col("rank") == 0
    last = F.when(first, F.col("idx"))
    at = (F.floor(F.col("idx") / F.lit(accum)) + F.lit(1)).cast("bigint")
    steps = batches.groupBy("run_id", "epoch", at.alias("_step")).agg(
        F.sum(F.when(first, F.col("loss"))).alias("loss_sum"),
        F.count_if(first).alias("batches"),
        F.sum("tokens").alias("tokens"),
        F.min("ts_us").alias("_start_us"),
        F.max("ts_us").alias("end_us"),
        *(F.max_by(F.when(first, F.col(c)), last).alias(c) for c in _LAST if c in batches.columns),
        *(F.max(c).alias(c) for c in _PEAK if c in batches.columns),
    )
    steps = stored(steps, "optimizer-steps")
    epochs = steps.groupBy("run_id", "epoch").agg(F.max("_step").alias("_steps"), F.min("_start_us").alias("epoch_start_us"))
    earlier = W.partitionBy("run_id").orderBy("epoch").rowsBetween(W.unboundedPreceding, -1)
    starts = epochs.select("run_id", "epoch", "epoch_start_us", F.coalesce(F.sum("_steps").over(earlier), F.lit(0)).alias("_before"))
    placed = null_safe(steps, starts, ["run_id", "epoch"])
    return placed.withColumn("step", F.col("_before") + F.col("_step")).drop("_step", "_start_us", "_before")


def running_loss(batches: DataFrame) -> DataFrame:
    """Mean loss of the epoch so far at every micro-batch of every worker."""
    out = running(
        batches.select("run_id", "epoch", "rank", "idx", "loss"), ["run_id", "epoch", "rank"], "idx",
        {"_sum": ("sum", F.col("loss")), "_n": ("count", F.col("loss"))},
    )
    mean = F.try_divide(F.col("_sum").cast("double"), F.col("_n"))
    return out.select("run_id", "epoch", "rank", "idx", mean.alias("running_loss"))


def _windows(batches: DataFrame, accum: int, every: int) -> DataFrame:
    """One row per log step: totals since the previous log of the epoch, and its rates.

    Steps after the last log step of an epoch belong to no window. The previous log and
    the loss since the start of the epoch are running values over these reduced rows, which are stored for it.
    """
    steps = optimizer_steps(batches, accum)
    at = F.col("step")
    windows = steps.groupBy(
        "run_id", "epoch", F.ceil(at / F.lit(every)).cast("bigint").alias("window")
    ).agg(
        F.max("step").alias("step"),
        F.sum("loss_sum").alias("loss_sum"), F.sum("batches").alias("batches"),
        F.sum("tokens").alias("tokens"), F.max("end_us").alias("end_us"),
        F.min("epoch_start_us").alias("epoch_start_us"),
        *(F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in _LAST if c in steps.columns),
        *(F.max(c).alias(c) for c in _PEAK if c in steps.columns),
    ).where(F.pmod(F.col("step"), F.lit(every)) == 0)
    timed = running(
        stored(windows, "log-windows"), ["run_id", "epoch"], "window",
        {"_prev_us": ("last", F.col("end_us")), "_loss": ("sum", F.col("loss_sum")), "_n": ("sum", F.col("batches"))}, exclusive=["_prev_us"],
    )
    seconds = (F.col("end_us") - F.coalesce("_prev_us", "epoch_start_us")) / F.lit(1e6)
    return (
        timed.withColumn("seconds", F.greatest(seconds, F.lit(1e-6)))
        .withColumn("tokens_per_sec", F.col("tokens") / F.col("seconds"))
        .withColumn("loss", F.try_divide(F.col("_loss").cast("double"), F.col("_n")))
    )


def throughput_windows(batches: DataFrame, accum: int, every: int) -> DataFrame:
    """Tokens of all workers per second between log steps; an epoch starts a new window."""
    return _windows(batches, accum, every).select(
        "run_id", "epoch", "step", "tokens", "seconds", "tokens_per_sec"
    )


def train_log(
    batches: DataFrame, accum: int, every: int, lr: Column | None = None
) -> DataFrame:
    """The full row logged every ``every`` optimizer steps. ``lr`` is an expression over ``step``."""
    windows = _windows(batches, accum, every)
    return windows.select(
        "run_id", "epoch", "step", "loss",
        F.col("loss").alias("nll"), perplexity(F.col("loss")).alias("perplexity"),
        *(c for c in _LAST if c in windows.columns),
        *([] if lr is None else [lr.alias("lr")]),
        "tokens_per_sec",
        *((F.col(c) / F.lit(1e9)).alias(f"gpu_{c}_gb") for c in _PEAK if c in windows.columns),
    )


def worst_case_memory(batches: DataFrame, by: Sequence[str] = ("run_id", "epoch")) -> DataFrame:
    """Peak memory over all workers in GB."""
    return batches.groupBy(*by).agg(
        (F.max("mem_alloc") / F.lit(1e9)).alias("alloc_gb"),
        (F.max("mem_reserved") / F.lit(1e9)).alias("reserved_gb"),
    )


# -- means over workers ----------------------------------------------------------------


def _mean(column: str) -> Column:
    """Mean as sum over count, so that a decimal column is added up exactly."""
    return F.try_divide(F.sum(column).cast("double"), F.count(column))


def validation_summary(batches: DataFrame, max_batches: int = 0) -> DataFrame:
    """Metrics of each validation pass: mean over a worker's batches, then plain mean over workers.

    A pass is named by its optimizer ``step``; an epoch may hold several. ``max_batches`` > 0 uses each
    worker's first batches of a pass in mid-epoch (``mid`` true), the pass that ends an epoch is never
    cut. This stays two aggregations: a worker with few batches weighs as much as one with many.
    """
    whole = ~F.coalesce(F.col("mid"), F.lit(False))
    rows = batches if not max_batches else batches.where(whole | (F.col("idx") < F.lit(max_batches)))
    per_rank = rows.groupBy("run_id", "epoch", "step", "rank").agg(
        _mean("loss").alias("loss"), _mean("entropy").alias("entropy"),
        _mean("token_acc").alias("token_acc"), F.count(F.lit(1)).alias("n"),
    )
    return per_rank.groupBy("run_id", "epoch", "step").agg(
        F.avg("loss").alias("loss"), F.avg("entropy").alias("entropy"),
        F.avg("token_acc").alias("token_acc"),
        F.max("n").alias("n_batches"),
    ).select(
        "run_id", "epoch", "step", "loss", F.col("loss").alias("nll"),
        perplexity(F.col("loss")).alias("perplexity"), "entropy", "token_acc", "n_batches",
    )


def epoch_summary(batches: DataFrame) -> DataFrame:
    """Mean batch loss of each worker, then the mean over workers."""
    per_rank = batches.groupBy("run_id", "epoch", "rank").agg(_mean("loss").alias("loss"))
    return per_rank.groupBy("run_id", "epoch").agg(F.avg("loss").alias("train_loss"))


# -- whole runs ------------------------------------------------------------------------


def compare_runs(histories: Sequence[DataFrame], metric: str = "train_loss") -> DataFrame:
    """First and last point of a metric per run, with hours since the start of the run."""
    both = histories[0]
    for other in histories[1:]:
        both = both.unionByName(other, allowMissingColumns=True)
    point = F.struct("_runtime", "_step", metric)
    return (
        both.where(F.col(metric).isNotNull())
        .groupBy("run_id")
        .agg(
            F.count(F.lit(1)).alias("points"),
            F.min_by(point, F.struct("_runtime", "_step")).alias("a"),
            F.max_by(point, F.struct("_runtime", "_step")).alias("b"),
        )
        .select(
            "run_id", "points",
            sd.hours(F.col("a._runtime")).alias("first_hours"), F.col(f"a.{metric}").alias("first"),
            sd.hours(F.col("b._runtime")).alias("last_hours"), F.col(f"b.{metric}").alias("last"),
        )
    )


def lr_audit(
    history: DataFrame, warmup: int, total: int, peak: float, speeds: Sequence[float] = (1.0, 2.0)
) -> DataFrame:
    """Largest gap between the logged and each scheduled learning rate, and the best fit."""
    logged = history.where(F.col("train_lr").isNotNull())
    gaps = [
        F.max(F.abs(F.col("train_lr") - sd.lr_cosine(F.col("_step"), warmup, total, peak, s))).alias(f"gap_{s:g}x")
        for s in speeds
    ]
    table = logged.groupBy("run_id").agg(F.count(F.lit(1)).alias("points"), *gaps)
    fits = F.array_sort(F.array(*(F.struct(F.col(f"`gap_{s:g}x`").alias("gap"), F.lit(float(s)).alias("speed")) for s in speeds)))
    return table.withColumn("best_speed", fits[0]["speed"])


def _shown(loss: Column) -> Column:
    return F.when(loss.isNotNull(), F.format_string("%.4f", loss)).otherwise("n/a")


def final_loss_of_run(runs: DataFrame, name: str) -> DataFrame:
    """Loss of the latest run called ``name``: validation, else training, else ``n/a``.

    ``runs`` has ``run_id, name, created, val_loss, train_loss``.
    """
    loss = F.coalesce(F.col("run.val_loss"), F.col("run.train_loss"))
    return (
        runs.where(F.col("name") == F.lit(name))
        .groupBy("name")
        .agg(F.max_by(F.struct("run_id", "val_loss", "train_loss"), F.struct("created", "run_id")).alias("run"))
        .select(
            "name", "run.run_id",
            _shown(loss).alias("final_loss"),
        )
    )


def version_notes(df: DataFrame, title: str) -> DataFrame:
    """Release note of a run from ``run, day, loss`` (loss may be null)."""
    note = F.concat_ws(
        " | ", F.lit(title), F.date_format("day", "yyyy-MM-dd"),
        F.concat(F.lit("run: "), F.col("run")),
        F.concat(F.lit("final loss: "), _shown(F.col("loss"))),
    )
    return df.select("run", note.alias("note"))
