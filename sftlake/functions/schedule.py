"""Learning-rate schedules, rates, units and checkpoint names as columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def lr_cosine(step: Column, warmup: int, total: int, peak: float, speed: float = 1.0) -> Column:
    """Linear warm-up, then half a cosine. Progress is not clamped, so a schedule that
    is stepped ``speed`` times per optimizer step falls to zero early and rises again."""
    s = step.cast("double") * F.lit(float(speed))
    progress = (s - F.lit(float(warmup))) / F.lit(float(max(total - warmup, 1)))
    curve = F.lit(0.5) * (F.lit(1.0) + F.cos(F.lit(math.pi) * progress))
    return F.when(
        s < F.lit(float(warmup)), F.lit(float(peak)) * s / F.lit(float(max(warmup, 1)))
    ).otherwise(F.lit(float(peak)) * F.greatest(F.lit(0.0), curve))


def lr_linear(step: Column, warmup: int, total: int, peak: float) -> Column:
    """Linear warm-up, then linear decay to zero."""
    s = step.cast("double")
    left = (F.lit(float(total)) - s) / F.lit(float(max(total - warmup, 1)))
    return F.when(
        s < F.lit(float(warmup)), F.lit(float(peak)) * s / F.lit(float(max(warmup, 1)))
    ).otherwise(F.lit(float(peak)) * F.greatest(F.lit(0.0), left))


def tokens_per_sec(tokens: Column, seconds: Column) -> Column:
    """Rate of a generation, 0 when no time was measured."""
    return F.when(seconds > 0, tokens / seconds).otherwise(F.lit(0.0))


def hours(seconds: Column) -> Column:
    return seconds / F.lit(3600.0)


def megabytes(size: Column) -> Column:
    return size / F.lit(1e6)


def lr_e5(lr: Column) -> Column:
    return lr * F.lit(1e5)


def checkpoint_name(epoch: Column, step: Column) -> Column:
    """Directory name for a 0-based epoch and a step; the name counts epochs from 1."""
    return F.concat(
        F.lit("checkpoint-epoch"), (epoch + F.lit(1)).cast("string"),
        F.lit("-step"), step.cast("string"),
    )


def checkpoint_step(name: Column) -> Column:
    """Step in a checkpoint name, null when the name has none."""
    digits = F.regexp_extract(name, r"step(\d+)$", 1)
    return F.when(digits != "", digits).cast("bigint")


def wall_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp without time zone.

    Built from calendar fields, so the session time zone plays no part.
    """
    return (
        F.unix_date(ts.cast("date")).cast("bigint") * F.lit(86_400_000_000)
        + F.hour(ts).cast("bigint") * F.lit(3_600_000_000)
        + F.minute(ts).cast("bigint") * F.lit(60_000_000)
        + (F.date_part(F.lit("SECOND"), ts) * F.lit(1_000_000)).cast("bigint")
    )
