"""Scores over a column of class logits (an array of floats or doubles; computed in double).

Row maximum and log-sum-exp are bound once: a lambda that mentions an outer expression
evaluates it for every element, which would be quadratic in the number of classes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sftlake.functions.once import bind


def log_sum_exp(logits: Column) -> Column:
    return bind(
        F.array_max(logits).cast("double"),
        lambda top: top + F.ln(F.aggregate(logits, F.lit(0.0), lambda acc, x: acc + F.exp(x.cast("double") - top))),
    )


def entropy(logits: Column) -> Column:
    """Shannon entropy in nats. A logit of -inf gives NaN (0 times -inf)."""
    return bind(
        log_sum_exp(logits),
        lambda lse: -F.aggregate(
            logits, F.lit(0.0), lambda acc, x: acc + F.exp(x.cast("double") - lse) * (x.cast("double") - lse)
        ),
    )


def log_prob(logits: Column, index: Column) -> Column:
    """Log-probability of class ``index`` (0-based)."""
    return F.element_at(logits, index + F.lit(1)).cast("double") - log_sum_exp(logits)


def log_probs(logits: Column, indexes: Column) -> Column:
    """Log-probabilities of an array of classes, in the same order."""
    return bind(
        log_sum_exp(logits),
        lambda lse: F.transform(indexes, lambda i: F.element_at(logits, i + F.lit(1)).cast("double") - lse),
    )


def top1(logits: Column) -> Column:
    """Most likely class; the lowest index wins ties."""
    return (F.array_position(logits, F.array_max(logits)) - F.lit(1)).cast("int")


def perplexity(loss: Column, cap: float = 20.0) -> Column:
    """``exp(loss)``, with the loss cut at ``cap`` so that it stays finite."""
    return F.exp(F.least(loss.cast("double"), F.lit(float(cap))))
