"""Curation: raw reasoning corpus to prompt/response records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftlake.functions import text as tx
from sftlake.functions.once import bind, computed, holds
from sftlake.operators.ordering import quota_cutoff

SFT_FIELDS = ("prompt", "response", "solution", "difficulty", "source")

Counter = Callable[[Column], Column]


def _or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def has_solution() -> Column:
    return (_or_empty("output") != "") & (_or_empty("solution") != "")


def response() -> Column:
    return tx.format_response(tx.extract_think(F.col("output")), F.col("solution"))


def _fits(text: Column, min_len: int, max_len: int, count: Counter) -> Column:
    return holds(count(text), lambda n: n.between(min_len, max_len))


def judged(df: DataFrame, min_len: int, max_len: int, count: Counter = tx.token_count) -> DataFrame:
    """Add ``outcome`` and the formatted ``response`` (null without a solution), each computed once."""
    def told(text: Column) -> Column:
        kept = _fits(text, min_len, max_len, count)
        return F.struct(F.when(kept, "kept").otherwise("length").alias("outcome"), text.alias("response"))

    nothing = F.struct(F.lit("no_solution").alias("outcome"), F.lit(None).cast("string").alias("response"))
    verdict = F.when(~has_solution(), nothing).otherwise(bind(response(), told))
    return computed(df, _judged=verdict).select(*df.columns, "_judged.outcome", "_judged.response")


def outcome(min_len: int, max_len: int, count: Counter = tx.token_count) -> Column:
    """What curation does with a raw row: ``no_solution``, ``length`` or ``kept``."""
    return (
        F.when(~has_solution(), "no_solution")
        .when(~_fits(response(), min_len, max_len, count), "length")
        .otherwise("kept")
    )


def filter_has_solution(df: DataFrame) -> DataFrame:
    """Drop rows whose output or solution is missing or empty."""
    return df.where(has_solution())


def with_response(df: DataFrame) -> DataFrame:
    """Add the formatted response, computed once for all that follows."""
    return computed(df, response=response())


def filter_token_length(
    df: DataFrame, min_len: int, max_len: int, count: Counter = tx.token_count
) -> DataFrame:
    """Keep responses of ``min_len`` to ``max_len`` tokens, both inclusive."""
    return df.where(_fits(F.col("response"), min_len, max_len, count))


def build_sft_record(df: DataFrame) -> DataFrame:
    """Rename to the SFT fields; a missing value becomes the empty string."""
    return df.select(
        *(["ord"] if "ord" in df.columns else []),
        _or_empty("input").alias("prompt"),
        "response",
        *(_or_empty(c).alias(c) for c in SFT_FIELDS[2:]),
    )


def project_sft_fields(df: DataFrame, order: str | None = None) -> DataFrame:
    """Exactly the five SFT fields, after ``order`` if one is named; a column the input lacks is null."""
    return df.select(
        *([] if order is None else [order]),
        *(F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in SFT_FIELDS)
    )


def curate(
    df: DataFrame, min_len: int, max_len: int, count: Counter = tx.token_count
) -> DataFrame:
    """All records curation keeps. Stateless per row: no shuffle, works on streams too."""
    kept = filter_token_length(with_response(filter_has_solution(df)), min_len, max_len, count)
    return build_sft_record(kept)


def take_quota(df: DataFrame, order: str, n: int, wanted: Column | None = None) -> DataFrame:
    """The first ``n`` rows (that meet ``wanted``) in source order.

    Found as a cut-off position and applied as a range filter that reaches the scan, so
    a quota of millions costs no sort and no single task. Equal positions at the cut-off are an error.
    """
    keep = F.lit(True) if wanted is None else wanted
    cutoff = quota_cutoff(df, order, keep, n)
    kept = df if wanted is None else df.where(wanted)
    return kept if cutoff is None else kept.where(F.col(order) <= F.lit(cutoff))


def curate_quota(
    df: DataFrame, max_samples: int, min_len: int, max_len: int,
    order: str = "ord", count: Counter = tx.token_count,
) -> DataFrame:
    """The first ``max_samples`` curated records in source order."""
    kept = outcome(min_len, max_len, count) == "kept"
    cutoff = quota_cutoff(df, order, kept, max_samples)
    head = df if cutoff is None else df.where(F.col(order) <= F.lit(cutoff))
    return curate(head, min_len, max_len, count)


def curation_counters(
    df: DataFrame, max_samples: int | None, min_len: int, max_len: int,
    order: str = "ord", count: Counter = tx.token_count, by: tuple[str, ...] = (),
) -> DataFrame:
    """Rows checked, kept and skipped, up to the row that fills the quota."""
    what = outcome(min_len, max_len, count)
    if max_samples is not None:
        cutoff = quota_cutoff(df, order, what == "kept", max_samples)
        if cutoff is not None:
            df = df.where(F.col(order) <= F.lit(cutoff))
    return computed(df, outcome=what).groupBy(*by).agg(
        F.count(F.lit(1)).alias("checked"),
        F.count_if(F.col("outcome") == "kept").alias("kept"),
        F.count_if(F.col("outcome") == "no_solution").alias("skipped_no_solution"),
        F.count_if(F.col("outcome") == "length").alias("skipped_length"),
    )


def format_gate(df: DataFrame, order: str = "ord") -> DataFrame:
    """Do responses carry all four tags? The first record's verdict, and all rows counted."""
    ok = tx.has_all_tags(F.col("response"))
    return df.select(order, ok.alias("ok")).agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if("ok").alias("records_ok"),
        F.when(F.min_by("ok", order), "OK").otherwise("FAIL").alias("first_record"),
    )


def tag_coverage(df: DataFrame, order: str = "ord", probe: int = 100, width: int = 120) -> DataFrame:
    """Answer tags in the first ``probe`` rows, with head and tail of the first response.

    Responses are reduced to a flag and their ends before the top-k, in one pass.
    """
    ends = df.select(
        order,
        tx.has_answer_tags(F.col("response")).alias("tagged"),
        F.left("response", F.lit(width)).alias("head"),
        F.right("response", F.lit(width)).alias("tail"),
    )
    return ends.orderBy(order).limit(probe).agg(
        F.count(F.lit(1)).alias("probed"), F.count_if("tagged").alias("tagged"),
        F.min_by("head", order).alias("head"), F.min_by("tail", order).alias("tail"),
    )
