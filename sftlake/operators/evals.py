"""Grading of generated outputs and summaries of graded results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sftlake.functions import text as tx
from sftlake.functions.once import computed
from sftlake.operators.decode import decode_ids, encode_exact
from sftlake.session import stored


def check_outputs(outputs: DataFrame) -> DataFrame:
    """Add the layout flags, the extracted code and its source to ``output`` rows."""
    output = F.col("output")
    rows = computed(outputs, format=tx.check_format(output), _code=tx.extract_answer_code(output))
    return rows.select(
        *outputs.columns, "format", F.col("_code.code").alias("code"), F.col("_code.source").alias("code_src")
    )


def stdin_precheck(outputs: DataFrame) -> DataFrame:
    """Flag outputs whose code would wait for input."""
    rows = computed(outputs, _code=tx.extract_answer_code(F.col("output")))
    return rows.withColumn(
        "uses_stdin", F.coalesce(tx.uses_stdin(F.col("_code.code")), F.lit(False))
    ).drop("_code")


def grade_results(outputs: DataFrame, tasks: DataFrame, skip_exec: bool = False) -> DataFrame:
    """Grade recorded runs of generated code against the expected output of their task.

    ``outputs`` has ``name, output, stdout, timed_out, elapsed``; ``tasks`` has ``name,
    expected_output``. A run passes when the expected text occurs in its stdout; code
    that reads stdin, or timed out, fails; without code there is no verdict (null), and
    none without a task of that name unless the code fails anyway.
    The join carries no hint: a task table under the broadcast threshold is broadcast,
    a larger one is shuffled and its hot tasks are split by the adaptive skew join.
    """
    rows = check_outputs(outputs).withColumn(
        "tokens", tx.token_count(F.col("output"), tx.TAGS)
    ).join(tasks.select("name", "expected_output"), "name", "left")
    no_verdict = F.col("code").isNull() | (F.col("code") == "")
    if skip_exec:
        no_verdict = F.lit(True)
    verdict = (
        F.when(no_verdict, F.lit(None).cast("boolean"))
        .when(tx.uses_stdin(F.col("code")), F.lit(False))
        .when(F.col("timed_out"), F.lit(False))
        .otherwise(F.col("stdout").contains(F.col("expected_output")))
    )
    ids = [c for c in outputs.columns if c not in ("name", "output", "stdout", "timed_out", "elapsed")]
    return rows.select(
        *ids, "name",
        F.col("format.fully_valid").alias("format_ok"),
        F.col("format.has_think").alias("has_think"),
        F.col("format.has_answer").alias("has_answer"),
        "code_src", verdict.alias("exec_pass"), "elapsed", "tokens",
    )


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(F.lit(100.0) * part, whole.cast("double")), F.lit(0.0))


def eval_summary(results: DataFrame, by: Sequence[str] = (), max_new_tokens: int | None = None) -> DataFrame:
    """Counts and percentages of a graded set. The pass rate ignores rows without verdict.

    With ``max_new_tokens`` it also tells how many outputs stopped before that cap.
    """
    n = F.col("n")
    counted = results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("format_ok").alias("format_ok"),
        F.count_if("has_think").alias("has_think"),
        F.count_if("has_answer").alias("has_answer"),
        F.count_if(F.col("code_src") == "tag").alias("via_tag"),
        F.count_if(F.col("code_src") == "markdown").alias("via_markdown"),
        F.count("exec_pass").alias("executed"),
        F.count_if("exec_pass").alias("passed"),
        *([] if max_new_tokens is None else [F.count_if(F.col("tokens") < max_new_tokens).alias("stopped")]),
        F.sum("elapsed").alias("_elapsed"),
        F.sum("tokens").alias("_tokens"),
    )
    return counted.select(
        *by, "n", "format_ok", "has_think", "has_answer", "via_tag", "via_markdown", "executed", "passed",
        _share(F.col("format_ok"), n).alias("format_pct"),
        _share(F.col("has_think"), n).alias("think_pct"),
        _share(F.col("has_answer"), n).alias("answer_pct"),
        F.try_divide(F.lit(100.0) * F.col("passed"), F.col("executed").cast("double")).alias("pass_pct"),
        F.try_divide(F.col("_elapsed").cast("double"), n).alias("avg_elapsed"),
        F.try_divide(F.col("_tokens").cast("double"), n).alias("avg_tokens"),
        *([] if max_new_tokens is None else ["stopped", _share(F.col("stopped"), n).alias("stop_pct")]),
    )


COMPARED = ("stop_pct", "format_pct", "think_pct", "answer_pct", "pass_pct", "avg_tokens")


def compare_evals(summaries: DataFrame, base: str, tuned: str) -> DataFrame:
    """Metrics of two models side by side, from summaries keyed by ``model``."""
    metrics = [m for m in COMPARED if m in summaries.columns]
    long = summaries.unpivot(["model"], metrics, "metric", "value")
    return long.groupBy("metric").pivot("model", [base, tuned]).agg(F.first("value")).select(
        "metric", F.col(f"`{base}`").alias("base"), F.col(f"`{tuned}`").alias("tuned"),
        (F.col(f"`{tuned}`") - F.col(f"`{base}`")).alias("delta"),
    )


def eval_labels(results: DataFrame) -> DataFrame:
    """Display labels of graded rows."""
    def yes(c: str) -> Column:
        return F.when(F.col(c), "Y").otherwise("N")

    src = F.when(F.col("code_src") == "tag", "tag").when(F.col("code_src") == "markdown", "md").otherwise("-")
    ran = F.when(F.col("exec_pass").isNull(), "skip").when(F.col("exec_pass"), "PASS").otherwise("FAIL")
    return results.select(
        *(c for c in results.columns if c not in ("format_ok", "has_think", "has_answer", "code_src", "exec_pass")),
        F.when(F.col("format_ok"), "OK").otherwise("FAIL").alias("format"),
        yes("has_think").alias("think"), yes("has_answer").alias("answer"),
        src.alias("code_source"), ran.alias("exec"),
    )


def eval_breakdown(results: DataFrame, order: str) -> DataFrame:
    """One labelled row per graded output, in order (a distributed range sort)."""
    return eval_labels(results).orderBy(order)


def special_token_coverage(
    df: DataFrame, text: str, required: Sequence[str] = tx.TAGS
) -> DataFrame:
    """Occurrences of each required special token in a corpus; 0 marks a missing one.

    Tokens are narrowed to the required ones inside the row, and counted there, so what
    is aggregated is one small number per row and token.
    """
    seen = F.filter(tx.tokens(F.col(text), required), lambda t: t.isin(*required))

    def occurrences(token: str) -> Column:
        return F.size(F.filter("seen", lambda t: t == F.lit(token))).cast("bigint")

    counts = computed(df.select(text), seen=seen).agg(
        *(F.coalesce(F.sum(occurrences(token)), F.lit(0)).alias(token) for token in required)
    )
    return counts.unpivot([], list(required), "token", "occurrences").withColumn(
        "missing", F.col("occurrences") == 0
    )


def tag_round_trip(
    df: DataFrame, text: str, tags: Sequence[str] = (tx.THINK_OPEN, tx.ANSWER_OPEN), vocab: DataFrame | None = None, key: str | None = None,
) -> DataFrame:
    """Rows in which a tag of the text is lost when its tokens are joined again.

    With a vocabulary of exact ids (`decode.byte_vocabulary`) and a unique ``key``, texts become ids and ids texts again instead.
    """
    if vocab is None:
        rows = computed(
            df.select(F.col(text).alias("_text")), _back=F.array_join(tx.tokens(F.col("_text"), tx.TAGS), "")
        )
        rows = rows.select(*_held("_text", tags, "_in"), *_held("_back", tags, "_out"))
    else:
        own = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
        ids = stored(encode_exact(own, vocab, "_key", "_text", tx.TAGS), "tag-ids")
        back = decode_ids(ids, vocab, "_key", text="_back")
        # What a text has is looked for before the join: the texts do not move.
        rows = own.select("_key", *_held("_text", tags, "_in")).join(back.select("_key", *_held("_back", tags, "_out")), "_key", "left")
    return rows.agg(
        F.count(F.lit(1)).alias("texts"),
        *(F.count_if(f"_in_{i}").alias(f"with_{i}") for i in range(len(tags))),
        *(F.count_if(F.col(f"_in_{i}") & ~F.col(f"_out_{i}")).alias(f"lost_{i}") for i in range(len(tags))),
    )


def _held(text: str, tags: Sequence[str], name: str) -> list[Column]:
    return [F.col(text).contains(t).alias(f"{name}_{i}") for i, t in enumerate(tags)]
