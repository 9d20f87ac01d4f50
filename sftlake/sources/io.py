"""Readers and writers. Every reader declares its schema; nothing is inferred."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

SFT_SCHEMA = "prompt string, response string, solution string, difficulty string, source string"
RAW_SCHEMA = "ord bigint, input string, output string, solution string, difficulty string, source string"
DOCUMENT_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
METRIC_SCHEMA = "run_id string, step bigint, key string, value double, written_us bigint"

# Field names of an exported run history, and the names they get here.
HISTORY_FIELDS = {
    "_step": "_step", "_runtime": "_runtime", "_timestamp": "_timestamp", "epoch": "epoch",
    "train/loss": "train_loss", "train/lr": "train_lr", "train/entropy": "train_entropy",
    "train/grad_norm": "train_grad_norm", "val/loss": "val_loss", "val/entropy": "val_entropy",
}
_HISTORY_TYPES = {"_step": "bigint", "epoch": "int"}
HISTORY_SCHEMA = ", ".join(f"`{k}` {_HISTORY_TYPES.get(k, 'double')}" for k in HISTORY_FIELDS)


def read_sft_jsonl(
    spark: SparkSession, path: str | Sequence[str], strict: bool = True, schema: str = SFT_SCHEMA,
    order: str | None = None,
) -> DataFrame:
    """One JSON object per line. A malformed line fails the read; with ``strict=False`` it
    becomes a row whose ``_corrupt_record`` holds the line.

    ``order="stored"`` also reads the ``ord`` field, as curation writes it; ``order="derived"``
    numbers the lines by file and place in it, for files that have none.
    """
    if order not in (None, "stored", "derived"):
        raise ValueError("order is None, 'stored' or 'derived'")
    if order == "stored":
        schema = f"ord bigint, {schema}"
    if strict:
        df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    else:
        df = (
            spark.read.schema(f"{schema}, _corrupt_record string")
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
        )
    return with_source_order(df) if order == "derived" else df


def with_source_order(scan: DataFrame) -> DataFrame:
    """Add ``ord``: the number of each row of a file scan, by file name, then place in the file.

    A block of a file is read by one task from its start to its end, so the ids that grow
    within a task give the place in the block. Blocks are counted first (one row each, bounded by
    the splits of the scan), which reads the files once more.
    """
    place = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    rows = scan.select(*scan.columns, place.alias("_block"), F.monotonically_increasing_id().alias("_id"))
    blocks = rows.groupBy("_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = blocks.select(F.col("_block").alias("_at"), (before - F.col("_first")).alias("_shift"))
    return rows.join(F.broadcast(starts), F.col("_block") == F.col("_at")).select(
        (F.col("_id") + F.col("_shift")).cast("bigint").alias("ord"), *scan.columns
    )


def write_sft_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per line, nulls and non-ASCII text written as they are, in parallel parts."""
    df.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def quota_path(stem: str, max_len: int, max_samples: int) -> str:
    """Output name that tells the length limit and the quota."""
    return f"{stem.removesuffix('.jsonl')}_sl{max_len}_{max_samples}.jsonl"


def read_raw_corpus(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """A raw corpus in Parquet, laid out by ``split``; naming one reads only its folder."""
    df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == F.lit(split))


def read_run_history(
    spark: SparkSession, paths: str | Sequence[str], run_pattern: str = r"([^/_]+)\.json$"
) -> DataFrame:
    """Exported run histories: files that each hold one JSON array of metric rows.

    Many runs are read in one scan; the run id comes from the file path.
    """
    raw = spark.read.schema(HISTORY_SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(paths)
    return raw.select(
        F.regexp_extract(F.col("_metadata.file_path"), run_pattern, 1).alias("run_id"),
        *(F.col(f"`{k}`").alias(v) for k, v in HISTORY_FIELDS.items()),
    )


def write_observed(df: DataFrame, path: str, counters: Mapping[str, Column],
                   output: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, int]:
    """Write a frame and return counters taken in the same pass.

    The counters see every row of ``df``; ``output`` maps the observed frame to what is
    written (by filters and projections), and defaults to the frame itself.
    """
    seen = Observation()
    observed = df.observe(seen, *(c.alias(name) for name, c in counters.items()))
    result = observed if output is None else output(observed)
    write_sft_jsonl(result, path)
    return {name: seen.get[name] for name in counters}


def append_metrics(df: DataFrame, path: str) -> None:
    """Append long metric rows, one folder per run.

    Rebalancing gives small runs one file and splits a large run over several tasks.
    """
    df.hint("rebalance", "run_id").write.mode("append").partitionBy("run_id").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The metrics table; of repeated writes of a (run, step, key) the latest counts, and of those
    written at the same time the largest value."""
    rows = spark.read.schema(METRIC_SCHEMA).parquet(path)
    return rows.groupBy("run_id", "step", "key").agg(
        F.max_by("value", F.struct("written_us", "value")).alias("value")
    )
