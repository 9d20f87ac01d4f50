"""Curation of newly arriving files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sftlake.functions.text import token_count
from sftlake.operators.curate import Counter, build_sft_record, judged
from sftlake.sources.io import RAW_SCHEMA


def curate_stream(
    spark: SparkSession, in_path: str, out_dir: str, checkpoint: str, min_len: int, max_len: int,
    schema: str = RAW_SCHEMA, prepare: Callable[[DataFrame], DataFrame] | None = None,
    count: Counter = token_count, files_per_batch: int | None = None, source_format: str = "parquet",
) -> StreamingQuery:
    """Curate all files (Parquet, or ``source_format="json"``) that are there and stop; run again to take up new ones.

    Every step is stateless, so the stream needs no state store and no watermark, and the
    file sink's log makes the result exactly-once. Order across files is not defined, so a
    quota is left to the batch job. Counters are in ``recentProgress`` under ``curation``.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    raw = reader.format(source_format).load(in_path)
    if prepare is not None:
        raw = prepare(raw)
    what = F.col("outcome")
    seen = judged(raw, min_len, max_len, count).observe(
        "curation",
        F.count(F.lit(1)).alias("checked"),
        F.count_if(what == "kept").alias("kept"),
        F.count_if(what == "no_solution").alias("skipped_no_solution"),
        F.count_if(what == "length").alias("skipped_length"),
    )
    return (
        build_sft_record(seen.where(what == "kept"))
        .writeStream.format("parquet").outputMode("append")
        .option("path", out_dir).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
