"""Curation of arriving files that ends at a quota."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sftlake.functions.text import token_count
from sftlake.operators.curate import Counter, curate_quota, curation_counters
from sftlake.sources.io import RAW_SCHEMA, SFT_SCHEMA
from sftlake.session import stored

KEPT_SCHEMA = f"ord bigint, {SFT_SCHEMA}"
COUNTERS = ("checked", "kept", "skipped_no_solution", "skipped_length")


def kept_so_far(spark: SparkSession, out_dir: str, before: int | None = None) -> int:
    """Records that micro-batches (before batch ``before``) have written: a count of file footers."""
    rows = read_kept(spark, out_dir)
    return (rows if before is None else rows.where(F.col("batch") < before)).count()


def read_kept(spark: SparkSession, out_dir: str) -> DataFrame:
    """The kept records, with the micro-batch that wrote them."""
    return spark.read.schema(f"{KEPT_SCHEMA}, batch bigint").parquet(out_dir)


def curate_stream_quota(
    spark: SparkSession, in_path: str, out_dir: str, checkpoint: str, max_samples: int, min_len: int, max_len: int,
    schema: str = RAW_SCHEMA, prepare: Callable[[DataFrame], DataFrame] | None = None, count: Counter = token_count,
    files_per_batch: int | None = None, source_format: str = "parquet", order: str = "ord", counters_dir: str | None = None,
) -> StreamingQuery:
    """Curate files as they arrive until ``max_samples`` records are kept; run again to take up new ones.

    The records kept are the first in order of arrival: of earlier micro-batches all, of the one that fills the quota the first by ``order``.
    The state is the output itself. A micro-batch writes its own folder ``batch=<id>``, after counting what earlier ones have
    left; repeated after a failure it counts the same and writes the same folder again, so no record is lost, doubled or above the
    quota, over any number of triggers and restarts. Once the quota is filled further files are passed over unread.
    With ``counters_dir`` each micro-batch also writes what it checked, kept and skipped, up to the row that filled the quota.
    """
    if max_samples <= 0:
        raise ValueError("the quota must be positive")
    # So that the folder can be counted before anything is kept.
    spark.createDataFrame([], KEPT_SCHEMA).write.mode("ignore").parquet(f"{out_dir.rstrip('/')}/batch=-1")

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        left = max_samples - kept_so_far(session, out_dir, before=number)
        if left <= 0:
            return
        # The search for the quota looks at the rows several times.
        rows = stored(batch if prepare is None else prepare(batch), "quota-batch")
        kept = curate_quota(rows, left, min_len, max_len, order, count)
        kept.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch={number}")
        if counters_dir is not None:
            counters = curation_counters(rows, left, min_len, max_len, order, count)
            counters.write.mode("overwrite").parquet(f"{counters_dir.rstrip('/')}/batch={number}")

    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (
        reader.format(source_format).load(in_path)
        .writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
