"""Corpus pipeline: from raw documents to token files, in five stages.

Each stage works on all rows that the stage before has kept, written as Parquet and read again. All but the last return the
columns of ``documents``, whatever else those are called.

1. quality: documents that the factorisation machine rejects go.
2. near_dedup: of each group of near-duplicates (five-word shingles, similarity 0.8 or more) the document of the smallest id stays; rows of
   one id are one document.
3. decontaminate: documents with a window of a benchmark item go.
4. mix: documents are taken, left out or repeated so that each source comes near its target.
5. tokens: token-id files are written; one row per document tells its place, size and checksum, read back from the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sftlake.llm import decontaminate, mixing, near, quality, token_files
from sftlake.llm.common import crc_remainder, free_name, stored, table, vocabulary
from sftlake.session import shared_dir


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of score 0.5 and more. A third of the labels, by hash of the id, is left for measuring."""
    machine = quality.train(docs, table(spark, sf_dir, "labels"), usable=crc_remainder(F.col("doc_id"), 3) != 1)
    name = free_name(docs.columns, "_score")
    return quality.score(docs, machine, name=name).where(F.col(name) >= 0.5).drop(name)


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates. An id is one document: of several rows of it one stays, the first by a hash of the text, also
    where their texts differ. Rows without an id cannot be told apart and stay."""
    found = near.near_duplicates(docs)
    kept = found.where("kept and doc_id is not null").select(F.col("doc_id").alias("_id")).distinct()
    first = F.row_number().over(W.partitionBy("doc_id").orderBy(F.xxhash64("text")))
    place = free_name(docs.columns, "_k")
    single = docs.join(kept, docs["doc_id"] == kept["_id"], "left_semi").withColumn(place, first).where(F.col(place) == 1).drop(place)
    return single.unionByName(docs.where("doc_id is null"))


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    mixed, _ = mixing.mix_rows(docs)
    times = F.when(F.col("_size") > 0, (F.col("_taken") / F.col("_size")).cast("int")).otherwise(F.lit(0))
    return mixed.select("_row", F.explode(F.array_repeat(F.lit(1), times))).select("_row.*")


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files. Executors' heaps have grown in the stages before, so workers keep no
    pieces."""
    path = shared_dir(spark, "pipeline-tokens")
    token_files.write_tokens(docs, path, vocabulary(), special_tokens=True, keep_pieces=False)
    return token_files.read_token_digests(spark, path)


STAGES = [
    ("quality", keep_good),
    ("near_dedup", keep_distinct),
    ("decontaminate", keep_clean),
    ("mix", mix_sources),
    ("tokens", write_token_files),
]

#: Learned scores, signatures and tokenization have no SQL; the stages are tested one by one against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
