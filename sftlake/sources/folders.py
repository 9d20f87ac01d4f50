"""Checkpoint folders as tables: their files by name, size and time, and the small JSON documents beside the weights.

Listing opens no file: the binary-file scan reads its content column only where a query asks for it, and these do not. Documents
are read as whole texts, by file name, so the scan never touches a weight file either. Files whose names start with ``_`` or ``.``
are hidden from both, as from every Spark source.

Folders are listed by Spark's tasks, a share of the folders each: by default Spark starts a task for every folder. A listing that is made
once (`listing`) serves the files and the documents; `stored_files` keeps them as tables, read in tasks of thousands of files.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sftlake.session import stored

#: Run folder, checkpoint folder, path of the file below it.
LAYOUT = r"([^/]+)/(checkpoint-[^/]+)/(.+)$"


#: Tasks that list the folders below a folder.
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: What opening a file costs, in bytes read meanwhile.
_FILE_COST = "spark.sql.files.openCostInBytes"


@contextmanager
def _few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Inside, a listing has at most four tasks per core."""
    before = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(_LISTING, before)


@contextmanager
def _many_files_a_task(spark: SparkSession) -> Iterator[None]:
    """Inside, a file counts as its bytes and 32 KB when files are dealt to tasks, not as its bytes and 4 MB: 4,096 small ones are a task."""
    before = spark.conf.get(_FILE_COST)
    spark.conf.set(_FILE_COST, str(32 << 10))
    try:
        yield
    finally:
        spark.conf.set(_FILE_COST, before)


def listing(spark: SparkSession, root: str | Sequence[str]) -> DataFrame:
    """All files below ``root``, listed now: the readers take it in place of ``root``, and list nothing then."""
    with _few_listing_tasks(spark):
        return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)


def stored_files(df: DataFrame, name: str) -> DataFrame:
    """What a reader of this module gives, written now and read back."""
    with _many_files_a_task(df.sparkSession):
        return stored(df, name)


def _placed(path: Column, layout: str) -> list[Column]:
    part = lambda i: F.regexp_extract(path, layout, i)
    return [part(1).alias("run_id"), part(2).alias("checkpoint"), part(3).alias("file")]


def read_checkpoint_files(spark: SparkSession, root: str | Sequence[str] | DataFrame, layout: str = LAYOUT) -> DataFrame:
    """(run_id, checkpoint, file, bytes, mtime) of every file below ``root`` that lies in a checkpoint folder.

    ``layout`` is matched against the path; its three groups are run, checkpoint and file. ``root`` may be a `listing`.
    """
    listed = root if isinstance(root, DataFrame) else listing(spark, root)
    files = listed.select(*_placed(F.col("path"), layout), F.col("length").alias("bytes"), F.col("modificationTime").alias("mtime"))
    return files.where(F.col("checkpoint") != "")


def read_checkpoint_documents(
    spark: SparkSession, root: str | Sequence[str] | DataFrame, names: Sequence[str], layout: str = LAYOUT, inside: str | None = None,
) -> DataFrame:
    """(run_id, checkpoint, file, document) of the files called one of ``names``, as whole texts.

    Where the layout gives files another name on disk, ``inside`` is the glob of those that hold the documents; the filter on
    the file's name uses its path only, so Spark drops other files from the listing before any is opened. ``root`` may be a `listing`: it
    has all files, so ``inside`` is not needed, and bytes are read as they are (files packed with gzip are not unpacked).
    """
    if isinstance(root, DataFrame):
        texts, value = root, F.col("content").cast("string")
    else:
        glob = inside or "{" + ",".join(names) + "}"
        with _few_listing_tasks(spark):
            texts = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(root)
        value = F.col("value")
    # The metadata column holds an encoded URL, in which a plus sign is a plus sign.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    rows = texts.select(*_placed(path, layout), value.alias("document"))
    return rows.where((F.col("checkpoint") != "") & F.col("file").isin(*names))


# -- writing ---------------------------------------------------------------------------

#: Bytes under one checksum, and bytes written at once.
_SUMMED, _AT_ONCE = 512, 1 << 20


#: Spark's name of a null or empty key, and the signs that it escapes in folders' names.
_NO_VALUE, _SIGNS = "__HIVE_DEFAULT_PARTITION__", re.compile(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""")


def _folder(key: str, value: str) -> str:
    return f"{key}={_SIGNS.sub(lambda sign: f'%{ord(sign[0]):02X}', value)}"


def _blocks(lines: Iterable[tuple[str | None, int]]) -> Iterator[bytes]:
    """Each text so many times, and the end of its line, in blocks of bounded size."""
    for text, times in lines:
        unit = (text or "").encode()
        most = max(1, _AT_ONCE // max(1, len(unit)))
        whole, rest = divmod(max(0, times), most)
        for _ in range(whole):
            yield unit * most
        yield unit * rest + b"\n"


def _write_file(folder: str, name: str, attempt: str, lines: Iterable[tuple[str | None, int]]) -> None:
    """A file and its checksums, as Hadoop keeps them; each appears whole, whichever attempt of a task writes it."""
    os.makedirs(folder, exist_ok=True)
    data_at, sums_at = f"{folder}/{name}", f"{folder}/.{name}.crc"
    with open(f"{folder}/.{attempt}", "wb") as data, open(f"{folder}/.{attempt}.crc", "wb") as sums:
        sums.write(b"crc\0" + _SUMMED.to_bytes(4, "big"))
        rest = b""
        for block in _blocks(lines):
            data.write(block)
            view = memoryview(rest + block)
            whole = len(view) - len(view) % _SUMMED
            sums.write(b"".join([zlib.crc32(view[i:i + _SUMMED]).to_bytes(4, "big") for i in range(0, whole, _SUMMED)]))
            rest = bytes(view[whole:])
        if rest:
            sums.write(zlib.crc32(rest).to_bytes(4, "big"))
    os.replace(sums.name, sums_at)
    os.replace(data.name, data_at)


def write_text_files(rows: DataFrame, root: str) -> None:
    """Files below a new folder ``root``, as Spark's text writer makes them, from rows (keys..., value, times): a folder per value of each key, and in
    it a file per task that has rows of it, with a line for each of them, ``value`` so many ``times`` over.

    To make a file or folder on a local disk, Hadoop without its native library starts processes; there the tasks write by themselves.
    """
    spark, keys = rows.sparkSession, rows.columns[:-2]
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    url = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri()
    if url.getScheme() != "file":
        rows.select(*keys, F.repeat("value", F.col("times")).alias("value")).write.partitionBy(*keys).text(root)
        return
    top, job = url.getPath(), uuid.uuid4()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, n = TaskContext.get(), 0
        name, attempt = f"part-{task.partitionId():05d}-{job}.c000.txt", f"{job}-{task.taskAttemptId()}"
        flat = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in [*keys, "value", "times"])))
        for own, lines in groupby(flat, lambda row: row[:-2]):
            _write_file("/".join([top, *map(_folder, keys, own)]), name, attempt, (row[-2:] for row in lines))
            n += 1
        yield pa.RecordBatch.from_pydict({"n": [n]}, pa.schema([("n", pa.int64())]))

    os.makedirs(top)
    named = rows.select(*(F.when(F.col(k) != "", F.col(k)).otherwise(_NO_VALUE).alias(k) for k in keys), "value", "times")
    named.sortWithinPartitions(*keys).mapInArrow(write, "n bigint").agg(F.sum("n")).first()
