"""Session helpers."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


_MADE: list[str] = []


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder path for ``name`` that every executor can reach.

    It lies under ``spark.checkpoint.dir``, or, where that is unset, under the warehouse,
    which all executors share too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    _MADE.append(f"{root.rstrip('/')}/sftlake/{name}-{uuid.uuid4().hex}")
    return _MADE[-1]


@contextmanager
def temporary_folders(spark: SparkSession) -> Iterator[None]:
    """Removes the shared folders that are made inside when it is left: write the results there, elsewhere, first.

    Operators keep what they store, since a frame that they return may read it at any time; this says when that time is over.
    """
    before = len(_MADE)
    try:
        yield
    finally:
        made = _MADE[before:]
        del _MADE[before:]
        for folder in made:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written into a new shared folder and read back: computed once, and its lineage ends in files."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
