"""Compare queries with their SQL. Usage: python tests/check.py [sf_dir] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def make_spark(cores: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]").appName("sftlake")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is not None, type(v).__name__, v if v is not None else 0) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or (math.isnan(a) and math.isnan(b))
    return type(a) is type(b) and a == b


def compare(spark: SparkSession, con, sf_dir: str, query, sql: str) -> str | None:
    """None when both give the same rows, else what differs. Floats must be bit-equal."""
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*(f"`{c}`" for c in columns)).collect()), key=_key)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != columns:
        return f"columns {columns} against {sorted(names)}"
    at = [names.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in at) for r in cursor.fetchall()), key=_key)
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if not all(map(_same, g, w))]
    return f"{len(bad)} of {len(got)} rows differ, first {bad[0]}"[:900] if bad else None


if __name__ == "__main__":
    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = make_spark(), connect(sf)
    spark.sparkContext.setLogLevel("ERROR")
    sqls = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        began = time.time()
        try:
            problem = compare(spark, con, sf, query, sqls[name]) if name in sqls else f"no SQL: {query(spark, sf).count()} rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {error}"[:1200]
        failed += problem is not None
        print(f"{time.time() - began:6.1f}s {name:32} {problem or 'ok'}", flush=True)
    print("failed:", failed)
