"""Every query against its SQL, on the smallest tables (SFTLAKE_SF_DIR for others)."""

import os

import pytest

import __spark_entry__ as entry
from check import compare, connect

SF_DIR = os.environ.get("SFTLAKE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_sql(spark, con, name):
    sql = entry.oracle_sql().get(name)
    if sql is None:
        pytest.skip("no SQL: tested against brute force")
    assert compare(spark, con, SF_DIR, entry.queries()[name], sql) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["source", "checked", "kept", "skipped_no_solution", "skipped_length"]
    assert all(r.checked == r.kept + r.skipped_no_solution + r.skipped_length for r in df.collect())
