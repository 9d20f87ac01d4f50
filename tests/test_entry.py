"""The entry without what the optional subpackage needs."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
sys.modules[{blocked!r}] = None
import __spark_entry__ as entry
from sftlake.plans import catalog
assert entry.queries().keys() == catalog.QUERIES.keys() and entry.oracle_sql().keys() == catalog.ORACLE.keys()
"""


@pytest.mark.parametrize("blocked", ["ahocorasick", "sftlake.llm", "corpus_pipeline"])
def test_entry_without_an_optional_module(blocked):
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(blocked=blocked)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    assert "left out" in done.stderr


def test_a_fault_of_the_library_itself_is_raised():
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(blocked="sftlake.operators.curate")], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode != 0


def test_temporary_folders_go_when_they_are_left(spark):
    from sftlake.session import shared_dir, stored, temporary_folders

    kept = stored(spark.range(3), "kept")
    with temporary_folders(spark):
        inside = stored(spark.range(5), "inside")
        path = inside.inputFiles()[0]
        empty = shared_dir(spark, "never-written")
        assert inside.count() == 5 and os.path.exists(path.removeprefix("file://").removeprefix("file:")) and "never-written" in empty
    assert not os.path.exists(path.removeprefix("file://").removeprefix("file:")) and kept.count() == 3
