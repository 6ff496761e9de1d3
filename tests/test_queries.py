"""Every registered query against its SQL, on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from catalog.spark_queries import QUERIES
from tests.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, name, SF_DIR) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_entry_without_a_needed_library():
    """The article queries do without the optional part."""
    code = "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; print('names', len(e.queries()), 'pipeline' in e.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=Path(entry.__file__).parent, capture_output=True, text=True, check=True)
    assert out.stdout.split()[-2:] == [str(len(QUERIES)), "False"]
