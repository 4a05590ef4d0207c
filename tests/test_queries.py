"""Every registered query against its SQL on the smallest tables."""

import os
import subprocess
import sys

import pytest

from compare import differences, duck
from millrace.plans import CHECKS, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, con, key):
    assert differences(spark, FOLDER, con, QUERIES[key], CHECKS.get(key)) is None


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["c_mktsegment", "o_orderpriority", "o_orderstatus", "sum_order_total"]


def test_entry_without_a_corpus_library():
    """A library that only the corpus operators need is missing: the core stays, and the operators' own import error is not hidden."""
    code = (
        "import sys; sys.modules['xxhash'] = None; import __spark_entry__ as e; "
        "assert 'segment_order_totals' in e.queries() and not any(k.startswith('op') and k[2:3].isdigit() for k in e.queries())"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, capture_output=True)
