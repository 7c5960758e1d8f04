"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from checks.compare import compare, duck
from checks.registry import ORACLES, QUERIES

# The smallest tables hold too few rows for these.
EMPTY_HERE = {"archive_window", "branch_window_scan", "hosted_branches"}

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("key", QUERIES)
def test_query(spark, con, key):
    df = contract.queries()[key](spark, FOLDER)
    assert contract.oracle_sql()[key] == ORACLES[key]
    count, problem = compare(df, con, ORACLES[key])
    assert problem is None
    assert count > 0 or key in EMPTY_HERE


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and df.columns[0] == "sTransNox"
