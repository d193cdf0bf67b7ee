"""Every registered query runs; those with SQL agree with it exactly, value for value."""

import pytest

from __spark_entry__ import entry
from cardmill.plans.oracle import ORACLE
from cardmill.plans.queries import QUERIES
from compare import database, difference
from conftest import SF_SMALL

# No SQL: the ranking of a learned model. Its inputs have one, m6_permuted.
ROWS_ONLY = {"m6_importance"}
# Each trains a hundred trees; test_training covers the operators.
SLOW = {"m2_train_report", "m6_importance", "o3_flow"}


@pytest.fixture(scope="module")
def con():
    return database(SF_SMALL)


def test_names():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    if name in ROWS_ONLY:
        assert df.count() > 0
    else:
        assert difference(df, con, ORACLE[name]) is None
