import pytest

import __spark_entry__ as entry
from tests.oracle import connect, differences

SF_DIR = "/root/testdata/sf0.01"
QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


# The training operators are checked against brute force in tests of their own.
OTHERS = set(entry.TRAINING_QUERIES)


def test_every_query_has_an_oracle():
    assert set(ORACLES) - OTHERS == set(QUERIES) - OTHERS


@pytest.mark.parametrize("name", sorted(set(QUERIES) - OTHERS))
def test_matches_oracle(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
