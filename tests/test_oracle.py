"""Every registered query against its oracle SQL, on the smallest tables."""

import pytest
from oracle import connect, differences

from tapmart.queries import ORACLE_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE_SQL.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    assert differences(QUERIES[name](spark, SF_DIR), connection, ORACLE_SQL[name]) == []
