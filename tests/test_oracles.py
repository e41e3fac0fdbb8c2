"""Every query against its SQL on the smallest driver tables."""

from __future__ import annotations

import pytest
from oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from catalogue.oracles import ORACLES
from catalogue.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare(queries()[name](spark, SF), con, oracle_sql()[name]) == []


def test_entry(spark):
    assert entry(spark).count() > 0
