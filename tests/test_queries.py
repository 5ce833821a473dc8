"""Every registered query against its DuckDB check on the smallest tables."""

import warnings

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle import compare, connect
from workload.catalog import QUERIES
from workload.oracles import ORACLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert compare(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) == []
