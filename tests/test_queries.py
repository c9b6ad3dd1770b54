"""Every registered query, against its SQL counterpart where it has one."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract
from oracle import connect, differences

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def tables(sf_dir):
    return connect(sf_dir)


def test_every_counterpart_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() == 3


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, tables):
    actual = QUERIES[name](spark, sf_dir).toArrow()
    if name in ORACLES:
        expected = tables.sql(ORACLES[name]).to_arrow_table()
        assert differences(actual, expected) == []
    else:
        assert actual.num_rows > 0
