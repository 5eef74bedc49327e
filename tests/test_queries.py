"""Every registered query against its SQL counterpart."""

import pytest

from __spark_entry__ import entry
from barloom.plans.oracle import ORACLE
from barloom.plans.queries import QUERIES
from tools.compare import compare, oracle_connection


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle_connection(sf_dir)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees(spark, con, sf_dir, name):
    same, note = compare(spark, con, name, sf_dir)
    assert same, note


def test_entry(spark, sf_dir):
    df = entry(spark)
    assert df.columns[0] == "ticker"
    assert df.count() > 0
