"""Every registered query against its SQL."""

import os

import pytest

import oracle_check
from vialens.plans.oracles import ORACLES
from vialens.plans.queries import QUERIES

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle_check.connect(SF_DIR)


# An approximate search has no SQL; graph_recall measures it against the exact one.
APPROXIMATE = {"graph_topk"}


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in APPROXIMATE])
def test_query_equals_sql(spark, con, name):
    problem, *_ = oracle_check.compare(spark, con, name, QUERIES[name], ORACLES[name], SF_DIR)
    assert problem is None


def test_every_query_has_sql():
    assert set(QUERIES) - APPROXIMATE == set(ORACLES)


def test_all_are_registered():
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
