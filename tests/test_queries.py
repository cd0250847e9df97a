"""Every registered query against its SQL answer on the sample tables."""

from __future__ import annotations

import os

import pytest
from compare import connect, differences

import __spark_entry__ as contract
from spendlens.plans.catalog import CATALOG

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_an_answer():
    assert set(CATALOG) <= set(ORACLE) and set(CATALOG) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_matches_sql(spark, duck, name):
    missing, extra, problem = differences(duck, contract.queries()[name](spark, SF_DIR), ORACLE[name])
    assert problem is None
    assert not missing and not extra


def test_entry(spark):
    result = contract.entry(spark)
    assert "zScore" in result.columns and result.count() > 0
