"""Every query against its SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, queries
from check import compare, duck
from workload.registry import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    verdict = compare(spark, con, SF, QUERIES[name], ORACLES.get(name))
    assert verdict.startswith(("ok", "rows")), verdict


def test_entry(spark):
    assert entry(spark).count() == 30
