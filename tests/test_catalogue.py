"""Every registered query against its SQL twin."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
import oracle
from isohour.plans.catalogue import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
SQL = driver.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, name):
    oracle.compare(driver.queries()[name](spark, FOLDER), con, SQL[name])


def test_only_model_queries_lack_sql():
    assert {name for name, query in QUERIES.items() if query.sql is None} == {
        "cross_validated_models",
        "model_recursive_forecast",
    }


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns[:2] == ["observation_date", "city"]
    assert result.count() > 0
