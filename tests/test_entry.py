"""Every registered query that has SQL agrees with it; the others return rows."""

import pytest
from compare import connect, difference

import __spark_entry__ as contract
from churnlake.catalog import ORACLES, QUERIES

FITTED = sorted(set(QUERIES) - set(ORACLES))
SLOW = {"ml_4_random_forest", "ml_5_gradient_boosting", "evl_8_comparison_report", "snk_5_models_and_report", "ml_7_final_fit"}


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    rows = {r.Contract: r for r in contract.entry(spark).collect()}
    assert set(rows) == {"Month-to-month", "One year", "Two year"}
    assert sum(r.Total for r in rows.values()) == 150


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, con, folder, name):
    assert difference(QUERIES[name](spark, folder), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", [n for n in FITTED if n not in SLOW])
def test_fitted_queries_return_rows(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0
    spark.catalog.clearCache()
