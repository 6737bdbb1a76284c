"""Every registered query against its SQL over the small test tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from oracle_check import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    problem, _ = compare(spark, con, FOLDER, contract.queries()[name], contract.oracle_sql()[name])
    assert not problem


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
@pytest.mark.parametrize("name", ["filter_target", "mae_by_hour", "forecast_vs_seasonal", "forecast_vs_persistence"])
def test_queries_of_one_target_tell_an_operator_that_ignores_it(spark, name, monkeypatch):
    """The smallest tables hold forecasts of one target only."""
    from sunledger.operators import evaluation

    folder = "/root/testdata/sf0.01"
    case = spark, connect(folder), folder, contract.queries()[name], contract.oracle_sql()[name]
    right, n = compare(*case)
    assert not right and n
    monkeypatch.setattr(evaluation, "filter_target", lambda forecasts, target: forecasts)
    assert compare(*case)[0]


def test_sql_belongs_to_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
@pytest.mark.parametrize(
    "name, order",
    [
        ("order_output", ["month", "asset_id"]),
        ("sort_long", ["ts_utc", "gen_type", "asset_id"]),
        ("kpi_monthly_report", ["month", "asset_id"]),
        ("forecast_vs_seasonal", ["ts_utc", "asset_id"]),
        ("forecast_vs_persistence", ["ts_utc", "asset_id"]),
    ],
)
def test_rows_come_in_order(spark, name, order):
    """The comparison above sorts both sides; these queries promise an order."""
    rows = [tuple(r[c] for c in order) for r in contract.queries()[name](spark, "/root/testdata/sf0.01").collect()]
    assert len(rows) > 1 and rows == sorted(rows)
