"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle.registry import oracle_sql
from tests.support import connect, difference
from tradewind.plans.registry import queries

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = queries(), oracle_sql()
WITHOUT_SQL = {"demand_forecast", "delay_prediction"}


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_only_fitted_models_have_no_sql():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    assert difference(QUERIES[name](spark, FOLDER), duck, SQL[name]) is None


def test_entry_registers_them_all():
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() == 10
    assert "vendor_risk_category" in frame.columns


def test_demand_forecast_covers_every_product_sold(spark):
    forecast = QUERIES["demand_forecast"](spark, FOLDER)
    sold = QUERIES["upcoming_demand"](spark, FOLDER)
    assert forecast.count() == sold.count() == forecast.select("product_id").distinct().count()
    assert forecast.filter("next_7_days_demand < 0 OR forecast_confidence_pct NOT BETWEEN 0 AND 100").isEmpty()


def test_delay_prediction_scores_every_shipment(spark):
    predicted = QUERIES["delay_prediction"](spark, FOLDER)
    assert predicted.count() == QUERIES["silver_shipments"](spark, FOLDER).count()
    assert predicted.filter("delay_probability_pct NOT BETWEEN 0 AND 100 OR risk_level IS NULL").isEmpty()
