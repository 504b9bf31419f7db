"""Cleansed, staged and star-schema tables on hand-made feeds."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tradewind import schemas
from tradewind.operators import gold, kpis, reports, silver, staging
from tradewind.plans import registry

LOADED = dt.datetime(2026, 8, 13)


@pytest.fixture
def feed(spark):
    def build(table, *records):
        names = schemas.RAW_COLUMNS[table]
        data = [(*r, *[None] * (len(names) - len(r)), None, None, LOADED) for r in records]
        return spark.createDataFrame(data, schemas.RAW[table])

    return build


def test_suppliers_default_rating_and_active(feed):
    raw = feed("raw_suppliers", ("S1", "A", "a@x", "US", "NA", "Tier 1", "4.9"), ("S2", "B", None, None, None, None, "n/a"))
    got = {r.supplier_id: (r.rating, r.is_active) for r in silver.silver_suppliers(raw).collect()}
    assert got == {"S1": (Decimal("4.90"), True), "S2": (Decimal("4.00"), True)}


def test_products_strip_currency_signs(feed):
    raw = feed("raw_products", ("P1", "ELEC-1", "Board", "Electronics", "$1,250.00", "USD", None, "S1"))
    row = silver.silver_products(raw).first()
    assert (row.unit_cost_usd, row.weight_kg) == (Decimal("1250.00"), Decimal("1.00"))


def test_strict_money_stops_and_lenient_keeps_the_row(feed):
    raw = feed("raw_products", ("P1", "E", "B", "C", "EUR 100", "EUR", "2", "S1"))
    with pytest.raises(PySparkException):
        silver.silver_products(raw).collect()
    assert silver.silver_products(raw, strict=False).first().unit_cost_usd is None


def test_orders(feed):
    raw = feed(
        "raw_orders",
        ("O1", "C1", "P1", "S1", "120", "$350.00", None, "2026-03-01T10:00:00", "bad", "DELIVERED"),
        ("O2", "C1", "P1", "S1", "many", "$2.50", "EUR", None, None, "DELAYED"),
    )
    got = {r.order_id: r for r in silver.silver_orders(raw).collect()}
    assert (got["O1"].quantity, got["O1"].total_amount_usd, got["O1"].original_currency) == (120, Decimal("42000.00"), "USD")
    assert (got["O1"].order_date, got["O1"].required_date) == (dt.datetime(2026, 3, 1, 10), None)
    assert (got["O2"].quantity, got["O2"].total_amount_usd, got["O2"].original_currency) == (1, Decimal("2.50"), "EUR")


def shipment(sid, actual, status="DELIVERED"):
    return (sid, "O1", "W1", "Oslo", "NO", "C", "Sea Freight", status, "2026-01-01T00:00:00", "2026-01-05T00:00:00", actual)


@pytest.fixture
def shipments(feed):
    return feed(
        "raw_shipments",
        shipment("early", "2026-01-04T00:00:00"),
        shipment("exact", "2026-01-05T00:00:00"),
        shipment("minutes", "2026-01-05T00:40:00"),
        shipment("hours", "2026-01-05T05:59:59"),
        shipment("open", None, "DELAYED"),
    )


def test_forty_minutes_late_is_not_delayed_after_cleansing(shipments):
    got = {r.shipment_id: (r.delay_hours, r.is_delayed) for r in silver.silver_shipments(shipments).collect()}
    assert got == {"early": (0, False), "exact": (0, False), "minutes": (0, False), "hours": (5, True), "open": (0, False)}


def test_forty_minutes_late_is_delayed_in_the_staged_fact(shipments, feed):
    places = gold.dim_warehouse(staging.stg_warehouses(feed("raw_warehouses", ("W1", " lax ", " Hub ", "LA", "US", "1.5", "2.5", "10", "Ambient"))))
    got = {r.shipment_id: (round(r.delay_hours, 3), r.is_delayed) for r in gold.fact_shipments_dbt(staging.stg_shipments(shipments), places).collect()}
    assert got["minutes"] == (0.667, True)
    assert got["exact"] == got["open"] == (0.0, False)
    assert places.first().warehouse_code == "LAX"


def inventory_row(n, quantity):
    return (f"I{n}", "W1", "P1", quantity, "296", "124", "2026-08-01")


def test_low_stock_by_either_level(feed):
    raw = feed("raw_inventory", inventory_row(1, "183"), inventory_row(2, "124"), inventory_row(3, "297"), inventory_row(4, "bad"))
    by_reorder = {r.inventory_id: r.is_low_stock for r in silver.silver_inventory(raw).collect()}
    by_safety = {r.inventory_id: r.is_low_stock for r in silver.silver_inventory(raw, low_stock_level="safety_stock").collect()}
    assert by_reorder == {"I1": True, "I2": True, "I3": False, "I4": True}
    assert by_safety == {"I1": False, "I2": True, "I3": False, "I4": True}
    with pytest.raises(ValueError):
        silver.silver_inventory(raw, low_stock_level="other")
    with pytest.raises(PySparkException):
        staging.stg_inventory(raw).collect()


def test_iot_breach_is_judged_before_rounding(feed):
    readings = [("E1", "8.0"), ("E2", "8.004"), ("E3", "8.01"), ("E4", None), ("E5", "ERR")]
    raw = feed("raw_iot_sensors", *[(e, "S", "D", "1", "2", t, "50", None, "2026-01-01T00:00:00") for e, t in readings])
    got = {r.event_id: (r.is_temp_breach, r.battery_level) for r in silver.silver_iot(raw).collect()}
    assert got == {"E1": (False, 100), "E2": (True, 100), "E3": (True, 100), "E4": (False, 100), "E5": (False, 100)}


def test_dim_date_defaults_to_2026(spark):
    days = gold.dim_date(spark).orderBy("date_key").collect()
    assert len(days) == 365
    assert days[0].asDict() == {
        "date_key": 20260101,
        "full_date": dt.date(2026, 1, 1),
        "year": 2026,
        "quarter": 1,
        "month": 1,
        "month_name": "January",
        "day_of_month": 1,
        "day_of_week": 4,
        "day_name": "Thursday",
        "is_weekend": False,
    }
    assert sum(d.is_weekend for d in days) == 104


def test_dim_date_covering_nothing_is_empty(rows):
    assert gold.dim_date_covering((rows("at timestamp", [(None,)]), ["at"])).count() == 0


def test_dim_date_covers_all_columns_and_the_missing_date(rows):
    one = rows("a timestamp, b timestamp", [(dt.datetime(2026, 1, 5), None), (None, dt.datetime(2026, 1, 3, 23))])
    two = rows("c timestamp", [(dt.datetime(2026, 1, 6, 1),)])
    days = gold.dim_date_covering((one, ["a", "b"]), (two, ["c"]), missing_date_key=20260101)
    assert sorted(d.date_key for d in days.collect()) == [20260101, 20260103, 20260104, 20260105, 20260106]


def test_every_date_key_has_its_day_and_months_add_up(spark):
    m = registry.medallion(spark, "/root/testdata/sf0.001")
    days = m.dim_date.select(F.col("date_key").alias("key"))
    keys = m.fact_orders.select(F.col("order_date_key").alias("key"))
    keys = keys.union(m.fact_shipments.select("shipped_date_key")).union(m.fact_shipments.select("delivery_date_key"))
    keys = keys.union(m.fact_deliveries.select("delivery_date_key")).union(m.fact_inventory.select("snapshot_date_key"))
    assert keys.filter("key IS NOT NULL").join(days, "key", "left_anti").isEmpty()
    months = reports.monthly_revenue_mom(m.fact_orders, m.dim_date, unique_ids=True)
    assert months.agg(F.sum("monthly_revenue_usd")).first() == m.fact_orders.agg(F.sum("total_amount_usd")).first()


def test_readable_numbers_beyond_the_declared_range_stay(feed):
    raw = feed("raw_suppliers", ("S1", "A", "a@b", "US", "R", "T", "12.5"))
    assert silver.silver_suppliers(raw).first().rating == Decimal("12.50")


def test_a_new_category_keeps_its_stock(rows):
    stock = rows("product_id string, warehouse_id string, quantity_on_hand bigint", [("P1", "W", 5), ("P2", "W", 7)])
    products = rows("product_id string, category string", [("P1", "SMALL"), ("P2", "NEWCAT")])
    assert {(r.category, r.units) for r in kpis.stock_heatmap(stock, products).collect()} == {("SMALL", 5), ("NEWCAT", 7)}


@pytest.fixture
def star(rows):
    dims = {
        "suppliers": rows("supplier_key bigint, supplier_id string, supplier_name string, country string, tier string, rating decimal(3,2)",
                          [(1, "S1", "A", "US", "T1", Decimal("4.50")), (2, "S2", "B", "DE", "T2", Decimal("3.80")), (3, "S3", "C", "FR", "T2", Decimal("3.79"))]),
        "products": rows("product_key bigint, product_id string, sku string, product_name string, category string",
                         [(1, "P1", "K1", "x", "c"), (2, "P2", "K2", "y", "c"), (3, "P3", "K3", "z", "d")]),
        "customers": rows("customer_key bigint, customer_id string", [(1, "C1"), (2, None)]),
    }
    orders = rows(
        "order_id string, customer_id string, product_id string, supplier_id string, quantity int, unit_price_usd decimal(12,2), total_amount_usd decimal(14,2), order_date timestamp, status string",
        [("O1", "C1", "P1", "S1", 1, Decimal(10), Decimal(10), dt.datetime(2026, 1, 5), "DELIVERED"),
         ("O2", None, "P2", "S1", 2, Decimal(5), Decimal(10), dt.datetime(2026, 2, 5), "DELAYED"),
         ("O3", "C9", "P3", "S2", 3, Decimal(10), Decimal(30), None, "DELIVERED")],
    )
    return dims, orders


def test_fact_orders_keeps_every_order(star):
    dims, orders = star
    fact = gold.fact_orders(orders, dims["suppliers"], dims["products"], dims["customers"])
    got = {r.order_id: (r.customer_key, r.supplier_key, r.order_date_key) for r in fact.collect()}
    assert got == {"O1": (1, 1, 20260105), "O2": (None, 1, 20260205), "O3": (None, 2, 20260101)}
    other = gold.fact_orders(orders, dims["suppliers"], dims["products"], dims["customers"], missing_date_key=None, match_null_keys=True)
    got = {r.order_id: (r.customer_key, r.order_date_key) for r in other.collect()}
    assert got == {"O1": (1, 20260105), "O2": (2, 20260205), "O3": (None, None)}


def test_scorecard_has_suppliers_without_orders(star):
    dims, orders = star
    fact = gold.fact_orders(orders, dims["suppliers"], dims["products"], dims["customers"])
    got = {r.supplier_id: r for r in reports.supplier_scorecard(dims["suppliers"], fact).collect()}
    assert (got["S1"].total_orders_fulfilled, got["S1"].supplier_otif_pct, got["S1"].vendor_risk_category) == (2, Decimal("50.00"), "Tier 1 Preferred")
    assert (got["S2"].total_procurement_spend_usd, got["S2"].vendor_risk_category) == (Decimal("30.00"), "Standard Vendor")
    assert (got["S3"].total_orders_fulfilled, got["S3"].supplier_otif_pct, got["S3"].vendor_risk_category) == (0, None, "Under Watch / Risk")


def test_monthly_growth_newest_first(star, spark):
    dims, orders = star
    fact = gold.fact_orders(orders, dims["suppliers"], dims["products"], dims["customers"])
    got = reports.monthly_revenue_mom(fact, gold.dim_date(spark)).collect()
    assert [(r.month, r.monthly_revenue_usd, r.prev_month_revenue_usd, r.mom_revenue_growth_pct) for r in got] == [
        (2, Decimal("10.00"), Decimal("40.00"), Decimal("-75.00")),
        (1, Decimal("40.00"), None, None),
    ]


def test_product_ranks_share_ties(star):
    dims, orders = star
    fact = gold.fact_orders(orders, dims["suppliers"], dims["products"], dims["customers"])
    got = {r.sku: r.category_revenue_rank for r in reports.product_revenue_rank(fact, dims["products"]).collect()}
    assert got == {"K1": 1, "K2": 1, "K3": 1}


def test_distinct_counts_without_the_uniqueness_promise(star):
    dims, orders = star
    fact = gold.fact_orders(orders.union(orders), dims["suppliers"], dims["products"], dims["customers"])
    got = {r.supplier_id: r.total_orders_fulfilled for r in reports.supplier_scorecard(dims["suppliers"], fact).collect()}
    assert got == {"S1": 2, "S2": 1, "S3": 0}


def test_stock_status_bounds(rows):
    frame = rows("n int, q int", [(0, 25), (1, 26), (2, 50), (3, 51), (4, 100), (5, 101)]).orderBy("n")
    got = [r[0] for r in frame.select(reports.stock_status(F.col("q"), F.lit(50), F.lit(100))).collect()]
    assert got == ["CRITICAL STOCKOUT", "HIGH RISK", "HIGH RISK", "REORDER REQUIRED", "REORDER REQUIRED", "HEALTHY"]


def test_stockout_rules_differ(rows):
    frame = rows("is_low_stock boolean, quantity_on_hand int, safety_stock int", [(True, 80, 50), (False, 40, 50), (True, 10, 50)])
    counts = {rule: frame.agg(F.count_if(reports.stockout_risk(rule))).first()[0] for rule in reports.STOCKOUT_RULES}
    assert counts == {"low_or_safety": 3, "low": 2, "safety": 2}


def test_executive_summary_of_empty_facts(rows):
    orders = rows("order_id string, total_amount_usd decimal(14,2), order_status string", [])
    shipments = rows("shipment_id string, is_delayed boolean, shipment_status string, delay_hours int, temp_breach_count int", [])
    stock = rows("inventory_id string, is_low_stock boolean, quantity_on_hand int, safety_stock int, inventory_value_usd decimal(14,2)", [])
    row = reports.executive_kpi_summary(orders, shipments, stock, refreshed_at=F.current_timestamp()).first()
    assert (row.total_orders, row.total_revenue_usd, row.order_fulfillment_rate_pct, row.avg_shipment_delay_hours) == (0, 0, None, 0)
    assert row.last_refreshed_at is not None


def test_kpis_of_empty_tables_are_zero_and_read_raw_text(feed):
    empty = [feed(t) for t in ("raw_orders", "raw_shipments", "raw_inventory", "raw_suppliers")]
    assert set(kpis.summary_kpis(*empty).first().asDict().values()) == {0}
    raw = feed("raw_inventory", inventory_row(1, "100"), inventory_row(2, "x"), inventory_row(3, "125"))
    row = kpis.summary_kpis(empty[0], empty[1], kpis.cleansed_or_raw(raw.limit(0), raw), empty[3]).first()
    assert row.stockout_risk_items == 2


def test_warehouse_nodes_need_both_coordinates(rows):
    frame = rows("id string, latitude double, longitude double", [("a", 1.0, 2.0), ("b", None, 2.0), ("c", 0.0, 2.0)])
    assert [r.id for r in kpis.warehouse_nodes(frame).collect()] == ["a"]
