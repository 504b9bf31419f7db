"""Reports, KPIs and feeds in DuckDB SQL."""

from oracle.tables import query


def pct(part: str, whole: str) -> str:
    """Two digits, half away from zero, on integers."""
    return f"CAST(((({part}) * 20000 + ({whole})) // (nullif({whole}, 0) * 2)) / 100 AS DECIMAL(12,2))"


def mean(total: str, rows: str, digits: int) -> str:
    scale = 10**digits
    return (
        f"CAST(coalesce(((CAST({total} AS BIGINT) * {2 * scale} + ({rows})) // (nullif({rows}, 0) * 2)) / {scale}, 0) "
        f"AS DECIMAL(20,{digits}))"
    )


REPORTS = {
    "executive_kpi_summary": f"""
    SELECT total_orders, total_revenue_usd, {pct('delivered', 'total_orders')} AS order_fulfillment_rate_pct,
           total_shipments, delayed_shipments, {pct('delayed_shipments', 'total_shipments')} AS shipment_delay_rate_pct,
           {pct('on_time', 'total_shipments')} AS on_time_delivery_rate_pct,
           {mean('hours', 'timed', 1)} AS avg_shipment_delay_hours, total_temp_breaches, total_monitored_skus,
           stockout_risk_items, total_inventory_value_usd
    FROM (SELECT count(DISTINCT order_id) AS total_orders,
                 CAST(coalesce(sum(total_amount_usd), 0) AS DECIMAL(20,2)) AS total_revenue_usd,
                 count(*) FILTER (order_status = 'DELIVERED') AS delivered FROM fact_orders),
         (SELECT count(DISTINCT shipment_id) AS total_shipments,
                 count(*) FILTER (is_delayed OR shipment_status = 'DELAYED') AS delayed_shipments,
                 count(*) FILTER (shipment_status = 'DELIVERED' AND NOT is_delayed) AS on_time,
                 sum(delay_hours) AS hours, count(delay_hours) AS timed,
                 CAST(coalesce(sum(temp_breach_count), 0) AS BIGINT) AS total_temp_breaches FROM fact_shipments),
         (SELECT count(DISTINCT inventory_id) AS total_monitored_skus,
                 count(*) FILTER (is_low_stock OR quantity_on_hand <= safety_stock) AS stockout_risk_items,
                 CAST(coalesce(sum(inventory_value_usd), 0) AS DECIMAL(20,2)) AS total_inventory_value_usd FROM fact_inventory)""",
    "supplier_scorecard": f"""
    SELECT supplier_id, any_value(supplier_name) AS supplier_name, any_value(country) AS supplier_country,
           any_value(tier) AS supplier_tier, any_value(rating) AS supplier_base_rating,
           count(DISTINCT order_id) AS total_orders_fulfilled,
           CAST(coalesce(sum(total_amount_usd), 0) AS DECIMAL(20,2)) AS total_procurement_spend_usd,
           count(*) FILTER (order_status = 'DELIVERED') AS delivered_orders,
           {pct("count(*) FILTER (order_status = 'DELIVERED')", 'count(DISTINCT order_id)')} AS supplier_otif_pct,
           CASE WHEN any_value(rating) >= 4.5 THEN 'Tier 1 Preferred' WHEN any_value(rating) >= 3.8 THEN 'Standard Vendor'
                ELSE 'Under Watch / Risk' END AS vendor_risk_category
    FROM dim_supplier LEFT JOIN fact_orders USING (supplier_key) GROUP BY supplier_id""",
    "carrier_performance": f"""
    SELECT carrier, transit_mode, count(shipment_id) AS total_shipments_handled,
           count(*) FILTER (is_delayed) AS total_delayed_shipments, {mean('sum(delay_hours)', 'count(delay_hours)', 1)} AS avg_delay_hours,
           {pct('count(shipment_id) - count(*) FILTER (is_delayed)', 'count(shipment_id)')} AS carrier_on_time_pct,
           CAST(sum(temp_breach_count) AS BIGINT) AS total_cold_chain_breaches
    FROM fact_shipments GROUP BY carrier, transit_mode""",
    "inventory_stockout_risk": """
    SELECT warehouse_code, warehouse_name, city AS warehouse_city, sku, product_name, category AS product_category,
           quantity_on_hand, safety_stock, reorder_level, inventory_value_usd,
           CASE WHEN quantity_on_hand * 2 <= safety_stock THEN 'CRITICAL STOCKOUT'
                WHEN quantity_on_hand <= safety_stock THEN 'HIGH RISK'
                WHEN quantity_on_hand <= reorder_level THEN 'REORDER REQUIRED' ELSE 'HEALTHY' END AS stock_status
    FROM fact_inventory JOIN dim_warehouse_dbt USING (warehouse_key) JOIN dim_product_dbt USING (product_key)
    WHERE is_low_stock OR quantity_on_hand <= reorder_level""",
    "monthly_revenue_mom": """
    SELECT year, month, month_name, monthly_order_count, monthly_revenue_usd,
           CAST(round(CAST(monthly_revenue_usd AS DECIMAL(38,10)) / priced, 6) AS DECIMAL(20,6)) AS avg_order_value_usd,
           prev_month_revenue_usd,
           CAST(round((monthly_revenue_usd - prev_month_revenue_usd) * 100.0 / nullif(prev_month_revenue_usd, 0), 2)
                AS DECIMAL(20,2)) AS mom_revenue_growth_pct
    FROM (SELECT *, lag(monthly_revenue_usd) OVER (ORDER BY year, month) AS prev_month_revenue_usd
          FROM (SELECT year, month, month_name, count(DISTINCT order_id) AS monthly_order_count,
                       CAST(sum(total_amount_usd) AS DECIMAL(20,2)) AS monthly_revenue_usd, count(total_amount_usd) AS priced
                FROM fact_orders JOIN dim_date ON order_date_key = date_key GROUP BY year, month, month_name))""",
    "product_revenue_rank": """
    SELECT *, CAST(dense_rank() OVER (PARTITION BY category ORDER BY gross_revenue_usd DESC) AS INTEGER) AS category_revenue_rank
    FROM (SELECT sku, product_name, category, CAST(sum(quantity) AS BIGINT) AS total_units_sold,
                 CAST(sum(total_amount_usd) AS DECIMAL(20,2)) AS gross_revenue_usd
          FROM fact_orders JOIN dim_product USING (product_key) GROUP BY sku, product_name, category)""",
    "summary_kpis": """
    SELECT total_orders, round_even(delivered / total_orders * 100.0, 1) AS fulfillment_rate_pct, total_shipments,
           delayed_shipments, on_time_shipments, round_even(delayed_shipments / total_shipments * 100.0, 1) AS delay_pct,
           stockout_risk_items, active_suppliers, avg_supplier_rating
    FROM (SELECT count(*) AS total_orders, count(*) FILTER (status = 'DELIVERED') AS delivered FROM silver_orders),
         (SELECT count(*) AS total_shipments, count(*) FILTER (status = 'DELAYED') AS delayed_shipments,
                 count(*) FILTER (status = 'DELIVERED') AS on_time_shipments FROM silver_shipments),
         (SELECT count(*) FILTER (quantity_on_hand <= safety_stock) AS stockout_risk_items FROM silver_inventory),
         (SELECT count(*) AS active_suppliers, CAST(round_even(avg(rating), 2) AS DECIMAL(5,2)) AS avg_supplier_rating
          FROM silver_suppliers)""",
    "summary_kpis_fallback": """
    SELECT total_orders, round_even(delivered / total_orders * 100.0, 1) AS fulfillment_rate_pct, total_shipments,
           delayed_shipments, on_time_shipments, round_even(delayed_shipments / total_shipments * 100.0, 1) AS delay_pct,
           stockout_risk_items, active_suppliers, avg_supplier_rating
    FROM (SELECT count(*) AS total_orders, count(*) FILTER (status = 'DELIVERED') AS delivered FROM raw_orders),
         (SELECT count(*) AS total_shipments, count(*) FILTER (status = 'DELAYED') AS delayed_shipments,
                 count(*) FILTER (status = 'DELIVERED') AS on_time_shipments FROM silver_shipments),
         (SELECT count(*) FILTER (coalesce(TRY_CAST(quantity_on_hand AS DECIMAL(28,8)), 0) <= coalesce(TRY_CAST(safety_stock AS DECIMAL(28,8)), 0))
                 AS stockout_risk_items FROM raw_inventory),
         (SELECT count(*) AS active_suppliers, CAST(round_even(avg(rating), 2) AS DECIMAL(5,2)) AS avg_supplier_rating
          FROM silver_suppliers)""",
    # The sketches' own numbers no SQL can tell: exact counts, and that the estimates lie within their bounds.
    "distinct_products": """SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, count(DISTINCT product_id) AS distinct_exact, TRUE AS sound
        FROM silver_orders WHERE order_date IS NOT NULL GROUP BY 1""",
    "lead_time_quantiles": """SELECT carrier, mode, quantile, count(*) AS delivered, TRUE AS sound
        FROM silver_shipments, (VALUES (0.5::DOUBLE), (0.9::DOUBLE), (0.99::DOUBLE)) AS q(quantile)
        WHERE shipped_at IS NOT NULL AND actual_delivery_at IS NOT NULL GROUP BY ALL""",
    "dashboard_kpis": """
    SELECT * FROM (SELECT count(*) AS total_orders, CAST(sum(total_amount_usd) AS DECIMAL(20,2)) AS total_revenue_usd FROM silver_orders),
         (SELECT count(*) FILTER (status = 'IN_TRANSIT') AS active_transit_shipments,
                 count(*) FILTER (is_delayed) AS delayed_shipments FROM silver_shipments),
         (SELECT count(*) FILTER (is_low_stock) AS low_stock_items FROM silver_inventory),
         (SELECT count(*) FILTER (is_temp_breach) AS temp_breaches FROM silver_iot),
         (SELECT CAST(round_even(avg(rating), 2) AS DECIMAL(5,2)) AS avg_supplier_rating FROM silver_suppliers)""",
    "active_shipment_map": """
    SELECT shipment_id, carrier, mode, status, destination_city, destination_country, name AS origin_wh,
           latitude AS origin_lat, longitude AS origin_lon
    FROM silver_shipments LEFT JOIN silver_warehouses ON origin_warehouse_id = warehouse_id
    WHERE status IN ('IN_TRANSIT', 'DELAYED') ORDER BY shipment_id LIMIT 40""",
    "warehouse_nodes": "SELECT * FROM silver_warehouses WHERE latitude <> 0 AND longitude <> 0",
    "latest_telemetry": "SELECT * FROM silver_iot ORDER BY recorded_at DESC NULLS FIRST, event_id LIMIT 100",
    "inventory_watchlist": """
    SELECT inventory_id, w.name AS warehouse_name, p.name AS product_name, category, quantity_on_hand, reorder_level, is_low_stock
    FROM silver_inventory i JOIN silver_warehouses w ON i.warehouse_id = w.warehouse_id
    JOIN silver_products p ON i.product_id = p.product_id
    ORDER BY is_low_stock DESC, quantity_on_hand, inventory_id LIMIT 50""",
    "warehouse_utilization": """
    SELECT warehouse_id, name, capacity_sqft, units_on_hand,
           CAST(round(CAST(units_on_hand AS DECIMAL(18,0)) / capacity_sqft, 6) AS DECIMAL(18,6)) AS units_per_sqft
    FROM silver_warehouses LEFT JOIN
         (SELECT warehouse_id, CAST(sum(quantity_on_hand) AS BIGINT) AS units FROM silver_inventory GROUP BY 1) USING (warehouse_id),
         LATERAL (SELECT coalesce(units, 0) AS units_on_hand)""",
    "shipment_lead_time": """
    SELECT carrier, mode AS transit_mode, count(*) AS delivered_shipments, round(min(us) / 3.6e9, 4) AS min_lead_hours,
           quantile_cont(us // 3600000000, 0.5) AS median_lead_hours, round(max(us) / 3.6e9, 4) AS max_lead_hours,
           round(CAST(sum(us) AS DOUBLE) / count(*) / 3.6e9, 4) AS avg_lead_hours
    FROM (SELECT *, epoch_us(actual_delivery_at) - epoch_us(shipped_at) AS us FROM silver_shipments)
    WHERE us IS NOT NULL GROUP BY carrier, mode""",
    "stock_heatmap": """
    SELECT warehouse_id, category, CAST(sum(quantity_on_hand) AS BIGINT) AS units
    FROM silver_inventory JOIN (SELECT product_id, category FROM silver_products) USING (product_id)
    GROUP BY warehouse_id, category""",
}

SQL = {name: query(body) for name, body in REPORTS.items()}
