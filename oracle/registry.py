"""DuckDB SQL per registered query."""

from oracle import checks, reports, streams, tables

_TABLES = """
silver_suppliers silver_warehouses silver_products silver_customers silver_orders silver_shipments silver_inventory
silver_iot stg_suppliers stg_products stg_warehouses stg_customers stg_orders stg_shipments stg_inventory dim_date
dim_supplier dim_product dim_warehouse dim_customer dim_region dim_supplier_dbt dim_product_dbt dim_warehouse_dbt
fact_orders fact_orders_dbt temp_breach_counts fact_shipments fact_shipments_dbt fact_inventory fact_deliveries
""".split()


def oracle_sql() -> dict[str, str]:
    return {name: tables.query(f"SELECT * FROM {name}") for name in _TABLES} | reports.SQL | checks.SQL | streams.SQL
