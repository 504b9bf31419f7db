"""Time the headline queries and print one JSON line.

Each query runs into Spark's no-op sink, so all rows are computed and none are
collected.  A query's time is that of its second run, building the plan and
writing intermediate tables included; the first run compiles its code.  ``BENCH_SF_DIR``, ``BENCH_CPUS`` and ``BENCH_QUERIES`` (a comma
list) choose the data, the cores and the queries.  ``landing`` and ``building``
are the work that reports and audits find done: the raw feeds and all tables, written once.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from concurrent.futures import ThreadPoolExecutor

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tradewind import schemas  # noqa: E402
from tradewind.plans import registry  # noqa: E402
from tradewind.session import local_session  # noqa: E402

HEADLINE = """
dedup_keep_first surrogate_key silver_orders silver_shipments silver_inventory silver_iot stg_orders stg_shipments
dim_customer dim_product fact_orders fact_orders_dbt fact_shipments fact_inventory fact_deliveries
executive_kpi_summary supplier_scorecard carrier_performance inventory_stockout_risk monthly_revenue_mom
product_revenue_rank summary_kpis dashboard_kpis inventory_watchlist shipment_lead_time stock_heatmap
dq_foreign_key dq_unique dq_report dq_run_rules composite_risk carbon_kg demand_features delay_features
enrich_iot_stream parse_shipment_stream entity_state
""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session("bench", cores)
    queries = registry.queries()
    seconds = {}
    # Before any query: landing the raw feeds, then building and writing all tables.
    began = time.perf_counter()
    with ThreadPoolExecutor(4) as pool:
        feeds = [(feed, strict) for strict in (False, True) for feed in schemas.RAW]
        list(pool.map(lambda one: registry.landed(spark, folder, one[0], strict=one[1]), feeds))
    seconds["landing"] = round(time.perf_counter() - began, 3)
    began = time.perf_counter()
    registry.marts(spark, folder).prefetch(*registry.SILVER_TABLES, *registry.GOLD)
    seconds["building"] = round(time.perf_counter() - began, 3)
    for name in names:
        for _ in range(2):
            began = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - began, 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
