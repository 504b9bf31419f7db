"""What a query moves and holds must not outgrow its input."""

import subprocess
import sys
import threading

from pyspark.sql import functions as F

from tradewind import schemas
from tradewind.operators import quality
from tradewind.plans import registered_kernels, registry
from tradewind.plans.medallion import Medallion
from tradewind.sources import files
from tradewind.sources.driver_tables import DriverTables, order_lines, raw_inventory
from tradewind.streaming import jobs

FOLDER = "/root/testdata/sf0.001"

_LARGE_BATCH = """
from pyspark.sql import SparkSession, functions as F
from tradewind.session import configure
from tradewind.streaming import jobs
import tempfile
b = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.driver.maxResultSize", "1m")
spark = configure(b.getOrCreate())
top = tempfile.mkdtemp(prefix="run-", dir="/tmp")
spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("text")).write.parquet(top + "/rows")
stream = spark.readStream.schema("text string").parquet(top + "/rows").observe("seen", F.count(F.lit(1)).alias("rows"))
query = jobs.console_sink(stream).option("checkpointLocation", top + "/cp").trigger(availableNow=True).start()
query.awaitTermination()
print("counted", sum(p["observedMetrics"]["seen"]["rows"] for p in query.recentProgress if p["observedMetrics"]))
"""


def test_the_console_takes_few_rows_of_a_batch():
    """13 MB pass, of which the driver may be sent one; every row is counted, once."""
    done = subprocess.run([sys.executable, "-c", _LARGE_BATCH], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "counted 200000" in done.stdout
    assert "Batch: 0" in done.stdout and done.stdout.count("|") == 2 * 21


def test_console_rows_are_the_first_of_the_batch(spark, rows, tmp_path, capsys):
    rows("n int", [(n,) for n in range(9)]).coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("n int").parquet(f"{tmp_path}/in")
    query = jobs.console_sink(stream, rows=2).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    shown = capsys.readouterr().out
    assert [line for line in shown.splitlines() if line.startswith("|")] == ["|n  |", "|0  |", "|1  |"]


def test_order_lines_move_once_and_only_what_feeds_take(spark):
    joined = order_lines(DriverTables(spark, FOLDER))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2  # lines and orders, to their join
    assert not {"l_tax", "l_returnflag", "l_linestatus", "o_totalprice", "o_orderpriority"} & set(joined.columns)


def test_shuffles_start_with_many_partitions(spark):
    """Few partitions set for the session must not make a task sort more than it can hold."""
    orders = registry.medallion(spark, FOLDER).orders
    assert "hashpartitioning(order_id" in (plan := orders._jdf.queryExecution().executedPlan().toString())
    assert ", 256)" in plan.split("hashpartitioning(order_id")[1].split("\n")[0]


def test_a_task_reads_few_files_and_writes_small_ones(spark, tmp_path):
    """Two files of 7 MB in one task were sorted with spills once they held much text."""
    hashes = spark.range(0, 8 * 850_000, 1, 8).select(F.xxhash64("id").alias("l_orderkey"))
    hashes.write.parquet(f"{tmp_path}/lineitem.parquet")
    assert DriverTables(spark, str(tmp_path))["lineitem"].select("l_orderkey").rdd.getNumPartitions() == 8
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def test_array_files_grow_with_the_rows():
    assert files.array_files(10, 8) == 8
    assert files.array_files(8 * files.ROWS_PER_ARRAY_FILE, 8) == 8
    assert files.array_files(7_200_000, 8) == 1440


def test_the_summary_builds_its_tables_side_by_side(spark):
    """Tables wait for each other: one after another they would wait for ever."""
    met = threading.Barrier(4)

    def keep(frame, label):
        met.wait(60)
        return frame

    feeds = {name: spark.createDataFrame([], schema) for name, schema in schemas.RAW.items()}
    assert registry.KPIS["summary_kpis"](Medallion(feeds, keep=keep)).first()["total_orders"] == 0


def test_stock_is_counted_once_for_both_inventory_feeds(spark):
    kept = {}
    tables = DriverTables(spark, FOLDER, lambda name, frame: kept.setdefault(name, frame.localCheckpoint()))
    for strict in (False, True):
        plan = raw_inventory(tables, strict)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
    assert list(kept) == ["stock"]


def test_feeds_of_shared_tables_are_not_written_again(spark):
    shared = {"raw_orders": "order_lines-", "raw_shipments": "order_lines-", "raw_inventory": "stock-"}
    for feed, table in shared.items():
        for strict in (False, True):
            found = registry.landed(spark, FOLDER, feed, strict)
            read = found.inputFiles()
            assert read and all(f"/tradewind/{table}" in path for path in read)
            assert found.columns == schemas.RAW[feed].fieldNames()


def test_rules_write_of_facts_only_what_they_read_twice(spark):
    written = []

    def keep(frame, label):
        written.append(label)
        return frame

    feeds = {name: spark.createDataFrame([], schema) for name, schema in schemas.RAW.items()}
    model = Medallion(feeds, keep_star=keep)
    tables = registered_kernels._Tables(model, quality.STANDING_CHECKS)
    tables.prefetch()
    assert sorted(tables["fact_orders"].columns) == ["customer_key", "product_key", "supplier_key"]
    assert "dim-product" in written and "fact-orders" not in written and "fact_orders" not in vars(model)
    tables = registered_kernels._Tables(model, [*quality.DECLARED_RULES, quality.Rule("X", "gold", "fact_orders", "unique", ("order_id",))])
    tables.prefetch()
    assert set(tables["fact_orders"].columns) == {"order_id", "customer_key", "product_key", "supplier_key", "order_date_key"}
    assert all("/checked-fact_orders-" in path for path in tables["fact_orders"].inputFiles())
    found = quality.run_rules(spark, tables, [quality.Rule("Y", "gold", "fact_orders", "unique", ("nowhere",))])
    assert found.first().status == quality.ERROR


def test_scans_of_rules():
    rule = lambda name, kind, *columns, **more: quality.Rule(name, "gold", "f", kind, columns, **more)
    rules = [rule("a", "not_null", "x", "y"), rule("b", "positive", "z"), rule("c", "unique", "x"), rule("d", "reference", "y", ref_entity="g", ref_column="k")]
    assert quality.scans(rules) == {"f": [{"x", "y", "z"}, {"x"}, {"y"}], "g": [{"k"}]}
