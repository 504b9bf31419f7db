"""Raw feeds derived from the benchmark's relational tables.

The benchmark ships parts, suppliers, orders, order lines and events.  Each
function below rewrites them into one raw feed of the supply-chain model: all
text, padded, with currency signs and, unless ``strict``, with unparsable,
missing and out-of-range values, so that every cleansing rule has work to do at
any scale.  ``strict`` feeds hold the same rows with castable values only.

All arithmetic that ends up in text is integer arithmetic.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind import fixed_values as fixed
from tradewind import schemas
from tradewind.session import configure

NATIONS = 25  # the benchmark has 25 nations at every scale
CARRIERS = 7
STATIC_LOAD = "2001-12-31 00:00:00"
_ISO = "yyyy-MM-dd'T'HH:mm:ss"
_ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


# Columns of the driver's tables; naming them saves a look into the files.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}

class DriverTables:
    """Named access to ``<folder>/<table>.parquet``, one file or a folder of part files."""

    def __init__(self, spark: SparkSession, folder: str, written: Callable[[str, DataFrame], DataFrame] | None = None):
        """``written`` may keep what several feeds are derived from: it gets a name and the frame, and returns a copy."""
        self.spark = configure(spark)
        self.folder = folder.rstrip("/")
        self.written = written or (lambda name, frame: frame)

    def __getitem__(self, table: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[table]).parquet(f"{self.folder}/{table}.parquet")

    def stream(self, table: str, files_per_batch: int | None = None) -> DataFrame:
        """The table as an unbounded file source, ``files_per_batch`` files at a time.

        The path is a pattern that matches this one name, so that a single file
        is taken as well as a folder.
        """
        source = self.spark.readStream.schema(SCHEMAS[table])
        if files_per_batch:
            source = source.option("maxFilesPerTrigger", files_per_batch)
        return source.parquet(f"{self.folder}/{table}.parque[t]")


def _id(prefix: str, key: Column, width: int = 10) -> Column:
    return F.concat(F.lit(prefix), F.lpad(key.cast("string"), width, "0"))


def _cents(amount: Column) -> Column:
    return F.round(amount * 100).cast("bigint")


def _div(a: Column, b: int | Column) -> Column:
    return F.call_function("div", a, F.lit(b) if isinstance(b, int) else b)


def _two_digits(n: Column) -> Column:
    return F.lpad(n.cast("string"), 2, "0")


def _dollars(cents: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(_div(cents, 100), 0), F.lit("."), _two_digits(cents % 100))


def _hundredths(n: Column) -> Column:
    return F.concat(_div(n, 100).cast("string"), F.lit("."), _two_digits(n % 100))


def _padded(text: Column) -> Column:
    return F.concat(F.lit("  "), text, F.lit(" "))


def _defect(strict: bool, value: Column, *cases: tuple[Column, str | None]) -> Column:
    """``value``, replaced by the text of the first case that applies."""
    if strict:
        return value
    chosen = F
    for condition, text in cases:
        chosen = chosen.when(condition, F.lit(text).cast("string"))
    return chosen.otherwise(value)


def _feed(df: DataFrame, table: str, loaded_at: Column, payload: Column | None = None) -> DataFrame:
    load = {
        "raw_payload": F.lit(None).cast("string") if payload is None else payload,
        "source_system": F.lit(fixed.SOURCE_SYSTEMS[table]),
        "ingested_at": loaded_at.cast("timestamp"),
    }
    return df.withColumns(load).select(*schemas.RAW[table].fieldNames())


def _with_nation(df: DataFrame, tables: DriverTables, key: str) -> DataFrame:
    nation = tables["nation"].join(
        tables["region"], F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    return df.join(nation, F.col(key) == F.col("n_nationkey"), "left")


def raw_suppliers(tables: DriverTables, strict: bool = False) -> DataFrame:
    k = F.col("s_suppkey")
    rating = _hundredths(F.lit(300) + _div((_cents(F.col("s_acctbal")) + 100000) * 200, 1100000))
    df = _with_nation(tables["supplier"], tables, "s_nationkey").select(
        _id("SUP-", k).alias("supplier_id"),
        _padded(F.col("s_name")).alias("name"),
        F.concat(F.upper(F.translate("s_name", "#", ".")), F.lit("@SUPPLIERS.EXAMPLE")).alias("contact_email"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("region"),
        F.when(F.col("s_acctbal") >= 5000, "Tier 1").otherwise("Tier 2").alias("tier"),
        _defect(strict, rating, (k % 13 == 5, "n/a"), (k % 17 == 3, None)).alias("rating"),
    )
    payload = F.to_json(F.struct("supplier_id", "country", "tier"))
    return _feed(df, "raw_suppliers", F.lit(STATIC_LOAD), payload)


def raw_products(tables: DriverTables, strict: bool = False) -> DataFrame:
    k = F.col("p_partkey")
    suppliers = tables["supplier"].agg(F.count("*")).scalar()
    weight = F.concat(F.col("p_size").cast("string"), F.lit(".5"))
    df = tables["part"].select(
        _id("PRD-", k).alias("product_id"),
        _padded(F.concat(F.lower("p_brand"), F.lit("-"), k.cast("string"))).alias("sku"),
        _padded(F.col("p_name")).alias("name"),
        F.col("p_type").alias("category"),
        _dollars(_cents(F.col("p_retailprice"))).alias("unit_cost"),
        F.when(k % 11 == 0, F.lit(None)).when(k % 7 == 0, F.lit("EUR")).otherwise(F.lit("USD")).alias("currency"),
        _defect(strict, weight, (k % 19 == 0, None), (k % 23 == 0, "heavy")).alias("weight_kg"),
        _id("SUP-", k % suppliers).alias("supplier_id"),
    )
    return _feed(df, "raw_products", F.lit(STATIC_LOAD))


def raw_warehouses(tables: DriverTables, strict: bool = False) -> DataFrame:
    k = F.col("n_nationkey")
    latitude = F.concat(((k * 7) % 120 - 60).cast("string"), F.lit(".250000"))
    longitude = F.concat(((k * 13) % 300 - 150).cast("string"), F.lit(".500000"))
    df = tables["nation"].select(
        _id("WH-", k, 3).alias("warehouse_id"),
        _padded(F.concat(F.lit("hub-"), k.cast("string"))).alias("code"),
        _padded(F.concat(F.col("n_name"), F.lit(" Distribution Hub"))).alias("name"),
        F.concat(F.col("n_name"), F.lit(" City")).alias("city"),
        F.col("n_name").alias("country"),
        _defect(strict, latitude, (k % 11 == 7, "N/A")).alias("latitude"),
        longitude.alias("longitude"),
        _defect(strict, (k * 5000 + 100000).cast("string"), (k % 9 == 4, "unknown")).alias("capacity_sqft"),
        F.when(k % 3 == 0, "Cold Storage").when(k % 3 == 1, "Ambient").otherwise("Frozen").alias("temp_zone_type"),
    )
    return _feed(df, "raw_warehouses", F.lit(STATIC_LOAD))


def raw_customers(tables: DriverTables, strict: bool = False) -> DataFrame:
    df = _with_nation(tables["customer"], tables, "c_nationkey").select(
        _id("CUS-", F.col("c_custkey")).alias("customer_id"),
        _padded(F.col("c_name")).alias("company_name"),
        F.col("c_mktsegment").alias("industry"),
        F.col("n_name").alias("country"),
        F.col("r_name").alias("region"),
        F.when(F.col("c_acctbal") >= 5000, "Enterprise").otherwise("Mid-Market").alias("tier"),
    )
    return _feed(df, "raw_customers", F.lit(STATIC_LOAD))


# What the feeds take of order lines and orders; the rest is neither moved nor written.
_OF_LINES = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate"]
_OF_ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"]


def order_lines(tables: DriverTables) -> DataFrame:
    """Order lines with their orders, spread evenly: the files they come from may be few and large.

    The join itself deals the lines out by order, whatever the size of the orders, so they move once.
    """
    lines, orders = tables["lineitem"].select(*_OF_LINES), tables["orders"].select(*_OF_ORDERS)
    joined = lines.hint("merge").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    return tables.written("order_lines", joined)


def _line_id(prefix: str) -> Column:
    return F.concat(_id(prefix, F.col("l_orderkey")), F.lit("-"), F.col("l_linenumber").cast("string"))


def _line_status() -> Column:
    state, line = F.col("o_orderstatus"), F.col("l_linenumber")
    return (
        F.when(state == "F", "DELIVERED")
        .when(state == "O", "IN_TRANSIT")
        .when(line == 3, "CUSTOMS_HOLD")
        .otherwise("DELAYED")
    )


def raw_orders(tables: DriverTables, strict: bool = False) -> DataFrame:
    k, units = F.col("l_orderkey"), F.col("l_quantity").cast("int")
    customer = _id("CUS-", F.col("o_custkey"))
    quantity = _defect(
        strict,
        units.cast("string"),
        (k % 29 == 0, "n/a"),
        (k % 31 == 7, "0"),
        (k % 37 == 3, None),
    )
    ordered = F.col("o_orderdate").cast("timestamp")
    status = F.when((F.col("o_orderstatus") == "P") & (F.col("l_linenumber") == 7), "CANCELLED").otherwise(_line_status())
    df = order_lines(tables).select(
        _line_id("ORD-").alias("order_id"),
        _defect(strict, customer, (k % 97 == 0, None), (F.col("o_custkey") % 50 == 7, "CUS-UNKNOWN")).alias("customer_id"),
        _id("PRD-", F.col("l_partkey")).alias("product_id"),
        _id("SUP-", F.col("l_suppkey")).alias("supplier_id"),
        (quantity if strict else F.when(k % 41 == 5, F.concat(quantity, F.lit(".7"))).otherwise(quantity)).alias("quantity"),
        _dollars(_div(_cents(F.col("l_extendedprice")), units.cast("bigint"))).alias("unit_price"),
        F.when(k % 6 == 5, F.lit(None)).when(k % 5 == 1, "EUR").otherwise("USD").alias("currency"),
        _defect(strict, F.date_format(ordered, _ISO), (k % 43 == 9, "unknown")).alias("order_date"),
        F.date_format(F.timestamp_add("DAY", F.lit(30), ordered), _ISO).alias("required_date"),
        status.alias("status"),
        "l_shipdate",
    )
    return _feed(df, "raw_orders", F.col("l_shipdate"))


def raw_shipments(tables: DriverTables, strict: bool = False) -> DataFrame:
    k, line = F.col("l_orderkey"), F.col("l_linenumber")
    port = F.concat(F.lit("Port "), (F.col("o_custkey") % NATIONS).cast("string"))
    shipped = F.col("l_shipdate").cast("timestamp")
    estimated = F.timestamp_add("DAY", F.lit(3) + F.col("l_quantity").cast("int") % 8, shipped)
    discount = F.round(F.col("l_discount") * 100).cast("int")
    minutes = (discount - 4) * 720 + F.when(discount == 4, 40).otherwise(0)
    actual = F.when(_line_status() == "DELIVERED", F.date_format(F.timestamp_add("MINUTE", minutes, estimated), _ISO))
    modes = F.array(*[F.lit(m) for m in fixed.TRANSIT_MODES])
    df = order_lines(tables).select(
        _line_id("SHP-").alias("shipment_id"),
        _defect(strict, _line_id("ORD-"), (k % 89 == 2, "ORD-UNKNOWN")).alias("order_id"),
        _id("WH-", F.col("l_suppkey") % NATIONS, 3).alias("origin_warehouse_id"),
        port.alias("destination_city"),
        F.concat(F.lit("NATION_"), (F.col("o_custkey") % NATIONS).cast("string")).alias("destination_country"),
        F.concat(F.lit("CARRIER-"), (k % CARRIERS).cast("string")).alias("carrier"),
        F.element_at(modes, line % 4 + 1).alias("mode"),
        _line_status().alias("status"),
        _defect(strict, F.date_format(shipped, _ISO), (k % 47 == 11, "not recorded")).alias("shipped_at"),
        F.date_format(estimated, _ISO).alias("estimated_delivery_at"),
        actual.alias("actual_delivery_at"),
        "l_shipdate",
    )
    return _feed(df, "raw_shipments", F.col("l_shipdate"))


def stock(tables: DriverTables) -> DataFrame:
    """Units of each part by warehouse, counted once for both feeds of the inventory."""
    counted = (
        tables["lineitem"]
        .groupBy("l_partkey", (F.col("l_suppkey") % NATIONS).alias("warehouse"))
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("units"), F.max("l_shipdate").alias("counted"))
    )
    return tables.written("stock", counted)


def raw_inventory(tables: DriverTables, strict: bool = False) -> DataFrame:
    p, w = F.col("l_partkey"), F.col("warehouse")
    quantity = ((F.col("units") * 31 + p * 17) % 1500).cast("string")
    df = stock(tables).select(
        F.concat(_id("INV-", w, 3), F.lit("-"), F.lpad(p.cast("string"), 10, "0")).alias("inventory_id"),
        _id("WH-", w, 3).alias("warehouse_id"),
        _id("PRD-", p).alias("product_id"),
        _defect(strict, quantity, (p % 53 == 0, "n/a"), (p % 67 == 1, "-5")).alias("quantity_on_hand"),
        _defect(strict, (p % 201 + 100).cast("string"), (p % 59 == 0, None)).alias("reorder_level"),
        _defect(strict, (p % 101 + 50).cast("string"), (p % 61 == 0, "")).alias("safety_stock"),
        F.date_format(F.col("counted").cast("timestamp"), _ISO).alias("last_counted_at"),
        "counted",
    )
    return _feed(df, "raw_inventory", F.col("counted"))


def iot_readings(events: DataFrame, orders: Column, strict: bool = False) -> DataFrame:
    """Sensor feed of an events frame, bounded or not; every tenth reading arrives twice."""
    e = F.col("event_id")
    tenths = _div(_cents(F.col("value")), 10)
    moment = F.col("ts").cast("timestamp")
    deliveries = F.when(e % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    df = events.withColumn("delivery", F.explode(deliveries)).select(
        _id("EVT-", e).alias("event_id"),
        F.concat(_id("SHP-", e % orders), F.lit("-"), (e % 7 + 1).cast("string")).alias("shipment_id"),
        F.concat(F.lit("DEV-"), F.col("user_id").cast("string")).alias("device_id"),
        F.concat((e % 120 - 60).cast("string"), F.lit(".25")).alias("latitude"),
        F.concat((e % 300 - 150).cast("string"), F.lit(".5")).alias("longitude"),
        _defect(
            strict,
            _hundredths(tenths),
            (F.col("event_type") == "error", "ERR"),
            (e % 101 == 0, "-99.90"),
        ).alias("temperature_c"),
        F.get_json_object("props", "$.k").alias("humidity_pct"),
        _defect(strict, ((e * 7) % 101).cast("string"), (e % 23 == 0, None)).alias("battery_level"),
        F.date_format(moment, _ISO_MICROS).alias("recorded_at"),
        F.timestamp_add("SECOND", F.col("delivery"), moment).alias("arrived"),
        "props",
    )
    return _feed(df, "raw_iot_sensors", F.col("arrived"), F.col("props"))


def order_count(tables: DriverTables) -> Column:
    return tables["orders"].agg(F.count("*")).scalar()


def raw_iot_sensors(tables: DriverTables, strict: bool = False) -> DataFrame:
    return iot_readings(tables.written("events", tables["events"].hint("rebalance")), order_count(tables), strict)


#: Feeds that rewrite the rows of one shared table one by one.
REWRITTEN = {"raw_orders", "raw_shipments", "raw_inventory"}
