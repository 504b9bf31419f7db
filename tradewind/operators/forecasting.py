"""Demand forecast and delay prediction with Spark ML.

Features are plain aggregations; fitting runs on the executors, and fitted trees score as column expressions.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind import fixed_values as fixed
from tradewind.functions.scoring import mode_code, risk_level
from tradewind.functions.trees import boosted_probability, forest
from tradewind.operators.scorecards import with_distance

DEMAND_INPUTS = ["historical_avg", "month", "is_promotion", "unit_price_usd"]
DELAY_INPUTS = ["distance_km", "mode_code", "weather_severity", "port_congestion"]
PROMOTION_SHARE = 0.9

# Delay inputs assumed where nothing is known.
DEFAULT_DISTANCE_KM = 3500.0
DEFAULT_WEATHER = 0.4


def _monthly_sales(orders: DataFrame) -> DataFrame:
    dated = orders.filter(F.col("order_date").isNotNull())
    sales = dated.groupBy("product_id", F.trunc("order_date", "month").alias("month_start")).agg(
        F.sum("quantity").alias("units"), F.sum("total_amount_usd").alias("revenue")
    )
    return sales.withColumn("days", F.dayofmonth(F.last_day("month_start")).cast("bigint"))


def _ratio(a: Column, b: Column) -> Column:
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def demand_features(orders: DataFrame) -> DataFrame:
    """One row per product and month sold: what was known before, and what then sold.

    The average counts all calendar days since the product's first month, idle
    ones included.  The window runs over the months of one product, so it stays
    short however often a product sells.
    """
    before = Window.partitionBy("product_id").orderBy("month_start").rowsBetween(Window.unboundedPreceding, -1)
    days_before = F.date_diff("month_start", F.min("month_start").over(before))
    priced = _monthly_sales(orders).withColumns(
        {
            "historical_avg": _ratio(F.sum("units").over(before), days_before),
            "usual_price": _ratio(F.sum("revenue").over(before), F.sum("units").over(before)),
            "unit_price_usd": _ratio(F.col("revenue"), F.col("units")),
        }
    )
    promoted = F.col("unit_price_usd") < F.col("usual_price") * F.lit(PROMOTION_SHARE)
    return priced.select(
        "product_id",
        "month_start",
        "historical_avg",
        F.month("month_start").alias("month"),
        F.coalesce(promoted, F.lit(False)).cast("int").alias("is_promotion"),
        "unit_price_usd",
        (_ratio(F.col("units"), F.col("days")) * F.lit(float(fixed.FORECAST_HORIZON_DAYS))).alias("demand_7_days"),
    )


def upcoming_demand(orders: DataFrame) -> DataFrame:
    """The same inputs for the month after the last one on record, one row per product."""
    sales = _monthly_sales(orders)
    last = sales.agg(F.max("month_start")).scalar()
    totals = sales.groupBy("product_id").agg(
        F.sum("units").alias("units"), F.min("month_start").alias("first"), F.sum("revenue").alias("revenue")
    )
    return totals.select(
        "product_id",
        _ratio(F.col("units"), F.date_diff(F.add_months(last, 1), F.col("first"))).alias("historical_avg"),
        F.month(F.add_months(last, 1)).alias("month"),
        F.lit(0).alias("is_promotion"),
        _ratio(F.col("revenue"), F.col("units")).alias("unit_price_usd"),
    )


def fit_demand_model(features: DataFrame, trees: int = fixed.FOREST_TREES, seed: int = fixed.MODEL_SEED) -> PipelineModel:
    assembler = VectorAssembler(inputCols=DEMAND_INPUTS, outputCol="inputs")
    forest = RandomForestRegressor(
        featuresCol="inputs", labelCol="demand_7_days", predictionCol="predicted", numTrees=trees, seed=seed
    )
    return Pipeline(stages=[assembler, forest]).fit(features.dropna(subset=[*DEMAND_INPUTS, "demand_7_days"]))


def forecast_confidence(model: PipelineModel, held_out: DataFrame) -> DataFrame:
    """One row: 100 less the relative absolute error on months the model has not seen."""
    known = held_out.dropna(subset=[*DEMAND_INPUTS, "demand_7_days"])
    scored = known.withColumn("predicted", forest(model.stages[-1], DEMAND_INPUTS))
    errors = scored.agg(
        F.sum(F.abs(F.col("predicted") - F.col("demand_7_days"))).alias("error"), F.sum("demand_7_days").alias("actual")
    )
    share = F.greatest(F.lit(0.0), F.lit(1.0) - F.col("error") / F.nullif(F.col("actual"), F.lit(0.0)))
    return errors.select(F.coalesce(F.round(share * 100.0, 1), F.lit(fixed.FALLBACK_CONFIDENCE_PCT)).alias("confidence"))


def demand_forecast(upcoming: DataFrame, model: PipelineModel, confidence: DataFrame) -> DataFrame:
    """Seven-day demand per product; products lacking an input get seven average days."""
    known = F.lit(True)
    for column in DEMAND_INPUTS:
        known = known & F.col(column).isNotNull()
    scored = upcoming.filter(known).select(
        "product_id",
        F.round(forest(model.stages[-1], DEMAND_INPUTS)).cast("int").alias("next_7_days_demand"),
        confidence.scalar().alias("forecast_confidence_pct"),
        F.lit(fixed.FOREST_VERSION).alias("model_version"),
        F.lit("SUCCESS").alias("status"),
    )
    average = F.coalesce(F.col("historical_avg"), F.lit(0.0)) * fixed.FORECAST_HORIZON_DAYS
    fallback = upcoming.filter(~known).select(
        "product_id",
        average.cast("int").alias("next_7_days_demand"),
        F.lit(fixed.FALLBACK_CONFIDENCE_PCT).alias("forecast_confidence_pct"),
        F.lit(fixed.FALLBACK_VERSION).alias("model_version"),
        F.lit("FALLBACK").alias("status"),
    )
    return scored.unionByName(fallback)


def delay_features(shipments: DataFrame, warehouses: DataFrame, iot: DataFrame) -> DataFrame:
    """Per shipment: distance, mode, weather from its own sensors, and its warehouse's backlog."""
    weather = iot.groupBy(F.col("shipment_id").alias("_shipment")).agg(
        _ratio(F.sum("humidity_pct"), F.count("humidity_pct") * 100).alias("humidity")
    )
    backlog = shipments.groupBy(F.col("origin_warehouse_id").alias("_warehouse")).agg(
        _ratio(F.count_if(F.col("actual_delivery_at").isNull()), F.count("*")).alias("port_congestion")
    )
    placed = with_distance(shipments, warehouses)
    known = placed.join(weather, F.col("shipment_id") == F.col("_shipment"), "left").join(
        backlog, F.col("origin_warehouse_id") == F.col("_warehouse"), "left"
    )
    return known.select(
        "shipment_id",
        F.coalesce("distance_km", F.lit(DEFAULT_DISTANCE_KM)).alias("distance_km"),
        mode_code(F.col("mode")).alias("mode_code"),
        F.coalesce("humidity", F.lit(DEFAULT_WEATHER)).alias("weather_severity"),
        F.coalesce("port_congestion", F.lit(0.0)).alias("port_congestion"),
        "mode",
        F.col("actual_delivery_at").isNotNull().alias("is_delivered"),
        F.col("is_delayed").cast("int").alias("is_delayed"),
    )


def fit_delay_model(features: DataFrame, stages: int = fixed.BOOSTING_STAGES, seed: int = fixed.MODEL_SEED) -> PipelineModel:
    """Fit on delivered shipments, whose delay is known."""
    assembler = VectorAssembler(inputCols=DELAY_INPUTS, outputCol="inputs")
    boosting = GBTClassifier(featuresCol="inputs", labelCol="is_delayed", maxIter=stages, maxDepth=3, seed=seed)
    return Pipeline(stages=[assembler, boosting]).fit(features.filter("is_delivered"))


def fold(shipment_id: str = "shipment_id") -> Column:
    """Which of two halves a shipment belongs to, by hash of its id."""
    return F.pmod(F.xxhash64(shipment_id), F.lit(2))


def unseen_delay_prediction(features: DataFrame) -> DataFrame:
    """Every shipment scored by a model fitted on the other half, which has not seen it."""
    halves = [features.filter(fold() == half) for half in (0, 1)]
    models = [fit_delay_model(half) for half in halves]
    return delay_prediction(halves[0], models[1]).unionByName(delay_prediction(halves[1], models[0]))


def delay_prediction(features: DataFrame, model: PipelineModel) -> DataFrame:
    probability = F.round(boosted_probability(model.stages[-1], DELAY_INPUTS), 2)
    percent = F.round(probability * 100.0, 1)
    return features.select(
        "shipment_id",
        percent.alias("delay_probability_pct"),
        risk_level(percent).alias("risk_level"),
        F.struct(F.col("mode").alias("transport_mode"), "weather_severity", "port_congestion").alias("key_factors"),
    )
