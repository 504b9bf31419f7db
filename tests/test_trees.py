"""Compiled trees against the models they come from."""

import random

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from tradewind.functions.trees import boosted_probability, forest

INPUTS = ["a", "b c", "d"]


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(4)
    data = [(float(rnd.randrange(40)), rnd.gauss(0, 3), rnd.randrange(5)) for _ in range(600)]
    data = [(*r, r[0] * 2 - r[1] + rnd.random(), int(r[0] + r[1] * 4 > 20)) for r in data]
    frame = spark.createDataFrame(data, "a double, `b c` double, d int, y double, late int")
    return VectorAssembler(inputCols=INPUTS, outputCol="x").transform(frame)


def no_python(frame):
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return not any(name in plan for name in ("Python", "Pandas", "Arrow", "UDF"))


@pytest.mark.parametrize("trees,depth", [(1, 2), (20, 5), (7, 9)])
def test_forest(table, trees, depth):
    model = RandomForestRegressor(featuresCol="x", labelCol="y", numTrees=trees, maxDepth=depth, seed=3).fit(table)
    scored = model.transform(table).withColumn("own", forest(model, INPUTS))
    assert scored.filter(F.col("own") != F.col("prediction")).count() == 0
    assert no_python(table.drop("x").select(forest(model, INPUTS)))


@pytest.mark.parametrize("rounds", [1, 12])
def test_boosted(table, rounds):
    model = GBTClassifier(featuresCol="x", labelCol="late", maxIter=rounds, maxDepth=3, seed=3).fit(table)
    scored = model.transform(table).withColumn("own", boosted_probability(model, INPUTS))
    apart = F.abs(F.col("own") - vector_to_array("probability")[1])
    assert scored.agg(F.max(apart)).first()[0] < 1e-12
    assert no_python(table.drop("x").select(boosted_probability(model, INPUTS)))


def test_one_leaf(spark):
    frame = VectorAssembler(inputCols=["a"], outputCol="x").transform(spark.createDataFrame([(1.0, 5.0), (2.0, 5.0)], "a double, y double"))
    model = RandomForestRegressor(featuresCol="x", labelCol="y", numTrees=2, seed=1).fit(frame)
    scored = model.transform(frame).select("prediction", forest(model, ["a"]).alias("own")).collect()
    assert all(r.own == r.prediction for r in scored)
