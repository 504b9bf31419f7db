"""Fitted trees as column expressions: scored by Spark's own code, without vectors, models or Python rows.

A tree becomes nested IF expressions over its inputs, a forest their mean, boosted trees
the logistic function of their weighted sum.  They say what Spark's models say, but for the last digit where
that adds up in another order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column
from pyspark.sql import functions as F


def _number(x: float) -> str:
    return f"{x!r}D"


def _text(node, inputs: Sequence[str]) -> str:
    kind = node.getClass().getSimpleName()
    if kind == "LeafNode":
        return _number(node.prediction())
    split = node.split()
    if split.getClass().getSimpleName() != "ContinuousSplit":
        raise ValueError("only splits of numbers at a threshold can be written as an expression")
    at = f"CAST(`{inputs[split.featureIndex()]}` AS DOUBLE)"
    below, above = _text(node.leftChild(), inputs), _text(node.rightChild(), inputs)
    return below if below == above else f"IF({at} <= {_number(split.threshold())}, {below}, {above})"


def tree_text(tree, inputs: Sequence[str]) -> str:
    """SQL of one fitted tree of ``pyspark.ml``; ``inputs`` names its features in order."""
    return _text(tree._java_obj.rootNode(), inputs)


def forest(model: RandomForestRegressionModel, inputs: Sequence[str]) -> Column:
    """What the forest predicts.  Inputs must not be NULL."""
    total = " + ".join(["0.0D", *(tree_text(tree, inputs) for tree in model.trees)])
    return F.expr(f"({total}) / {_number(float(len(model.trees)))}")


def boosted_probability(model: GBTClassificationModel, inputs: Sequence[str]) -> Column:
    """The probability of class 1.  Inputs must not be NULL."""
    terms = [f"{_number(w)} * {tree_text(tree, inputs)}" for w, tree in zip(model.treeWeights, model.trees, strict=True)]
    return F.expr(f"1.0D / (1.0D + exp(-2.0D * ({' + '.join(['0.0D', *terms])})))")
