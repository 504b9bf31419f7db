"""Put one-row aggregates next to each other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def side_by_side(first: DataFrame, *others: DataFrame) -> DataFrame:
    """One row with the columns of all frames, each of which must hold one row.

    The others become scalar subqueries, so no join is planned and Spark runs
    the aggregates at the same time.
    """
    parts = {f"_part{i}": other for i, other in enumerate(others)}
    row = first.select("*", *[o.select(F.struct("*")).scalar().alias(n) for n, o in parts.items()])
    fields = [F.col(n)[c].alias(c) for n, o in parts.items() for c in o.columns]
    return row.select(*first.columns, *fields)
