"""Dense numbering and ranking without sorting everything in one task.

A window without partitions, or with a hot one, sorts in a single task.  Here
Spark sorts the rows by range over all tasks, each row takes its place within
its task, and the sorted rows are written once to the shared folder.  The
number of rows in earlier tasks is then added from one row per task, so the
only data brought together is as small as the number of tasks.

Writing fixes the places: reading the rows again, or losing an executor, can
not number them differently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.sources.shared import staged

# Layout of monotonically_increasing_id: task number above, place below.
_PLACE_BITS = 33


def numbered(df: DataFrame, *order: Column, position: str) -> DataFrame:
    """The rows with their 1-based position in the given total order."""
    placed = staged(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "numbered")
    task = F.shiftright("_place", _PLACE_BITS)
    place = F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(task.alias("_task")).agg(F.count("*").alias("_rows"))
    before = sizes.select("_task", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    # One row per task that wrote: bounded by the number of shuffle partitions.
    joined = placed.withColumn("_task", task).join(F.broadcast(before), "_task")
    return joined.select((F.col("_before") + place + 1).alias(position), *df.columns)


def surrogate_key(df: DataFrame, natural_id: str, key: str) -> DataFrame:
    """Number the rows 1..n by ``natural_id``; a missing id comes last.

    For another order, say that of arrival, use ``numbered``.
    """
    return numbered(df, F.col(natural_id).asc_nulls_last(), position=key)


def extended_keys(known: DataFrame, rows: DataFrame, natural_id: str, key: str) -> DataFrame:
    """``natural_id`` and ``key`` of all ids after a later load: those in ``known`` keep theirs, new ones go on after the last.

    New ids are numbered by id, each once however often ``rows`` holds it, and a missing id counts as one.
    Only they are sorted, over all tasks; there are no gaps if ``known`` has none.  Both frames are read
    twice: pass written tables.
    """
    # Structs compare NULL fields as equal, so a missing id is found again.
    at = F.struct(natural_id).alias("_at")
    fresh = rows.select(natural_id).distinct().withColumn("_at", at).join(known.select(at), "_at", "left_anti").drop("_at")
    last = known.agg(F.coalesce(F.max(key), F.lit(0)).alias("_last")).scalar()
    placed = numbered(fresh, F.col(natural_id).asc_nulls_last(), position="_position")
    return known.select(natural_id, key).union(placed.select(natural_id, (F.col("_position") + last).cast(known.schema[key].dataType)))


def dense_rank_desc(df: DataFrame, group: str, value: str, rank: str) -> DataFrame:
    """Dense rank of ``value``, largest first, inside ``group``; NULL ranks first.

    Only the distinct values are put in order, all groups at once, and the
    rank is the distance to the first value of the group.  So neither a hot
    group nor a value shared by many rows gathers in one task.  ``df`` is read
    twice: pass a written table.
    """
    # Structs compare NULL fields as equal, so plain joins find NULLs too.
    values = df.select(group, value).distinct()
    places = numbered(values, F.col(group), F.col(value).desc_nulls_first(), position="_position")
    places = places.withColumn("_group", F.struct(group))
    first = places.groupBy("_group").agg(F.min("_position").alias("_first"))
    ranks = places.join(first, "_group").select(
        F.struct(group, value).alias("_at"), (F.col("_position") - F.col("_first") + 1).cast("int").alias(rank)
    )
    return df.withColumn("_at", F.struct(group, value)).join(ranks, "_at").drop("_at")
