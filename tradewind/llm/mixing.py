"""Mixing sources to target weights by hash thresholds, without sorting rows.

A source's target is its share of all words by weight, but at most ``epochs``
times its words; what that leaves over is shared again by weight.  A source
whose target is ``q`` times its words and a rest takes each document ``q``
times, and once more those whose hash lies below a threshold.  The threshold
comes from histograms: words are summed by source and hash bucket, the bucket
in which the running sum reaches the rest is found, and only that bucket's
rows are summed again by their next bits.  Four such steps of 10 bits leave
cells that hold one document as a rule; the last one is taken if that
brings the source nearer to its target.  The hash of a document does not depend
on the budget, so a smaller budget's mix lies within a larger one's wherever its
targets are no larger.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import n_words
from tradewind.operators.ordinals import numbered
from tradewind.sources.shared import staged

# Fixed values of the mix asked for: weights of the sources in order, repeating.
WEIGHTS = (5, 2, 1)
EPOCHS = 3

LEVEL_BITS = 10
LEVELS = 4
_HASH_BITS = LEVEL_BITS * LEVELS


def _hash(value: Column) -> Column:
    """The first 40 bits of a value's MD5; a missing one counts as an empty string."""
    digits = F.substring(F.md5(F.coalesce(value.cast("string"), F.lit(""))), 1, _HASH_BITS // 4)
    return F.conv(digits, 16, 10).cast("bigint")


def source_targets(sized: DataFrame, budget: float, weights: tuple[int, ...], epochs: int) -> DataFrame:
    """One row a source: key ``_source``, its words and its target.

    Raising the common rate word by weight until no source is above its cap
    needs one small sum per round; sources come to the driver only as sums.
    """
    totals = staged(sized.groupBy("_source").agg(F.sum("size").alias("source_size")), "mix-totals")
    placed = numbered(totals, F.col("_source.source").asc_nulls_last(), position="_place")
    of_place = F.element_at(F.array(*map(F.lit, weights)), ((F.col("_place") - 1) % len(weights) + 1).cast("int"))
    plan = staged(placed.select("_source", "source_size", of_place.cast("bigint").alias("_weight")), "mix-weights")
    whole = plan.agg(F.sum("source_size"), F.sum("_weight")).first()
    spread, weight = int((whole[0] or 0) * budget), whole[1] or 1
    cap = F.col("source_size") * epochs
    above = F.lit(False)
    while True:
        above = F.col("_weight") * spread > cap * weight
        sums = plan.agg(
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("_weight"))), F.lit(0))
        ).first()
        left = int((whole[0] or 0) * budget) - sums[0]
        if (left, sums[1]) == (spread, weight) or not sums[1]:
            break
        spread, weight = left, sums[1]
    share = (F.col("_weight") * spread).cast("double") / F.lit(float(weight))
    return plan.select("_source", "source_size", F.when(above, cap.cast("double")).otherwise(share).alias("target"))


def _refined(rows: DataFrame, plan: DataFrame, hashed: str, cell: str) -> DataFrame:
    """``plan`` with ``cell``, the value of ``hashed`` at which a source's words reach ``_rest``, and ``_before``, the words below it.

    Each level sums the words of one bucket's parts and goes on with the part that reaches the rest.
    """
    plan = plan.withColumn(cell, F.lit(0).cast("bigint"))
    for level in range(1, LEVELS + 1):
        shift = _HASH_BITS - LEVEL_BITS * level
        inside = rows.join(plan.filter("_rest > 0").select("_source", cell), "_source")
        inside = inside.filter(F.shiftright(hashed, shift + LEVEL_BITS) == F.col(cell))
        sums = inside.groupBy("_source", F.shiftright(hashed, shift).alias("_bucket")).agg(F.sum("size").alias("_words"))
        # At most 2**LEVEL_BITS rows a source, whatever the input.
        upto = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
        sums = sums.withColumn("_upto", F.sum("_words").over(upto))
        met = sums.join(plan.select("_source", "_rest", F.col("_before").alias("_base")), "_source")
        reached, below = F.col("_base") + F.col("_upto"), F.col("_base") + F.col("_upto") - F.col("_words")
        met = met.filter((below < F.col("_rest")) & (reached >= F.col("_rest")))
        met = met.select("_source", F.col("_bucket").alias("_at"), below.alias("_below"))
        found = plan.withColumnRenamed("_before", "_old").drop(cell).join(met, "_source", "left")
        found = found.select("*", F.coalesce("_below", "_old").alias("_before"), F.coalesce("_at", F.lit(0)).alias(cell))
        plan = staged(found.drop("_at", "_below", "_old"), f"mix-{cell[1:]}{level}")
    return plan


def _thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Whole passes of each source, and where its further words end: at a hash of ids, and among those at one of texts."""
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = targets.withColumn("_passes", passes.cast("bigint"))
    plan = plan.withColumn("_rest", F.col("target") - F.col("_passes") * F.col("source_size"))
    plan = staged(plan.withColumn("_before", F.lit(0).cast("bigint")), "mix-plan")
    plan = _refined(sized, plan, "_hash", "_cell")
    # Rows that share an id, or have none, share its hash: there the texts' own hashes go on.
    shared = sized.join(plan.filter("_rest > 0").select("_source", F.col("_cell").alias("_hash")), ["_source", "_hash"])
    shared = staged(shared.select("_source", "_mark", "size"), "mix-shared")
    if shared.groupBy("_source").count().filter("count > 1").isEmpty():
        return plan.withColumn("_mark_cell", F.lit(None).cast("bigint"))
    return _refined(shared, plan, "_mark", "_mark_cell")


def _taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows (_source, _hash, _mark, size, ...) with ``_copies``, how often the mix holds each."""
    plan = plan.select("_source", "_passes", "_rest", "_cell", "_mark_cell", "_before")
    joined = rows.join(plan, "_source")
    open_ = F.col("_rest") > 0
    last = open_ & (F.col("_hash") == F.col("_cell")) & F.coalesce(F.col("_mark") == F.col("_mark_cell"), F.lit(True))
    below = (F.col("_hash") < F.col("_cell")) | (F.col("_hash") == F.col("_cell")) & F.coalesce(F.col("_mark") < F.col("_mark_cell"), F.lit(False))
    more = joined.filter(~last).withColumn("_copies", F.col("_passes") + F.when(open_ & below, 1).otherwise(0))
    # At the end itself stand copies of one text, most often one: taken one by one while the target comes nearer.
    line = Window.partitionBy("_source").orderBy("size").rowsBetween(Window.unboundedPreceding, 0)
    edge = joined.filter(last).withColumn("_upto", F.col("_before") + F.sum("size").over(line))
    nearer = F.col("_upto") - F.col("_rest") < F.col("_rest") - (F.col("_upto") - F.col("size"))
    further = (F.col("_upto") < F.col("_rest")) | (F.col("_upto") - F.col("size") < F.col("_rest")) & nearer
    edge = edge.withColumn("_copies", F.col("_passes") + F.when(further, 1).otherwise(0)).drop("_upto")
    return more.unionByName(edge).drop("_passes", "_rest", "_cell", "_mark_cell", "_before")


def _keys(row: str = "") -> dict[str, Column]:
    of = lambda name: F.col(f"{row}.{name}" if row else name)
    return {"_source": F.struct(of("source").alias("source")), "_hash": _hash(of("doc_id")), "_mark": _hash(of("text")), "size": n_words(of("text"))}


def _plan(docs: DataFrame, budget: float, weights: tuple[int, ...], epochs: int) -> tuple[DataFrame, DataFrame]:
    """Sizes of the documents, written, and where their sources' words end, with each source's size and target."""
    sized = docs.select("doc_id", *(c.alias(n) for n, c in _keys().items()))
    sized = staged(sized, "mix-sizes")
    return sized, staged(_thresholds(sized, source_targets(sized, budget, weights, epochs)), "mix-thresholds")


def mix_sources(
    docs: DataFrame, budget: float = 1.0, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS
) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row of ``docs`` (doc_id, text, source).

    ``budget`` is the mix's size as a share of all words.  ``taken / size`` is how
    often the mix holds the document.  A NULL or empty text has size 0 and takes
    0 words.  A NULL source is a source of its own, ordered last.  Rows of one
    doc_id, and rows without one, share a hash; where a source's target ends among them, they are
    told apart by their texts, and copies are taken one by one.  An empty
    table gives no rows.  Other columns are not looked at.
    """
    sized, plan = _plan(docs, budget, weights, epochs)
    taken = _taken(sized, plan).join(plan.select("_source", "source_size", "target"), "_source")
    return taken.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("_copies")).alias("taken"),
        F.col("_source.source").alias("source"),
    )


def take_mix(docs: DataFrame, budget: float = 1.0, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """The rows of ``docs`` as often as ``mix_sources`` takes them, all their columns as they are.

    NULLs, empty texts, repeated rows and an empty table as there; a row whose text has no words is taken like others of its hash.
    """
    _, plan = _plan(docs, budget, weights, epochs)
    # The row travels as one struct, so its columns' names meet no others.
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("_row"))
    taken = _taken(rows.withColumns(_keys("_row")), plan).filter("_copies > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select("_row.*")
