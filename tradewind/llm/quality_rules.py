"""Quality rules: fixed counts, and a log-likelihood ratio of hashed n-grams.

Words and word pairs are hashed to a fixed number of buckets.  Two multinomials
over the buckets are counted: one over all documents, one over trusted ones, all
documents that labels call good.  A document's score is
the mean log ratio of the two over its n-grams; the same threshold, a low quantile of all
trusted documents' own scores less a margin, decides for every document.  Rows are measured
once and written without their texts; the threshold is read off what was written.

Everything is a column expression.  Repeated windows are found in the row:
window hashes, with their position in the low bits, are sorted as long integers, equal
neighbours are compared word by word, and the words they cover are counted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import WORD, constant, let
from tradewind.sources.shared import staged

# Fixed values of the rules.
LEAST_WORDS = 50
WINDOW = 3
REPEATED_PERCENT = 50
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"

BUCKETS = 4096
#: Quantile of the trusted scores, and how far below it a document may lie.
QUANTILE, MARGIN = 0.005, 0.03
_PSEUDO = 1.0


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def _grams(hashes: Column) -> Column:
    """Buckets of the words and of the pairs of neighbours."""
    single = F.transform(hashes, lambda h: h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int"))
    n = F.size(hashes)
    double = F.zip_with(
        F.slice(hashes, 1, F.greatest(n - 1, F.lit(0))),
        F.slice(hashes, 2, F.greatest(n - 1, F.lit(0))),
        lambda a, b: F.xxhash64(a, b).bitwiseAND(F.lit(BUCKETS - 1)).cast("int"),
    )
    return F.concat(single, double)


def _repeated(words: Column, hashes: Column) -> Column:
    """Words in windows that occur twice or more."""

    def covered(starts: Column) -> Column:
        def own(start: Column, place: Column) -> Column:
            following = F.get(starts, place + 1)
            return F.least(F.lit(WINDOW), F.coalesce(following - start, F.lit(WINDOW)))

        return F.aggregate(F.transform(starts, own), F.lit(0).cast("bigint"), lambda total, x: total + x)

    def found(bits: Column) -> Column:
        # Positions take the lowest bits, as few as this text needs.
        low = F.lit(1).cast("bigint")
        size = F.call_function("shiftleft", low, bits)
        packed = F.transform(
            F.sequence(F.lit(0), F.size(words) - WINDOW),
            lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2)).bitwiseAND(-size).bitwiseOR(
                i.cast("bigint")
            ),
        )

        def same(a: Column, b: Column) -> Column:
            place = lambda x: x.bitwiseAND(size - 1).cast("int") + 1
            alike = a.bitwiseAND(-size) == b.bitwiseAND(-size)
            return F.coalesce(alike & (F.slice(words, place(a), WINDOW) == F.slice(words, place(b), WINDOW)), F.lit(False))

        def starts(ordered: Column) -> Column:
            twice = F.transform(
                ordered,
                lambda x, k: F.when(same(x, F.get(ordered, k + 1)) | same(x, F.get(ordered, k - 1)), x.bitwiseAND(size - 1)),
            )
            return F.sort_array(F.filter(twice, lambda x: x.isNotNull()))

        return let(let(F.sort_array(packed), starts), covered)

    bits = F.ceil(F.log2(F.size(words) + 1)).cast("int")
    return F.when(F.size(words) < WINDOW + 1, F.lit(0).cast("bigint")).otherwise(let(bits, found))


def _ratios(docs: DataFrame, trusted: DataFrame) -> Column:
    """Log ratio of every bucket, a constant array of fixed size."""
    # The trusted ids are the side that is held; texts are dealt out, not sorted.
    flagged = docs.join(trusted.withColumn("_good", F.lit(True)).hint("shuffle_hash"), "doc_id", "left")
    hashes = F.transform(_words(F.coalesce("text", F.lit(""))), lambda w: F.xxhash64(w))
    grams = flagged.select(F.coalesce("_good", F.lit(False)).alias("good"), F.explode(let(hashes, _grams)).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count_if("good").alias("target"))
    rows = counts.collect()  # one row a bucket
    raw, target = [0] * BUCKETS, [0] * BUCKETS
    for row in rows:
        raw[row.bucket], target[row.bucket] = row.raw, row.target
    sums = sum(raw) + _PSEUDO * BUCKETS, sum(target) + _PSEUDO * BUCKETS
    return constant(
        [math.log((t + _PSEUDO) / sums[1]) - math.log((r + _PSEUDO) / sums[0]) for r, t in zip(raw, target, strict=True)]
    )


def _score(hashes: Column, ratios: Column) -> Column:
    total = F.aggregate(_grams(hashes), F.lit(0.0), lambda total, b: total + F.element_at(ratios, b + 1))
    n = F.size(hashes)
    return F.when(n > 0, total / (2 * n - 1))


def quality_rules(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN) -> DataFrame:
    """Counts, score and verdict of every row of ``docs`` (doc_id, text).

    ``labels`` (doc_id, quality) names good documents by quality 1.  Columns: doc_id,
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    score.  A NULL or empty text has no words, fails the base rules, and has a NULL
    score.  Without any label all ratios are those of raw counts against none, and
    only the base rules decide.  Repeated rows are judged each, alike; rows without an id are
    judged but never trusted; an empty table gives no rows; other columns are not looked at.
    """
    docs = docs.select("doc_id", "text")
    trusted = labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    ratios = _ratios(docs, trusted)

    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    plain = F.translate(text, _SPACES, "")

    def measured(words: Column) -> Column:
        return let(
            F.transform(words, lambda w: F.xxhash64(w)),
            lambda hashes: F.struct(
                F.size(words).cast("bigint").alias("n_words"),
                _repeated(words, hashes).alias("n_repeat_words"),
                _score(hashes, ratios).alias("score"),
            ),
        )

    out = docs.select(
        "doc_id",
        let(_words(text), measured).alias("_m"),
        F.length(plain).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
    ).select("*", "_m.*").drop("_m")
    out = staged(out, "quality-counts")
    of_trusted = out.select("doc_id", "score").join(trusted, "doc_id", "left_semi")
    lowest = of_trusted.agg(F.percentile_approx("score", quantile, 100_000)).first()[0]
    threshold = float("-inf") if lowest is None else lowest - margin

    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEATED_PERCENT)
    return out.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & F.coalesce(F.col("score") >= threshold, F.lit(True))).alias("kept"),
        "score",
    )
