"""Language identification by fusing evidence in Bayes' way.

Text gives likelihoods: byte trigrams, hashed to a fixed number of buckets, under
one multinomial per language, fitted on a bounded sample of each label's different texts.  The
language a page declares gives likelihoods too: how often each true
language is declared so, counted over all rows.  The prior is the host's: its
languages are counted by grouped aggregation and smoothed towards those of its address
suffix, which are smoothed towards those of all rows.  True languages are taken to be
those the text alone points to.

A row is rejected when its text says nothing (no trigram), when no language explains
it better than chance, or when no language gets half the posterior.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.common import constant, small_batches, texts
from tradewind.sources.shared import staged

BITS = 14
#: Different texts of each language, in expectation, on which its likelihoods are fitted.
SAMPLE_TEXTS = 8000
# Neighbouring trigrams share bytes, so each counts for less than an independent one.
TEMPER = 0.3
#: Rows of the level above that a host's or suffix's own counts are weighed against.
STRENGTH = 20.0
LEAST_POSTERIOR = 0.5
_DECLARED_EACH, _GRAM_EACH = 0.5, 0.5
# Share of trigrams taken to come by chance, whatever the language: what names,
# numbers and keys in a text can cost it is bounded.
_CHANCE = 0.1
# Letters of ASCII in lower case and all bytes beyond; anything else is a space.
_HAS_LETTER = r"[A-Za-z]|[^\x00-\x7F]"
_LETTERS = bytes(b if b >= 0x80 or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))


def _grams(batch: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all texts' trigrams over letters, and each text's number of them."""
    plain = [b" ".join((t or b"").translate(_LETTERS).split()) for t in batch]
    plain = [b" " + t + b" " if t else t for t in plain]
    counts = np.array([max(0, len(t) - 2) for t in plain], np.int64)
    flat = np.frombuffer(b"".join(plain), np.uint8).astype(np.uint32)
    if len(flat) < 3:
        return np.zeros(0, np.uint32), counts
    codes = (flat[:-2] << np.uint32(16)) | (flat[1:-1] << np.uint32(8)) | flat[2:]
    lengths = np.array([len(t) for t in plain])
    starts = np.cumsum(lengths) - lengths
    inside = np.ones(len(flat), bool)
    for back in (1, 2):  # the last two bytes of a text start no trigram of it
        ends = (starts + lengths - back)[lengths >= back]
        inside[ends] = False
    codes = codes[inside[: len(codes)]] * np.uint32(0x9E3779B1)
    return codes >> np.uint32(32 - BITS), counts


class LanguageModel:
    """Log likelihoods of buckets by language: a table of fixed size."""

    def __init__(self, languages: list[str], counts: np.ndarray) -> None:
        self.languages = languages
        # Smoothing must not make a language of few texts look like chance, or noise would pass as it.
        scale = np.maximum(1, (1 << BITS) / np.maximum(1, counts.sum(1, keepdims=True)))
        smooth = counts * scale + _GRAM_EACH
        shares = smooth / smooth.sum(1, keepdims=True)
        self.table = np.log((1 - _CHANCE) * shares + _CHANCE / (1 << BITS)).astype(np.float32)

    def __call__(self, batch: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Rows of log likelihoods relative to chance, and the number of trigrams."""
        buckets, counts = _grams(batch)
        out = np.zeros((len(batch), len(self.languages)))
        full = counts > 0
        if full.any():
            starts = (np.cumsum(counts) - counts)[full]
            for place, row in enumerate(self.table):
                out[full, place] = np.add.reduceat(row[buckets].astype(np.float64), starts)
        return out + (counts * BITS * math.log(2))[:, None], counts


def fit_language_model(labelled: DataFrame, sample_texts: int = SAMPLE_TEXTS) -> LanguageModel:
    """Count trigrams of a bounded sample of ``labelled`` (text, lang).

    Of each language whichever ``sample_texts`` different texts hash lowest, all of them where there
    are fewer; equal texts count once.  So every label with a letter in any text is in the model, and
    its table grows with their number: 2**BITS cells each.
    """
    small_batches(labelled.sparkSession)
    known = labelled.select("text", "lang", F.xxhash64("text").alias("_hash"))
    # Other texts have no trigram and would take a language's places in vain.
    known = known.filter(F.col("lang").isNotNull() & F.col("text").rlike(_HAS_LETTER))
    sizes = known.select("lang", "_hash").distinct().groupBy("lang").agg(F.count("*").alias("n")).collect()
    languages = sorted(row.lang for row in sizes)
    counts = np.zeros((len(languages), 1 << BITS))
    if not languages:
        return LanguageModel(languages, counts)
    bounds = F.create_map(*[F.lit(x) for row in sizes for x in (row.lang, int(min(1.0, sample_texts / row.n) * (1 << 30)))])
    sample = known.filter(F.pmod("_hash", F.lit(1 << 30)) < F.element_at(bounds, F.col("lang")))
    sample = sample.dropDuplicates(["lang", "_hash"]).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            grams, counts = _grams(texts(batch.column("text")))
            langs = batch.column("lang").to_pylist()
            names = sorted(set(langs))
            owner = np.repeat(np.array([names.index(x) for x in langs]), counts)
            table = np.bincount((owner << BITS) + grams, minlength=len(names) << BITS).reshape(len(names), -1)
            for name, row in zip(names, table, strict=True):
                sums[name] = sums.get(name, 0) + row
        for name, row in sums.items():
            some = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(some)), pa.array(some, pa.int32()), pa.array(row[some], pa.int64())], ["lang", "bucket", "n"]
            )

    cells = sample.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # At most 2**BITS cells a language.
    found = cells.toArrow()
    place = pc.index_in(found.column("lang"), pa.array(languages)).to_numpy()
    counts[place, found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return LanguageModel(languages, counts)


def _smoothed(counts: Column, above: Column) -> Column:
    """Shares of ``counts`` as if STRENGTH more rows had followed the shares ``above``."""
    whole = F.aggregate(counts, F.lit(0.0), lambda total, x: total + x)
    return F.zip_with(counts, above, lambda n, p: (n + p * STRENGTH) / (whole + STRENGTH))


def _evidence(rows: DataFrame, model: LanguageModel, kept: list[str]) -> DataFrame:
    """The ``kept`` columns with log likelihoods, trigrams and the text's own favourite."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ahead, counts = model(texts(batch.column("text")))
            best = np.where(counts > 0, ahead.argmax(1), -1)
            found = [pa.array(ahead.tolist(), pa.list_(pa.float64())), pa.array(counts), pa.array(best, pa.int32())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *found], [*kept, "_ahead", "_n", "_best"])

    added = T.StructType().add("_ahead", T.ArrayType(T.DoubleType())).add("_n", T.LongType()).add("_best", T.IntegerType())
    return rows.mapInArrow(weigh, T.StructType([rows.schema[c] for c in kept] + added.fields))


def identify(rows: DataFrame, keep: str, model: LanguageModel) -> DataFrame:
    """``keep``, lang, posterior, declared, host, n_grams and rejected for every row.

    ``rows`` has a column to keep, ``text``, ``declared`` (a language tag or NULL), ``host``
    and ``suffix``.  A missing or unknown tag says nothing; rows without a host
    share one prior, that of their suffix.  A NULL or empty text is rejected, with the
    language the other evidence favours.  Repeated rows are judged each; an empty table
    gives no rows; without any language in the model all rows are rejected and lang is NULL.
    """
    small_batches(rows.sparkSession)
    size = len(model.languages)
    tag = F.lower(F.regexp_extract(F.coalesce("declared", F.lit("")), r"^\s*([A-Za-z]+)", 1))
    rows = rows.select(
        F.col(keep).alias("_kept"),
        "text",
        "declared",
        tag.alias("_tag"),
        F.coalesce("host", F.concat(F.lit("?"), F.coalesce("suffix", F.lit("")))).alias("_host"),
        F.coalesce("suffix", F.lit("")).alias("_suffix"),
        "host",
    )
    kept = F.col("_kept").alias(keep)
    if not size:
        nothing = [F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("posterior")]
        return rows.select(kept, *nothing, "declared", "host", F.lit(0).cast("bigint").alias("n_grams"), F.lit(True).alias("rejected"))

    each = F.array(*[F.count_if(F.col("_best") == k).cast("double") for k in range(size)])
    sums = F.array(*[F.sum(F.col("_counts")[k]) for k in range(size)])
    first = _evidence(rows, model, ["_tag", "_host", "_suffix"])
    counted = staged(first.groupBy("_host", "_suffix", "_tag").agg(each.alias("_counts")), "language-counts")

    # Declared languages: one row for each language of the model.
    tags = F.array(*map(F.lit, model.languages))
    matrix = np.full((size, size), _DECLARED_EACH)
    for row in counted.filter(F.col("_tag").isin(model.languages)).groupBy("_tag").agg(sums.alias("n")).collect():
        matrix[model.languages.index(row["_tag"])] += row["n"]
    declared = np.log(matrix / matrix.sum(0))  # of a true language, how it is declared
    by_tag = F.array(*map(constant, [*declared.tolist(), [0.0] * size]))

    top = np.array([n or 0.0 for n in counted.agg(sums).first()[0]]) + 1.0
    top = F.array(*map(F.lit, (top / top.sum()).tolist()))
    suffixes = counted.groupBy("_suffix").agg(sums.alias("_counts"))
    suffixes = suffixes.select("_suffix", _smoothed(F.col("_counts"), top).alias("_above"))
    hosts = counted.groupBy("_host", "_suffix").agg(sums.alias("_counts")).join(suffixes, "_suffix")
    prior = _smoothed(F.col("_counts"), F.col("_above")).alias("_prior")
    hosts = staged(hosts.select("_host", "_suffix", prior), "language-hosts")

    place = F.array_position(tags, F.col("_tag")).cast("int")
    said = F.element_at(by_tag, F.when(place > 0, place).otherwise(size + 1))
    seen = _evidence(rows, model, ["_kept", "declared", "_tag", "_host", "_suffix", "host"])
    joined = seen.join(hosts, ["_host", "_suffix"]).withColumn("_said", said)
    score = F.transform(
        F.arrays_zip("_ahead", "_said", "_prior"), lambda x: x["_ahead"] * TEMPER + x["_said"] + F.log(x["_prior"])
    )
    scored = joined.withColumn("_score", score).withColumn("_most", F.array_max("_score"))
    total = F.aggregate(F.transform("_score", lambda s: F.exp(s - F.col("_most"))), F.lit(0.0), lambda t, x: t + x)
    at = F.array_position("_score", F.col("_most")).cast("int")
    scored = scored.select("*", (1 / total).alias("posterior"), at.alias("_at"))
    chance = F.element_at("_ahead", F.col("_at")) <= 0
    rejected = (F.col("_n") == 0) | chance | (F.col("posterior") < LEAST_POSTERIOR)
    named = F.element_at(tags, F.col("_at")).alias("lang")
    return scored.select(kept, named, "posterior", "declared", "host", F.col("_n").alias("n_grams"), rejected.alias("rejected"))


def page_evidence(pages: DataFrame) -> DataFrame:
    """page_id, visible text, declared language, host and suffix of ``pages`` (page_id, url, html)."""
    markup = r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>"
    host = F.nullif(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    return pages.select(
        "page_id",
        F.regexp_replace("html", markup, " ").alias("text"),
        F.nullif(F.regexp_extract("html", r"""(?i)<html\b[^>]*?\blang\s*=\s*["']?([A-Za-z][A-Za-z0-9-]*)""", 1), F.lit("")).alias("declared"),
        host.alias("host"),
        F.substring_index(host, ".", -1).alias("suffix"),
    )


def keep_identified(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` (text, lang, source, ...) whose language is identified; ``lang`` becomes it.

    The declared language is ``lang`` and the host ``source``.  All other columns stay.
    """
    model = fit_language_model(docs)
    rows = docs.select(
        F.struct(*docs.columns).alias("_row"),
        "text",
        F.col("lang").alias("declared"),
        F.col("source").alias("host"),
        F.lit("").alias("suffix"),
    )
    found = identify(rows, "_row", model).filter(~F.col("rejected"))
    return found.select(*(F.col("lang") if c == "lang" else F.col("_row")[c].alias(c) for c in docs.columns))
