"""Drawing documents by how much more likely a target's word runs make them than the corpus.

Runs of words (n-grams) are hashed to buckets.  A bucket's gain is the log of its
smoothed share of the target's runs over that of the corpus's; a document's weight is the mean
gain of its runs.  A Gumbel number that depends on nothing but a seed and the
doc_id is added, and the documents of the highest scores are drawn: the exponential-race way of
sampling without replacement, in proportion to exp(weight).

Both passes over the texts, counting and weighing, intern a batch's runs in an open-addressed
table of NumPy arrays: places by xxhash64 with linear probing, equal bytes verified, and a bucket and a
count for each taken place.  A run's bucket is worked out once a batch, and
each occurrence only holds its place, by which counts are added and gains gathered.  What
leaves a task is one number a bucket, or one a document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import slices, table_bytes, texts
from tradewind.operators.ordinals import numbered
from tradewind.sources.shared import staged

BUCKETS = 10_000
#: Fewest and most words of a run.
RUNS = (1, 1)
SEED = 2024
PERCENT = 10
MIN_WORDS = 20
SCALE = 1000

_U = np.uint64
# Words hold ASCII digits and letters and whatever is not ASCII.
_OTHERS = bytes(b for b in range(128) if not (48 <= b <= 57 or 97 <= b <= 122))
_TO_SPACES = table_bytes(_OTHERS)
_WIDE = 64


class Interned:
    """The distinct byte runs of a buffer in an open-addressed table.

    ``slot`` has the place of each run; ``taken`` the places in use, ``owner`` the first run
    found for a place, ``bucket`` and ``count`` what the place holds.
    """

    def __init__(self, buffer: bytes, starts: np.ndarray, lengths: np.ndarray, buckets: int) -> None:
        self.data = np.frombuffer(buffer, np.uint8)
        self.starts, self.lengths = starts, lengths
        pieces = buffer.split(b" ") if buffer else []
        if len(pieces) != len(starts) or (lengths != np.fromiter(map(len, pieces), np.int64, len(pieces))).any():
            # Runs of several words: cut out one by one.
            pieces = [buffer[a:b] for a, b in zip(starts.tolist(), (starts + lengths).tolist())]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, pieces), _U, len(starts))
        size = 1 << max(4, int(2 * len(starts)).bit_length())
        self.owner = np.full(size, -1, np.int64)
        self.slot = np.zeros(len(starts), np.int64)
        self._place(hashes, size - 1)
        self.taken = np.flatnonzero(self.owner >= 0)
        self.count = np.bincount(self.slot, minlength=size)
        self.bucket = np.zeros(size, np.int64)
        firsts = self.owner[self.taken]
        crcs = map(zlib.crc32, map(pieces.__getitem__, firsts.tolist()))
        self.bucket[self.taken] = np.fromiter(crcs, np.int64, len(firsts)) % buckets

    def _place(self, hashes: np.ndarray, mask: int) -> None:
        waiting = np.arange(len(hashes))
        probe = (hashes & _U(mask)).astype(np.int64)
        while len(waiting):
            at = probe[waiting]
            free = self.owner[at] < 0
            # Of several that want a free place one gets it; the others then compare with it.
            self.owner[at[free]] = waiting[free]
            holder = self.owner[at]
            same = hashes[waiting] == hashes[holder]
            same[same] = self._equal(waiting[same], holder[same])
            self.slot[waiting[same]] = at[same]
            waiting = waiting[~same]
            probe[waiting] = (probe[waiting] + 1) & mask

    def _equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether runs hold the same bytes, pair by pair."""
        equal = self.lengths[a] == self.lengths[b]
        check = np.flatnonzero(equal & (a != b))
        lengths = self.lengths[a[check]]
        order = np.argsort(lengths, kind="stable")
        check, lengths = check[order], lengths[order]
        cuts = np.flatnonzero(np.concatenate(([True], lengths[1:] != lengths[:-1], [True]))) if len(check) else []
        for low, high in zip(cuts, cuts[1:]):
            length, here = int(lengths[low]), check[low:high]
            if length <= _WIDE:
                view = np.lib.stride_tricks.sliding_window_view(self.data, length)
                equal[here] = (view[self.starts[a[here]]] == view[self.starts[b[here]]]).all(1)
            else:
                for i in here:
                    x, y = self.starts[a[i]], self.starts[b[i]]
                    equal[i] = bool((self.data[x : x + length] == self.data[y : y + length]).all())
        return equal


def word_runs(cells: list[bytes | None], runs: tuple[int, int]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All words joined by one space; start, length and text of each run of words; words of each text."""
    joined = [b" ".join((t or b"").lower().translate(_TO_SPACES).split()) for t in cells]
    words = np.array([t.count(b" ") + 1 if t else 0 for t in joined], np.int64)
    buffer = b" ".join(t for t in joined if t)
    gaps = np.flatnonzero(np.frombuffer(buffer, np.uint8) == 32)
    first = np.concatenate(([0], gaps + 1)) if buffer else np.zeros(0, np.int64)
    last = np.concatenate((gaps, [len(buffer)])) if buffer else first
    owner = np.repeat(np.arange(len(cells)), words)
    starts, lengths, owners = [], [], []
    for width in range(runs[0], runs[1] + 1):
        many = max(0, len(first) - width + 1)
        whole = owner[:many] == owner[width - 1 :][:many]
        starts.append(first[:many][whole])
        lengths.append(last[width - 1 :][:many][whole] - starts[-1])
        owners.append(owner[:many][whole])
    return buffer, np.concatenate(starts), np.concatenate(lengths), np.concatenate(owners), words


def bucket_counts(docs: DataFrame, runs: tuple[int, int] = RUNS, buckets: int = BUCKETS) -> DataFrame:
    """bucket and n, the occurrences of its runs in all texts of ``docs``; buckets without any are left out.

    NULL and empty texts have no runs; repeated rows count each time.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches, "text"):
            buffer, starts, lengths, _, _ = word_runs(texts(batch.column("text")), runs)
            held = Interned(buffer, starts, lengths, buckets)
            np.add.at(total, held.bucket[held.taken], held.count[held.taken])
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    return docs.select("text").mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, runs: tuple[int, int] = RUNS, buckets: int = BUCKETS) -> np.ndarray:
    """Each bucket's gain in thousandths, rounded down: as many numbers as there are buckets, however large the tables."""

    def counted(frame: DataFrame) -> np.ndarray:
        found = bucket_counts(frame, runs, buckets).toArrow()
        out = np.zeros(buckets)
        out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
        return out

    corpus, wanted = counted(docs), counted(target)
    odds = (wanted + 1) * (corpus.sum() + buckets) / ((corpus + 1) * (wanted.sum() + buckets))
    return np.floor(SCALE * np.log(odds)).astype(np.int64)


def weighed(docs: DataFrame, gains: np.ndarray, runs: tuple[int, int] = RUNS) -> DataFrame:
    """doc_id, mark (digest of the text), n_words, n_features and weight of every row of ``docs``."""
    buckets = len(gains)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            buffer, starts, lengths, owners, words = word_runs(texts(batch.column("text")), runs)
            held = Interned(buffer, starts, lengths, buckets)
            features = np.bincount(owners, minlength=batch.num_rows)
            # Whole numbers far below 2^53: sums of doubles are exact.
            sums = np.bincount(owners, gains[held.bucket[held.slot]], batch.num_rows).astype(np.int64)
            means = np.where(features > 0, sums // np.maximum(features, 1), 0)
            columns = [batch.column("doc_id"), batch.column("mark"), *map(pa.array, (words, features, means))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "mark", "n_words", "n_features", "weight"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    read = docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("mark"), "text")
    return read.mapInArrow(weigh, f"doc_id {kind}, mark string, n_words bigint, n_features bigint, weight bigint")


def gumbel(doc_id: Column, seed: int) -> Column:
    """A standard Gumbel number in thousandths, rounded down, from the seed and the id alone."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / 2.0**32))).cast("bigint")


def importance_scores(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    runs: tuple[int, int] = RUNS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``docs`` (doc_id, text), and mark, its text's digest.

    ``target`` (text) stands for what is wanted.  Of the rows with ``min_words`` words or more the ``percent``
    hundredth with the highest scores is drawn and ranked from 1, ties to the smaller doc_id, then to
    fewer runs and the text's digest; the rank of all others is NULL.  NULL and empty texts have no runs and weigh 0.
    Rows without a doc_id share one random number and come last in ties; repeated rows
    are ranked each.  An empty ``docs`` gives no rows, an empty ``target`` makes all counts of it 0.  Other columns are not looked at.
    """
    gains = bucket_gains(docs, target, runs, buckets)
    scored = weighed(docs, gains, runs).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    scored = staged(scored, "resampling-scores")
    long_enough = F.col("n_words") >= min_words
    eligible = scored.filter(long_enough)
    drawn = eligible.count() * percent // 100
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("mark"))
    ranked = numbered(eligible, *order, position="rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = scored.filter(~long_enough).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank", "mark")


def draw(docs: DataFrame, target: DataFrame, **choices) -> DataFrame:
    """The drawn rows of ``docs``, all their columns as they are; choices and edge cases as in ``importance_scores``.

    Of rows equal in doc_id and text as many stay as were drawn.
    """
    drawn = importance_scores(docs, target, **choices).filter("rank IS NOT NULL")
    counts = drawn.groupBy(F.struct("doc_id", "mark").alias("_key")).agg(F.count("*").alias("_n"))
    # The row travels as one struct, so its columns' names meet no others.
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("_row"))
    mark = F.md5(F.coalesce("_row.text", F.lit("")))
    rows = rows.withColumn("_key", F.struct(F.col("_row.doc_id").alias("doc_id"), mark.alias("mark")))
    found = rows.join(counts, "_key")
    copies = found.withColumn("_copy", F.expr("row_number() OVER (PARTITION BY _key ORDER BY xxhash64(_row))"))
    return copies.filter("_copy <= _n").select("_row.*")
