"""Sets of word shingles as 64-bit numbers, for many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import slices

WIDTH = 5
_U = np.uint64
# Odd multipliers, one for each place in a shingle; the last sets short texts apart by length.
_PLACES = [_U(xxhash.xxh3_64_intdigest(b"place%d" % i) | 1) for i in range(WIDTH + 1)]


def mix(x: np.ndarray) -> np.ndarray:
    """A well-mixed permutation of 64-bit numbers (the murmur finaliser)."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lower-cased words, and how many each text has."""
    return hashes_of([(t or b"").lower().split() for t in texts])


def hashes_of(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The same of texts that are split already."""
    counts = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(words)), _U, int(counts.sum()))
    return flat, counts


def shingle_sets(texts: list[bytes | None], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """The texts' distinct shingles of ``width`` words, five at most, text by text in rising order, and each set's size.

    A text of fewer words than a shingle has its whole sequence as one; a text
    without words, or NULL, has none.
    """
    flat, counts = word_hashes(texts)
    owner = np.repeat(np.arange(len(texts)), counts)
    last = len(flat) - width + 1
    parts, owners = [], []
    if last > 0:
        rolled = flat[:last] * _PLACES[0]
        for place in range(1, width):
            rolled = rolled + flat[place : place + last] * _PLACES[place]
        whole = owner[:last] == owner[width - 1 :]
        parts.append(mix(rolled[whole]))
        owners.append(owner[:last][whole])
    starts = np.concatenate(([0], np.cumsum(counts)))
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        places = np.array(_PLACES, _U)
        codes = [(flat[starts[i] : starts[i + 1]] * places[: counts[i]]).sum(dtype=_U) for i in short]
        parts.append(mix(np.array(codes, _U) + places[WIDTH] * counts[short].astype(_U)))
        owners.append(short)
    if not parts:
        return np.zeros(0, _U), np.zeros(len(texts), np.int64)
    codes, owner = np.concatenate(parts), np.concatenate(owners)
    order = np.lexsort((codes, owner))
    codes, owner = codes[order], owner[order]
    first = np.ones(len(codes), bool)
    first[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
    codes, owner = codes[first], owner[first]
    return codes, np.bincount(owner, minlength=len(texts))


def set_marks(codes: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """128 bits that stand for each set, in whatever order its members come; empty for an empty set."""
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    full = sizes > 0
    out = [b""] * len(sizes)
    if full.any():
        one = np.add.reduceat(mix(codes + _PLACES[0]), starts[full])
        two = np.add.reduceat(mix(codes + _PLACES[1]), starts[full])
        marks = np.stack([mix(one + sizes[full].astype(_U)), two], axis=1)
        for place, mark in zip(np.flatnonzero(full), marks, strict=True):
            out[place] = mark.tobytes()
    return out


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (u, v) whose exact sets (ref, members) overlap enough."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "one"):
            keep = []
            for a, b in zip(batch.column("one"), batch.column("two")):
                a, b = np.frombuffer(a.as_buffer(), _U), np.frombuffer(b.as_buffer(), _U)
                low, high = sorted((len(a), len(b)))
                both = len(np.intersect1d(a, b, assume_unique=True)) if 100 * low >= percent * high else 0
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    one = sets.select(F.col("ref").alias("u"), F.col("members").alias("one"))
    two = sets.select(F.col("ref").alias("v"), F.col("members").alias("two"))
    # By ``v`` first: of a hot center only the own set is moved to all its pairs.
    return pairs.join(two, "v").join(one, "u").mapInArrow(confirm, "u bigint, v bigint")
