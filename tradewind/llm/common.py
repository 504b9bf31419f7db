"""What the text operators share: words, tables, bounded lets, arrays in cells."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word is a run of anything but these six ASCII white spaces,
# which are also those bytes.split() splits at.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"

_BATCH_ROWS = 256
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where the installed package of public vocabularies keeps one."""
    import public_tokenizers

    return public_tokenizers.path(name)


def small_batches(spark: SparkSession) -> None:
    """Texts are long: keep the rows handed to Python at a time few."""
    if spark.conf.get(_BATCH_SETTING) != str(_BATCH_ROWS):
        spark.conf.set(_BATCH_SETTING, str(_BATCH_ROWS))


def buckets(spark: SparkSession, per_partition: int = 4) -> int:
    """Number of hash buckets, a few for each shuffle partition of the session."""
    return per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))


def n_words(text: Column) -> Column:
    """Words of a text as long; NULL counts none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once a row, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def constant(numbers: list[float]) -> Column:
    """A literal array of doubles, for tables of a fixed size."""
    return F.split(F.lit(",".join(map(repr, numbers))), ",").cast("array<double>")


def texts(column: pa.Array) -> list[bytes | None]:
    """The cells of a string column as UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


def table_bytes(separators: bytes) -> bytes:
    """A table for ``bytes.translate`` that turns separators to spaces."""
    return bytes(32 if b in separators else b for b in range(256))


def cell(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array).tobytes()


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 8 << 20, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, and of ``limit`` bytes in ``column`` unless one row holds more.

    Spark bounds the bytes of what it hands over; this bounds what a task makes of it, by no session setting.
    """
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column).cast(pa.large_binary())), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = int(np.searchsorted(ends, before + limit, side="right"))
            end = min(max(end, start + 1), start + rows, batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def grouped(rows: Iterator[tuple], size: Callable[[tuple], int], limit: int) -> Iterator[list[tuple]]:
    """Lists of rows of about ``limit`` in size; a larger row has a list of its own."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row)
        if total >= limit:
            yield held
            held, total = [], 0
    if held:
        yield held
