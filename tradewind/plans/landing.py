"""Raw feeds and what they share, written once per session and folder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from threading import RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tradewind import schemas
from tradewind.sources import driver_tables
from tradewind.sources.shared import fresh_path

# Where a session has written a raw feed or what feeds share: (application, folder, name) -> (state of the files, path).
_LANDED: dict[tuple[str, str, str], tuple[str, str]] = {}
_LANDING: dict[tuple[str, str, str], RLock] = {}
_LANDING_LOCK = RLock()


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def state_of(spark: SparkSession, folder: str) -> str:
    """What the files of the driver's tables are by name, size and time, from their listing alone."""
    hadoop, found = spark._jvm.org.apache.hadoop.fs, []
    for table in driver_tables.SCHEMAS:
        path = hadoop.Path(f"{folder}/{table}.parquet")
        store = path.getFileSystem(spark._jsc.hadoopConfiguration())
        for entry in store.listStatus(path):
            found.append(f"{entry.getPath()} {entry.getLen()} {entry.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()


def kept_at(spark: SparkSession, folder: str, name: str, state: str, build: Callable[[], DataFrame]) -> str:
    """Where what ``build`` returns was written, once per session and state of the folder's files, and again if it is gone."""
    key = (spark.sparkContext.applicationId, folder, name)
    with _LANDING_LOCK:
        own = _LANDING.setdefault(key, RLock())
    with own:
        was, path = _LANDED.get(key, (None, None))
        if was == state and _exists(spark, path):
            return path
        path = fresh_path(spark, name)
        build().write.parquet(path)
        _LANDED[key] = (state, path)
        return path


def kept(spark: SparkSession, folder: str, name: str, state: str, schema: T.StructType, build: Callable[[], DataFrame]) -> DataFrame:
    return spark.read.schema(schema).parquet(kept_at(spark, folder, name, state, build))


def sharing_tables(spark: SparkSession, folder: str, state: str) -> driver_tables.DriverTables:
    """The driver's tables, where the join that several feeds are derived from is written once."""

    def shared(name: str, frame: DataFrame) -> DataFrame:
        return kept(spark, folder, name, state, frame.schema, lambda: frame)

    return driver_tables.DriverTables(spark, folder, shared)


def streamed(spark: SparkSession, folder: str, name: str, build: Callable[[driver_tables.DriverTables], DataFrame]) -> DataFrame:
    """A topic derived from the driver's tables: written once, then read as an unbounded file source."""
    state = state_of(spark, folder)
    records = build(sharing_tables(spark, folder, state))
    path = kept_at(spark, folder, name, state, lambda: records)
    return spark.readStream.schema(records.schema).parquet(path)


def landed(spark: SparkSession, folder: str, feed: str, strict: bool = False, state: str | None = None, written: bool = False) -> DataFrame:
    """A raw feed, derived from the driver's tables once per session.

    The raw layer is where the platform's own work starts; queries over the
    same folder share it instead of joining order lines to orders each time.  Feeds that only rewrite the rows of a
    table written already, one join of order lines for two of them, are read from there and not written again;
    the others, and those with ``written``, are.  What is written is renewed once the folder's files have changed or the copy is gone.
    """
    state = state or state_of(spark, folder)

    def build() -> DataFrame:
        return getattr(driver_tables, feed)(sharing_tables(spark, folder, state), strict)

    if feed in driver_tables.REWRITTEN and not written:
        return build()
    return kept(spark, folder, f"{feed}-strict" if strict else feed, state, schemas.RAW[feed], build)
