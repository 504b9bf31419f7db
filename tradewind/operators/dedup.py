"""One row per key.

Both operators number the rows of a key and keep number one.  Spark turns
``row_number() = 1`` into a group limit that already runs before the shuffle,
so a task sends at most one row per key and a key holding a third of the table
costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tradewind.sources.shared import staged

_RANK, _FOLDER = "_rank_in_key", "key_folder"


def _first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def dedup_keep_first(df: DataFrame, keys: Sequence[str], arrival: Sequence[str] = ()) -> DataFrame:
    """Earliest row of each key by the ``arrival`` columns; NULL keys count as one key.

    Distributed rows have no read order, so the remaining columns break ties:
    the survivor is the same however the rows are partitioned.  Select the
    columns you need first, as all of them travel with the shuffle.
    """
    ties = [c for c in df.columns if c not in keys and c not in arrival]
    return _first_per_key(df, keys, [F.col(c).asc_nulls_first() for c in [*arrival, *ties]])


def latest_per_key(df: DataFrame, keys: Sequence[str], moment: str) -> DataFrame:
    """Newest row of each key; among equally new rows the greatest one."""
    ties = [c for c in df.columns if c not in keys and c != moment]
    return _first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in [moment, *ties]])


class FirstArrivals:
    """A written table of the first row of each key that later loads are merged into.

    Rows lie in folders by a hash of their key.  A load reads and rewrites only the folders that its own keys
    fall into, so its cost follows the load, and the table is what ``dedup_keep_first`` makes of all loads at
    once, in whatever order they come.  A load merged twice changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], arrival: Sequence[str], folders: int):
        self.spark, self.path, self.schema = spark, path, schema
        self.keys, self.arrival, self.folders = list(keys), list(arrival), folders

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(_FOLDER, F.pmod(F.xxhash64(*self.keys), F.lit(self.folders)).cast("int"))

    def _stored(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(StructType([*self.schema.fields, StructField(_FOLDER, IntegerType())])).parquet(self.path)
        except AnalysisException as gone:
            if gone.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def touched(self, load: DataFrame) -> DataFrame | None:
        """Stored rows of the folders that a load's keys fall into."""
        stored = self._stored()
        if stored is None:
            return None
        # As many numbers as there are folders at most.
        folders = [r[0] for r in self._placed(load).select(_FOLDER).distinct().collect()]
        return stored.filter(F.col(_FOLDER).isin(folders))

    def merge(self, load: DataFrame) -> None:
        """``load`` must give the same rows each time it is read: pass a written table."""
        known, rows = self.touched(load), self._placed(load.select(*self.schema.fieldNames()))
        both = rows if known is None else known.unionByName(rows)
        # Kept apart until whole: the folders that are read are the ones replaced.
        merged = staged(dedup_keep_first(both, [*self.keys, _FOLDER], self.arrival), "merged")
        writer = merged.repartition(F.col(_FOLDER)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(_FOLDER).parquet(self.path)

    def rows(self) -> DataFrame:
        stored = self._stored()
        return self.spark.createDataFrame([], self.schema) if stored is None else stored.drop(_FOLDER)


def require_key(df: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key columns are all present; unlike ``dropna`` this reaches the file scan."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df
