"""A keyed table kept by merging: a log of changes, snapshots of it, and a pointer to the newest one.

Each batch of a stream appends its changes to ``log/batch_id=n``.  Compacting merges the snapshot that the pointer names with
the batches logged since, writes the result as the next version and only then writes
that version's pointer.  Readers take the newest pointer's snapshot and the batches after it, so what they read is bounded
by the keys alive and the batches not yet compacted, and a run that is cut half-way leaves the old version as it was.

Rows marked ``ended`` leave the snapshot for ``ended/version=n``, where history can be asked for.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructType

from tradewind.operators.dedup import latest_per_key

KEY, BATCH = "entity_id", "batch_id"
_POINTER = "upto bigint, version bigint"


def _read(spark: SparkSession, schema: StructType | str, path: str) -> DataFrame | None:
    """A written table, or None where nothing is yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as gone:
        if gone.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def pointer(spark: SparkSession, root: str) -> tuple[int, int]:
    """(version, last batch in it) of the newest whole snapshot; (0, -1) before the first."""
    found = _read(spark, _POINTER, f"{root}/pointers")
    newest = found.orderBy(F.desc("version")).first() if found is not None else None
    return (newest.version, newest.upto) if newest else (0, -1)


def _parts(spark: SparkSession, root: str, schema: StructType) -> tuple[int, int, DataFrame]:
    """The version pointed to, its last batch, and its rows with those logged since."""
    version, upto = pointer(spark, root)
    with_batch = StructType(list(schema.fields)).add(BATCH, LongType())
    empty = spark.createDataFrame([], with_batch)
    log = _read(spark, with_batch, f"{root}/log")
    # The batch is the folder's name: Spark opens no file of an older one.
    rows = log.filter(F.col(BATCH) > upto) if log is not None else empty
    base = _read(spark, with_batch, f"{root}/snapshots/version={version}") if version else None
    return version, upto, rows.unionByName(base) if base is not None else rows


def read_entities(spark: SparkSession, root: str, schema: StructType, history: bool = False) -> DataFrame:
    """The last row of each living key; with ``history`` also of keys that have ended.

    ``schema`` is that of the changes, ``ended`` included.
    """
    version, _, rows = _parts(spark, root, schema)
    if history and version:
        past = _read(spark, StructType(list(schema.fields)).add(BATCH, LongType()).add("version", LongType()), f"{root}/ended")
        if past is not None:
            rows = rows.unionByName(past.filter(F.col("version") <= version).drop("version"))
    newest = latest_per_key(rows, [KEY], BATCH).drop(BATCH)
    return newest if history else newest.filter("NOT ended")


def compact(spark: SparkSession, root: str, schema: StructType) -> int:
    """Merge the log into the next snapshot and point to it; returns the version pointed to.

    Without batches since the last snapshot nothing is written.
    """
    version, upto, rows = _parts(spark, root, schema)
    last = rows.agg(F.max(BATCH)).first()[0]
    if last is None or last <= upto:
        return version
    newest, target = latest_per_key(rows, [KEY], BATCH), version + 1
    newest.filter("NOT ended").write.mode("overwrite").parquet(f"{root}/snapshots/version={target}")
    newest.filter("ended").write.mode("overwrite").parquet(f"{root}/ended/version={target}")
    _point(spark, root, target, last)
    return target


def _point(spark: SparkSession, root: str, version: int, upto: int) -> None:
    row = spark.createDataFrame([(upto,)], "upto bigint")
    row.coalesce(1).write.mode("overwrite").parquet(f"{root}/pointers/version={version}")


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete snapshots and pointers older than the ``keep`` newest and log batches within all of those; returns what went.

    Keep as many versions as readers may still be reading.
    """
    known = _read(spark, _POINTER, f"{root}/pointers")
    kept = [] if known is None else known.orderBy(F.desc("version")).limit(keep).collect()
    if len(kept) < keep:
        return []
    oldest, upto = kept[-1].version, kept[-1].upto
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = []
    for folder, below in ((f"{root}/log", upto + 1), (f"{root}/snapshots", oldest), (f"{root}/pointers", oldest)):
        at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        for entry in store.listStatus(at) if store.exists(at) else []:
            name = entry.getPath().getName()
            if "=" in name and int(name.split("=")[1]) < below:
                store.delete(entry.getPath(), True)
                gone.append(f"{folder}/{name}")
    return gone


def write_changes(changes: DataFrame, root: str, checkpoint: str, compact_every: int | None = None) -> StreamingQuery:
    """Log each batch's changes; a batch run twice replaces its own folder.  Every ``compact_every`` batches the log is merged."""
    schema = changes.schema

    def log(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/log/{BATCH}={batch_id}")
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact(batch.sparkSession, root, schema)

    return (
        changes.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(log).start()
    )
