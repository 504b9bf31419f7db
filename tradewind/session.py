"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Timestamps arrive without a zone and are read as UTC.  Skewed join keys are
# split at run time even where the split costs one more shuffle: a key holding
# a third of the rows would cost far more in one task.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Narrow rows are few bytes: a small load is still spread over the cores.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    # A task's rows must fit its memory when they are sorted, and text read from columns grows twentyfold and more.
    # Written files are as large as the partitions they come from, and no scan splits them below that.
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.parquet.compression.codec": "zstd",
    # Streaming state lives on the executors' disks, not in their heaps.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

_FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: Partitions a shuffle starts with, unless the session has more; adaptive execution merges what turns out small.
LEAST_FIRST_PARTITIONS = 256


def configure(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to a session somebody else created."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    if spark.conf.get(_FIRST_PARTITIONS, None) is None:
        spark.conf.set(_FIRST_PARTITIONS, str(max(LEAST_FIRST_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    return spark


def local_session(name: str, cores: str = "8", memory: str = "12g") -> SparkSession:
    """Session for tests and benches on one machine; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores) if cores != "*" else "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
