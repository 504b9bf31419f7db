"""Where a job may leave files other executors and later jobs must see."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_APP = "tradewind"


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    A session on one machine without the setting gets a fresh folder of its
    own; a cluster without it is refused, as its machines share no folder.
    """
    folder = spark.conf.get(_SETTING, None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set(_SETTING, folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{_APP}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write once, go on from the written copy: cuts lineage and reuses work."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
