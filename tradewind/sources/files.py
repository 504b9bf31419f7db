"""Reading and writing layers as files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind import fixed_values as fixed

SNAPSHOT_DAY = "ingest_date"
#: An array file is read by one task, so it stays this small however many rows there are.  Spark fetches each number
#: that the schema takes as text from its place in the file, about 12 KB a time, so a task reads far more than the file.
ROWS_PER_ARRAY_FILE = 5_000
WRITE_MODES = {"replace": "overwrite", "append": "append"}


def read_layer(spark: SparkSession, root: str, layer: str, table: str, schema: T.StructType | None = None) -> DataFrame:
    """A layer's table; a missing or unreadable one raises instead of reading as empty."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{root}/{layer}/{table}")


def read_jdbc(spark: SparkSession, url: str, table: str, split_column: str, bounds: tuple, partitions: int, **options: str) -> DataFrame:
    """A database table read in parallel ranges of ``split_column``; filters and columns are pushed down."""
    lower, upper = bounds
    split = {"partitionColumn": split_column, "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(partitions)}
    return spark.read.format("jdbc").options(url=url, dbtable=table, **split, **options).load()


def read_bronze_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header; quotes inside a field are doubled, as in a JSON column."""
    return spark.read.schema(schema).options(header=True, quote='"', escape='"').csv(path)


def write_bronze_csv(df: DataFrame, path: str, mode: str = "replace") -> None:
    keep_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode(WRITE_MODES[mode]).options(header=True, quote='"', escape='"', **keep_blanks).csv(path)


def read_bronze_json(spark: SparkSession, path: str, schema: T.StructType, array_files: bool = True) -> DataFrame:
    """One JSON array per file; ``array_files=False`` reads one object per line.

    An array file cannot be split, so feed many files rather than one large one.
    Numbers and strings both arrive as text where the schema says text.
    """
    return spark.read.schema(schema).option("multiLine", array_files).json(path)


def array_files(rows: int, least: int) -> int:
    """How many array files ``rows`` rows take: ``least``, or more where those would hold too many rows each."""
    return max(least, -(-rows // ROWS_PER_ARRAY_FILE))


def write_bronze_json(df: DataFrame, path: str, unique_id: str, files: int) -> None:
    """Write ``files`` JSON arrays, rows spread over them by a unique id.

    A file's rows are written as lines in the order of the id, the first behind
    an opening and the last before a closing bracket; no array is gathered.
    """
    bucket = F.pmod(F.xxhash64(unique_id), F.lit(files))
    rows = df.select(bucket.alias("file"), F.col(unique_id).alias("_id"), F.to_json(F.struct(*df.columns)).alias("line"))
    placed = Window.partitionBy("file").orderBy("_id")
    first, last = F.lag("_id").over(placed).isNull(), F.lead("_id").over(placed).isNull()
    text = F.concat(F.when(first, "[").otherwise(","), "line", F.when(last, "]").otherwise(""))
    rows.select("file", text.alias("value")).write.mode("overwrite").partitionBy("file").text(path)


def write_layer(df: DataFrame, root: str, layer: str, table: str, if_exists: str = "replace") -> None:
    df.write.mode(WRITE_MODES[if_exists]).parquet(f"{root}/{layer}/{table}")


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write a catalog table divided by ``key``; joins and counts on the key need no shuffle then.

    Rows are brought to their bucket first, so a bucket is one file.  That suits
    a key without hot values: a bucket can not be split at run time.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def write_lake_snapshot(df: DataFrame, root: str, layer: str, table: str, day: Column) -> None:
    """Write the rows under their ``ingest_date``; only the days present are replaced.

    Rows are not moved to one task per day: a day's files come from the tasks
    that hold its rows.
    """
    (
        df.withColumn(SNAPSHOT_DAY, day.cast("date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(SNAPSHOT_DAY)
        .parquet(f"{root}/{layer}/{table}")
    )


def stamp_bronze(df: DataFrame, table: str, loaded_at: Column | None = None) -> DataFrame:
    """Add the feed's origin and load time where the feed has none."""
    moment = F.current_timestamp() if loaded_at is None else loaded_at
    stamps = {"source_system": F.lit(fixed.SOURCE_SYSTEMS[table]), "ingested_at": moment}
    present = set(df.columns)
    return df.withColumns({c: F.coalesce(F.col(c), v) if c in present else v for c, v in stamps.items()})


def materialize(
    spark: SparkSession,
    name: str,
    build: Callable[..., DataFrame],
    *refs: DataFrame,
    root: str | None = None,
) -> DataFrame:
    """A model over other models: a view by default, a written table with ``root``."""
    model = build(*refs)
    if root is None:
        model.createOrReplaceTempView(name)
        return spark.table(name)
    write_layer(model, root, "models", name)
    return read_layer(spark, root, "models", name, model.schema)
