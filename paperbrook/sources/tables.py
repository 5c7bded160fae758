"""Tables on plain Parquet: a written snapshot is never changed, a new one goes to a new path."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from paperbrook.session import FREED, settings
from paperbrook.sources.schemas import TRACKING


def read_table(spark: SparkSession, name_or_path: str, schema: T.StructType | None = None) -> DataFrame:
    """A catalog table by name, or a Parquet folder by path."""
    if "/" not in name_or_path:
        return spark.read.table(name_or_path)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(name_or_path)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def empty_tracking(spark: SparkSession) -> DataFrame:
    """The tracking table before the first run."""
    return empty(spark, TRACKING)


def table_or_empty(spark: SparkSession, name_or_path: str, schema: T.StructType) -> DataFrame:
    """The table, or no rows when nothing has been written yet."""
    if "/" not in name_or_path:
        return spark.read.table(name_or_path) if spark.catalog.tableExists(name_or_path) else empty(spark, schema)
    try:
        return spark.read.schema(schema).parquet(name_or_path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return empty(spark, schema)
        raise


def write_snapshot(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write to a path nobody reads yet and hand back the written rows, which cuts the lineage."""
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with settings(df.sparkSession, FREED):
        writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed_table(spark: SparkSession, folder: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """A folder that :func:`write_bucketed` has written, named to this session so that joins on ``key`` know its buckets."""
    name = f"bucketed_{uuid.uuid4().hex}"
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"create table {name} ({fields}) using parquet clustered by (`{key}`) sorted by (`{key}`) into {buckets} buckets location '{folder}'"
    )
    return spark.table(name)


def write_bucketed(df: DataFrame, folder: str, key: str, buckets: int, dealt: bool = False) -> DataFrame:
    """Write a table in buckets by a hash of ``key``, sorted within them, and hand back the written rows.

    A join or merge on the key then leaves this side where it is. ``dealt`` says that the rows come dealt out by the
    key into as many partitions, as they do from a join with such a table; they are not moved again.
    """
    rows = df if dealt else df.repartition(buckets, key)
    name = f"bucketed_{uuid.uuid4().hex}"
    with settings(df.sparkSession, FREED):
        rows.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", folder).saveAsTable(name)
    return df.sparkSession.table(name)


# A scan of more splits than this is never moved, however many slots there are.
SMALL_SCAN = 64


def balance(df: DataFrame) -> DataFrame:
    """Spread a small scan that has fewer splits than the session has task slots; any larger scan stays as it is.

    Only for a plain scan ahead of CPU-bound work: one file with one row group would keep one core busy.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < min(slots, SMALL_SCAN) else df
