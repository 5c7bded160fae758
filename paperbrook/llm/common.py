"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperbrook.session import FREED, new_run_folder, settings

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# What one broadcast may hold, in bytes of its rows; more goes out in several blocks, one scan each.
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """The rows, written to the shared folder and read back: lineage ends there and the planner knows the size."""
    path = new_run_folder(df.sparkSession, label)
    with settings(df.sparkSession, FREED):
        df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else as it is; null gives the empty string.

    The general mapping is slow, so texts of one byte per character take the plain function.
    """
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def blocks(df: DataFrame, key: str, row_bytes: int) -> list[DataFrame]:
    """The rows in as many parts, by a hash of ``key``, as keep each part below ``BROADCAST_BYTES``."""
    parts = 1 + df.count() * row_bytes // BROADCAST_BYTES
    if parts == 1:
        return [df]
    return [df.where(F.pmod(F.xxhash64(key), F.lit(parts)) == part) for part in range(parts)]


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


ROW = ["_row_file", "_row_number"]
# Decisions that are sent to every task at most, and the bytes one takes there.
DECISION_BYTES = 64


def with_rows(docs: DataFrame) -> DataFrame:
    """The rows with a key of their own, ``_row_file`` and ``_row_number``: a hash of their file and their number in it.

    Rows of files keep it however often they are read. Others are written first.
    """
    key = [F.xxhash64("_metadata.file_path").alias("_row_file"), F.col("_metadata.row_index").alias("_row_number")]
    try:
        return docs.select("*", *key)
    except AnalysisException:
        return written(docs, "rows").select("*", *key)


def without(rows: DataFrame, gone: DataFrame, label: str) -> DataFrame:
    """The rows of :func:`with_rows` whose keys are not among ``gone``, without their keys.

    The keys are written and counted. Up to ``BROADCAST_BYTES`` of them go to every task, so no text is moved; beyond,
    rows and keys meet by a merge.
    """
    gone = written(gone.select(*ROW).distinct(), label)
    few = gone.count() * DECISION_BYTES <= BROADCAST_BYTES
    return rows.join(F.broadcast(gone) if few else gone.hint("merge"), ROW, "left_anti").drop(*ROW)


def slices(count: int, size: int) -> Iterator[slice]:
    return (slice(at, at + size) for at in range(0, count, size))
