"""Differences of two large snapshots by digest trees, so that parts without a change are never read.

A snapshot is written in folders by a hash of one column, with a hash of every row beside it. The digest of a folder
is a number of rows, an exclusive or and two sums of the rows' hashes: they hang on the rows and not on their order or
files, and digests of folders add up to those of groups of folders. Trees of two snapshots are compared from the root;
below equal nodes nothing is looked at, and only rows of unequal folders are joined.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperbrook.functions.ids import salt
from paperbrook.operators.chunk_store import change_feed
from paperbrook.sources.tables import write_snapshot

# Folders of a snapshot and children of a node: both powers of two, so that a node's number is a shift of its folder's.
BUCKETS, FANOUT_BITS = 256, 4
SUMS = ["n", "mixed", "low", "high"]
HASH, BUCKET = "_row_hash", "_bucket"


@dataclass(frozen=True)
class Snapshot:
    """A written table in folders by a hash of ``by``, and the digests of its folders."""

    spark: SparkSession
    folder: str
    by: str
    buckets: int
    schema: T.StructType

    def rows(self, buckets: list[int] | None = None) -> DataFrame:
        """All rows, or those of the given folders; others are not opened."""
        rows = self.spark.read.schema(self.schema).parquet(f"{self.folder}/rows")
        if buckets is not None:
            rows = rows.where(F.col(BUCKET).isin(buckets)) if buckets else rows.limit(0)
        return rows.drop(HASH, BUCKET)

    def tree(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/tree")


def row_hash(columns: list[str]) -> Column:
    """Of all columns, nulls told from values: which columns are null is part of it."""
    nulls = F.concat(*(F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns))
    return F.xxhash64(nulls, *columns)


def leaf_digests(rows: DataFrame) -> DataFrame:
    """(level 0, node, n, mixed, low, high) of each folder, from (_bucket, _row_hash)."""
    again = F.xxhash64(HASH, F.lit("again"))
    return rows.groupBy(F.col(BUCKET).cast("int").alias("node")).agg(
        F.count("*").alias("n"), F.bit_xor(HASH).alias("mixed"),
        F.sum(again.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"), F.sum(F.shiftrightunsigned(again, 32)).alias("high"),
    ).select(F.lit(0).alias("level"), "node", *SUMS)


def digest_tree(leaves: DataFrame, buckets: int, fanout_bits: int = FANOUT_BITS) -> DataFrame:
    """The digests of all levels up to the root; a node's digest is made of its children's."""
    found, level = leaves, 0
    while buckets > 1 << (fanout_bits * level):
        level += 1
        node = F.shiftright("node", fanout_bits * level).alias("node")
        sums = [F.bit_xor(c).alias(c) if c == "mixed" else F.sum(c).alias(c) for c in SUMS]
        found = found.unionByName(leaves.groupBy(node).agg(*sums).select(F.lit(level).alias("level"), "node", *SUMS))
    return found


def write_digested(df: DataFrame, folder: str, by: str = "path", buckets: int = BUCKETS, fanout_bits: int = FANOUT_BITS) -> Snapshot:
    """Write a snapshot by ``by``: rows that change together should agree in it, and rows of one key must.

    The hash of each row is written along, so the digests come from one narrow column.
    """
    if buckets & (buckets - 1):
        raise ValueError(f"the number of folders is to be a power of two: {buckets}")
    spark = df.sparkSession
    rows = df.withColumn(HASH, row_hash(df.columns)).withColumn(BUCKET, salt(F.col(by), buckets))
    written = write_snapshot(rows.repartition(BUCKET), f"{folder}/rows", [BUCKET])
    write_snapshot(digest_tree(leaf_digests(written), buckets, fanout_bits), f"{folder}/tree")
    return Snapshot(spark, folder, by, buckets, written.schema)


def unequal_buckets(old: Snapshot, new: Snapshot, fanout_bits: int = FANOUT_BITS) -> list[int]:
    """Folders whose rows differ. Each step looks at the children of unequal nodes only; nodes are at most the folders."""
    if (old.by, old.buckets) != (new.by, new.buckets):
        raise ValueError(f"snapshots are cut differently: {old.by} in {old.buckets}, {new.by} in {new.buckets}")
    both = old.tree().withColumn("side", F.lit(0)).unionByName(new.tree().withColumn("side", F.lit(1)))
    top = 0
    while old.buckets > 1 << (fanout_bits * top):
        top += 1
    nodes = [0]
    for level in range(top, -1, -1):
        here = both.where((F.col("level") == level) & F.col("node").isin(nodes))
        same = here.groupBy("node").agg(F.count("*").alias("sides"), F.count_distinct(*SUMS).alias("kinds"))
        differ = sorted(r["node"] for r in same.where("sides < 2 or kinds > 1").collect())
        nodes = differ if level == 0 else [(n << fanout_bits) + i for n in differ for i in range(1 << fanout_bits)]
        if not nodes:
            break
    return nodes


def change_feed_by_digests(old: Snapshot, new: Snapshot, key: str = "chunk_id", fanout_bits: int = FANOUT_BITS) -> DataFrame:
    """The row changes from one snapshot to the other; folders with equal digests are not read.

    Two folders with different rows pass for equal only if a 64-bit exclusive or and a second, independent 64 bits of sums
    agree by chance.
    """
    differ = unequal_buckets(old, new, fanout_bits)
    return change_feed(old.rows(differ), new.rows(differ), key)
