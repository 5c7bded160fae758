"""The chunk table: upsert, replace, delete, and the feed of its row changes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def chunk_upsert(chunks: DataFrame, new: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Matched keys take the new row, unmatched keys are added."""
    return chunks.join(new.select(key), key, "left_anti").select(*chunks.columns).unionByName(new)


def chunk_delete(chunks: DataFrame, paths: DataFrame) -> DataFrame:
    """Drop every chunk of the given paths."""
    return chunks.join(paths.select("path"), "path", "left_anti").select(*chunks.columns)


def chunk_replace(chunks: DataFrame, new: DataFrame, paths: DataFrame) -> DataFrame:
    """Drop every chunk of the given paths and add the new ones, so an updated file leaves nothing behind."""
    return chunk_delete(chunks, paths).unionByName(new)


def change_feed(old: DataFrame, new: DataFrame, key: str = "chunk_id", scope: DataFrame | None = None) -> DataFrame:
    """Row changes from ``old`` to ``new``: insert, update_preimage, update_postimage, delete.

    ``scope`` names the paths a run has touched. Only their rows can differ, so with it the join sees
    those rows alone and the cost follows the change, not the table.
    """
    if scope is not None:
        touched = scope.select("path").distinct()
        old = old.join(touched, "path", "left_semi")
        new = new.join(touched, "path", "left_semi")
    columns = new.columns
    before = old.select(F.struct(*columns).alias("before"))
    after = new.select(F.struct(*columns).alias("after"))
    same_key = F.col(f"before.{key}") == F.col(f"after.{key}")
    pairs = before.join(after, same_key, "full_outer")
    differs = ~reduce(
        lambda a, b: a & b,
        [F.col(f"before.{c}").eqNullSafe(F.col(f"after.{c}")) for c in columns],
    )
    change = lambda kind, row: F.struct(F.lit(kind).alias("_change_type"), F.col(row).alias("row"))
    images = (
        F.when(F.col(f"before.{key}").isNull(), F.array(change("insert", "after")))
        .when(F.col(f"after.{key}").isNull(), F.array(change("delete", "before")))
        .otherwise(F.array(change("update_preimage", "before"), change("update_postimage", "after")))
    )
    return pairs.where(differs).select(F.explode(images).alias("c")).select("c.row.*", "c._change_type")


def apply_changes(old: DataFrame, feed: DataFrame, key: str = "chunk_id") -> DataFrame:
    """The table after the feed: ``apply_changes(old, change_feed(old, new))`` equals ``new``."""
    removed = feed.where(F.col("_change_type").isin("delete", "update_preimage")).select(key)
    added = feed.where(F.col("_change_type").isin("insert", "update_postimage")).drop("_change_type")
    return old.join(removed, key, "left_anti").select(*old.columns).unionByName(added)
