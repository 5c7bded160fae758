"""The tracking table: which files are new, updated, deleted or indexed.

Each merge is a pure function from the old snapshot and a listing to the new snapshot: plain Parquet
has no row-level MERGE, and one equi-join on path does the work of the update, insert and delete.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperbrook.sources.schemas import DELETED, INDEXED, NEW, TRACKING, UPDATED

LISTED = ["length", "modification_ts", "ingest_ts", "category", "year", "month"]


def one_row_per_key(df: DataFrame, key: str) -> DataFrame:
    """The rows as they are; the job fails on a key that occurs twice, as a merge source must not.

    The group-by shuffles on the key the following join needs, so it adds no exchange of its own, and
    its map side folds a hot duplicate before the shuffle.
    """
    rest = [c for c in df.columns if c != key]
    grouped = df.groupBy(key).agg(F.count("*").alias("_n"), *[F.first(c).alias(c) for c in rest])
    message = F.concat(F.lit(f"duplicate merge key in {key}: "), F.col(key).cast("string"))
    single = F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return grouped.where(single).select(*df.columns)


def _merge(track: DataFrame, listing: DataFrame, revive: bool, mark_deleted: bool) -> DataFrame:
    t = track.select([F.col(c).alias(f"t_{c}") for c in TRACKING.names])
    s = one_row_per_key(listing.select("path", *LISTED), "path")
    s = s.select([F.col(c).alias(f"s_{c}") for c in s.columns])
    joined = t.join(s, F.col("t_path") == F.col("s_path"), "full_outer")

    inserted = F.col("t_path").isNull()
    newer = F.col("s_modification_ts") > F.col("t_modification_ts")
    if revive:
        newer = newer | (F.col("s_path").isNotNull() & ~F.col("t_is_current"))
    taken = inserted | F.coalesce(newer, F.lit(False))
    gone = F.col("s_path").isNull() & F.coalesce(F.col("t_is_current"), F.lit(False))

    def listed(name: str) -> Column:
        return F.when(taken, F.col(f"s_{name}")).otherwise(F.col(f"t_{name}"))

    status = F.when(inserted, NEW).when(taken, UPDATED)
    current = F.when(taken, True)
    if mark_deleted:
        status = status.when(gone, DELETED)
        current = current.when(gone, False)

    values = {
        "path": F.coalesce("t_path", "s_path"),
        **{name: listed(name) for name in LISTED},
        "status": status.otherwise(F.col("t_status")),
        "version": F.when(inserted, F.lit(1)).when(taken, F.col("t_version") + 1).otherwise(F.col("t_version")),
        "is_current": current.otherwise(F.col("t_is_current")),
        "indexed_at": F.col("t_indexed_at"),
    }
    return joined.select([values[f.name].cast(f.dataType).alias(f.name) for f in TRACKING])


def track_upsert(track: DataFrame, listing: DataFrame, revive: bool = False) -> DataFrame:
    """Unknown paths come in as NEW, version 1; a strictly newer time makes UPDATED, version + 1.

    ``revive`` also takes back a deleted file that returns with an unchanged time.
    """
    return _merge(track, listing, revive, mark_deleted=False)


def track_sync(track: DataFrame, listing: DataFrame, revive: bool = False) -> DataFrame:
    """``track_upsert`` and ``track_mark_deleted`` in one pass over one join."""
    return _merge(track, listing, revive, mark_deleted=True)


def track_sync_bucketed(track: DataFrame, listing: DataFrame, buckets: int, revive: bool = False) -> DataFrame:
    """``track_sync`` of a table written in ``buckets`` by path: only the listing is moved, to where its paths are tracked.

    The rows come out dealt by path, so ``write_bucketed`` with ``dealt`` writes the next version without moving them.
    """
    return _merge(track, listing.repartition(buckets, "path"), revive, mark_deleted=True)


def deleted_paths(track: DataFrame, listing: DataFrame) -> DataFrame:
    """Current paths that are no longer listed. An anti join: no path list, no quoting, no NOT IN nulls."""
    return track.where("is_current").select("path").join(listing.select("path"), "path", "left_anti")


def track_mark_deleted(track: DataFrame, listing: DataFrame) -> DataFrame:
    """Current rows whose path is not listed become DELETED and not current."""
    live = listing.select("path").distinct().withColumn("_live", F.lit(True))
    gone = F.col("is_current") & F.col("_live").isNull()
    return (
        track.join(live, "path", "left")
        .withColumns({
            "status": F.when(gone, DELETED).otherwise(F.col("status")),
            "is_current": F.when(gone, False).otherwise(F.col("is_current")),
        })
        .select(*track.columns)
    )


def track_mark_indexed(track: DataFrame, paths: DataFrame, as_of: datetime | Column | None = None) -> DataFrame:
    """Rows of the given paths become INDEXED. ``paths`` must be a written set, not a filter on ``track``.

    ``as_of`` is one time, or a column of ``paths``; a path that is given twice takes the latest.
    """
    if as_of is None:
        as_of = F.current_timestamp()
    stamp = as_of if isinstance(as_of, Column) else F.lit(as_of)
    done = paths.groupBy("path").agg(F.max(stamp.cast("timestamp")).alias("_at"), F.lit(True).alias("_done"))
    return (
        track.join(done, "path", "left")
        .withColumns({
            "status": F.when(F.col("_done"), INDEXED).otherwise(F.col("status")),
            "indexed_at": F.when(F.col("_done"), F.col("_at")).otherwise(F.col("indexed_at")),
        })
        .select(*track.columns)
    )


def to_index(track: DataFrame, full_refresh: bool = False) -> DataFrame:
    """Files to split again: NEW and UPDATED, and INDEXED too on a full refresh."""
    return track.where(F.col("status").isin([NEW, UPDATED] + ([INDEXED] if full_refresh else [])))


def to_delete(track: DataFrame) -> DataFrame:
    return track.where(F.col("status") == DELETED)
