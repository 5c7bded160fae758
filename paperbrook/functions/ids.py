"""Stable keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def chunk_id(path: Column, version: Column, ordinal: Column) -> Column:
    """Same file version and position, same id: a retried task or a second run writes the same key."""
    return F.md5(F.concat_ws("|", path, version.cast("string"), ordinal.cast("string")))


def salt(key: Column, buckets: int) -> Column:
    """Spread rows of one hot group by a hash of their own key, so that a recomputed task agrees."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
