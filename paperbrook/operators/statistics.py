"""Term statistics of an index, kept up to date by the change feed of its chunks.

A row per term holds the number of chunks that have it. The row without a term holds the number of chunks and
their tokens in all. Both are sums, so the statistics after a feed are those before it and a signed row for each term
of an added or removed chunk; the index itself is not read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperbrook.operators.index import build_index

COLUMNS = ["term", "df", "length"]


def _counted(rows: DataFrame, sign: Column | int) -> DataFrame:
    """Statistics of index rows (doc_len, terms, tfs), each counted ``sign`` times."""
    counted = rows.withColumn("_n", F.lit(sign) if isinstance(sign, int) else sign).select("doc_len", "terms", "_n")
    # Only outer: a plain explode makes Spark add a filter on the array, which would run the profile a second time.
    pairs = counted.select(F.explode_outer("terms").alias("term"), F.col("_n").alias("df"), F.lit(0).alias("length")).where("term is not null")
    chunks = counted.select(F.lit(None).cast("string").alias("term"), F.col("_n").alias("df"), (F.col("_n") * F.col("doc_len")).alias("length"))
    return pairs.unionByName(chunks)


def _summed(rows: DataFrame) -> DataFrame:
    """Rows of one term are added up within tasks first; a term that no chunk has any more goes."""
    sums = rows.groupBy("term").agg(F.sum("df").cast("bigint").alias("df"), F.sum("length").cast("bigint").alias("length"))
    return sums.where("term is null or df <> 0")


def index_statistics(index: DataFrame) -> DataFrame:
    """(term, df, length) of a whole index; an empty one has no row."""
    return _summed(_counted(index, 1))


def statistics_delta(added: DataFrame, removed: DataFrame) -> DataFrame:
    """What index rows that come and go add to the statistics; terms that even out have no row."""
    return _summed(_counted(added, 1).unionByName(_counted(removed, -1)))


def feed_delta(feed: DataFrame, text: str = "chunk_text", key: str = "chunk_id") -> DataFrame:
    """What a change feed of the chunk table adds: its rows hold the text before and after, so nothing else is read."""
    gone = F.col("_change_type").isin("delete", "update_preimage")
    rows = build_index(feed.withColumn("_n", F.when(gone, -1).otherwise(1)), text, key, ["_n"])
    return _summed(_counted(rows, F.col("_n")))


def sync_statistics(statistics: DataFrame, *deltas: DataFrame) -> DataFrame:
    """The statistics after the deltas."""
    rows = statistics.select(COLUMNS)
    for delta in deltas:
        rows = rows.unionByName(delta.select(COLUMNS))
    return _summed(rows)


def totals(statistics: DataFrame) -> tuple[int, float]:
    """Number of chunks and their mean length in tokens; zeros for an empty index."""
    row = statistics.where("term is null").agg(F.sum("df").alias("n"), F.sum("length").alias("length")).first()
    return (row["n"], row["length"] / row["n"]) if row["n"] else (0, 0.0)
