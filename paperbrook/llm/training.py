"""The bounded labelled sample that the two classifiers learn from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labelled rows that a classifier is fitted on at most; which ones is a matter of a hash of doc_id.
SAMPLE_ROWS = 8000


def id_remainder(modulus: int) -> Column:
    """crc32 of doc_id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, rows: int = SAMPLE_ROWS
) -> DataFrame:
    """(doc_id, text, y) of at most ``rows`` labelled rows outside the held-out ids.

    Labels other than 0 and 1 and labels of null ids are left out; of several labels of one id the largest counts.
    The ids are few by construction, so they go to every task and texts stay where they are.
    """
    given = labels.where(F.col(label).isin(0, 1) & (id_remainder(modulus) != held))
    given = given.groupBy("doc_id").agg(F.max(label).cast("int").alias("y"))
    chosen = given.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "doc_id")
