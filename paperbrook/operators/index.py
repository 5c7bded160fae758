"""The search index: one row per chunk with its terms, their counts, its length and its vector.

A row depends on its chunk alone, so building and syncing the index shuffle no text and gather no term: a
term found in a third of all chunks costs nothing extra. The rows carry the filter columns, so a filter is a
scan predicate and never a join, and each kind of search reads only the columns it scores by.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperbrook.functions.text import token_line
from paperbrook.operators.embedding import DIM, term_profile

META = ["path", "category", "year", "month"]


def build_index(
    chunks: DataFrame, text: str = "chunk_text", key: str = "chunk_id", carry: list[str] = META, dim: int = DIM
) -> DataFrame:
    """Index rows of the chunks: map-only, the text is read once."""
    return chunks.select(key, *carry, term_profile(token_line(F.col(text)), dim).alias("_p")).select(key, *carry, "_p.*")


def postings(index: DataFrame, *columns: str) -> DataFrame:
    """One row per term and chunk: term, tf and the given columns."""
    # A plain explode makes Spark add a filter on the array, which would run the profile a second time.
    pairs = index.select(*columns, F.explode_outer(F.arrays_zip("terms", "tfs")).alias("_p"))
    return pairs.where(F.col("_p").isNotNull()).select(
        F.col("_p.terms").alias("term"), F.col("_p.tfs").cast("bigint").alias("tf"), *columns
    )


def sync_index(
    index: DataFrame, feed: DataFrame, text: str = "chunk_text", key: str = "chunk_id", carry: list[str] = META,
    dim: int = DIM,
) -> DataFrame:
    """The index after a change feed of the chunk table: only inserted and updated chunks are embedded."""
    removed = feed.where(F.col("_change_type").isin("delete", "update_preimage")).select(key)
    added = feed.where(F.col("_change_type").isin("insert", "update_postimage"))
    kept = index.join(removed, key, "left_anti").select(*index.columns)
    return kept.unionByName(build_index(added, text, key, carry, dim))
