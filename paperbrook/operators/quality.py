"""Metadata checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def metadata_violations(
    categories: list[str] | None = None, years: tuple[int, int] = (1900, 2100), months: tuple[int, int] = (1, 12)
) -> Column:
    """Names of the fields outside their domain; empty when all is well. A missing value is a violation."""

    def bad(name: str, ok: Column) -> Column:
        return F.when(~F.coalesce(ok, F.lit(False)), F.lit(name))

    known = F.col("category").isin(categories) if categories else F.col("category").isNotNull()
    return F.array_compact(F.array(
        bad("category", known),
        bad("year", F.col("year").between(*years)),
        bad("month", F.col("month").between(*months)),
    ))


def validate_metadata(df: DataFrame, **domain) -> DataFrame:
    """Add ``violations``; ``size(violations) = 0`` keeps the good rows, the rest is for quarantine."""
    return df.withColumn("violations", metadata_violations(**domain))
