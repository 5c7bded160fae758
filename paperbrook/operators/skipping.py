"""Files of a table that a filter can rule out without opening them.

The table is clustered by a few columns, and a row for each of its files keeps the range of these columns and a signature
of the tokens of its texts: 32,768 bits, one for each hash value that a token of the file has. A filter on the columns
leaves out files whose range it misses, a LIKE those whose signature lacks a token. What is left is filtered as usual, so
the result is that of a full scan.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass
from functools import reduce
from typing import Any

import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperbrook.functions.text import TOKEN, tokens
from paperbrook.operators.filters import COMPARISONS, apply_filters, parse_key
from paperbrook.sources.tables import write_snapshot

BITS = 1 << 15  # what Spark's bitmap aggregate holds


@dataclass(frozen=True)
class Clustered:
    """A written table in ``rows`` and a row for each of its files in ``files``."""

    spark: SparkSession
    folder: str
    schema: T.StructType
    by: tuple[str, ...]
    text: str | None

    def files(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/files")

    def needed(self, filters: list[dict[str, Any]]) -> list[str]:
        """The files that may hold a row that the filters take."""
        return [r["file"] for r in self.files().where(may_match(filters, self.by, self.text)).select("file").collect()]

    def read(self, filters: list[dict[str, Any]]) -> DataFrame:
        """The rows that the filters take; other files than the needed ones are not opened."""
        needed = self.needed(filters)
        reader = self.spark.read.schema(self.schema)
        rows = reader.parquet(*needed) if needed else self.spark.createDataFrame([], self.schema)
        return apply_filters(rows, filters)


def _bit(token: Column) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(BITS))


def _has_bit(signature: Column, token: str) -> Column:
    place = _bit(F.lit(token))
    byte = F.conv(F.hex(F.substring(signature, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.pmod(F.floor(byte / F.pow(F.lit(2), place % 8)), F.lit(2)) == 1


def may_match(filters: list[dict[str, Any]], by: tuple[str, ...], text: str | None) -> Column:
    """Whether a file, by its row in ``files``, may hold a row that all filters take. NOT and OR rule nothing out."""
    tests = [F.lit(True)]
    for item in filters:
        names, op = parse_key(item["key"])
        value = item["value"]
        values = list(value) if isinstance(value, (list, tuple)) else [value]
        if len(names) > 1:
            continue
        if op == "LIKE" and names[0] == text:
            wanted = dict.fromkeys(regex.findall(TOKEN, values[0].lower()))
            tests += [_has_bit(F.col("signature"), token) for token in wanted]
        elif names[0] in by and op == "=":
            low, high = F.col(f"low_{names[0]}"), F.col(f"high_{names[0]}")
            tests.append(reduce(operator.or_, [(low <= F.lit(v)) & (high >= F.lit(v)) for v in values]))
        elif names[0] in by and op in COMPARISONS:
            side = "low" if op.startswith("<") else "high"
            tests.append(COMPARISONS[op](F.col(f"{side}_{names[0]}"), value))
    return reduce(operator.and_, tests)


def write_clustered(df: DataFrame, folder: str, by: list[str], text: str | None = None, files: int = 32) -> Clustered:
    """Write a table sorted by ``by`` into about ``files`` files, and what is known of each.

    A table that is read in more splits than that gets as many files, so that no task sorts more than about a split.
    Ranges are cut by a sample of the columns and a salt, so values that a third of all rows share fill several files.
    Signatures are or-ed within tasks first. Rows without text add no token; nulls are in no range and match no filter.
    """
    plain = [f.name for f in df.schema if not isinstance(f.dataType, T.MapType)]  # maps have no hash
    salted = F.pmod(F.xxhash64(*plain), F.lit(1024))
    most = max(files, df.rdd.getNumPartitions())
    dealt = df.withColumn("_salt", salted).repartitionByRange(most, *by, "_salt").sortWithinPartitions(*by).drop("_salt")
    rows = write_snapshot(dealt, f"{folder}/rows").withColumn("file", F.input_file_name())
    ranges = [f(c).alias(f"{name}_{c}") for c in by for name, f in (("low", F.min), ("high", F.max))]
    known = rows.groupBy("file").agg(F.count("*").alias("n"), *ranges)
    if text:
        words = rows.select("file", F.explode(F.array_distinct(tokens(F.col(text)))).alias("token"))
        signed = words.groupBy("file").agg(F.bitmap_construct_agg(_bit(F.col("token"))).alias("signature"))
        nothing = F.lit(bytes(BITS // 8))
        known = known.join(signed, "file", "left").withColumn("signature", F.coalesce("signature", nothing))
    write_snapshot(known, f"{folder}/files")
    return Clustered(df.sparkSession, folder, df.schema, tuple(by), text)
