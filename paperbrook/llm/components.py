"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperbrook.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b), both bigint; the root is the smallest node it reaches.

    Large star: each node hands its larger neighbours to its smallest one. Small star: each node hands its
    smaller neighbours, and itself, to the smallest. It ends when all that is left are stars: every child has one
    parent, and no parent is a child. Rounds grow with the logarithm of the longest path. A node
    with many neighbours is only ever met by a minimum, which is taken before the shuffle, and by an equi-join
    whose large side can be split. Links to oneself and links with a null end are left out.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(edges, "links")
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(least.select("a", F.col("m").alias("b")).union(small).distinct(), "links")
        ups = edges.select(F.col("a").alias("node"), F.lit(1).alias("parents"), F.lit(0).alias("parent"))
        downs = edges.select("b", F.lit(0), F.lit(1))
        roles = ups.union(downs).groupBy("node").agg(F.sum("parents").alias("parents"), F.max("parent").alias("parent"))
        if roles.where("parents + parent > 1").isEmpty():
            break
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
