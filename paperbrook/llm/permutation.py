"""Approximate nearest neighbours by a permutation index."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from paperbrook.llm.common import union_all, written

# Pivots (at most 255, for a rank is a byte), pivots under which a vector is posted, pivots a query looks under,
# and the share of a block of vectors that is compared exactly, but no fewer than ``LEAST`` times the hits asked for.
PIVOTS, POSTED, PROBED, SHARE, LEAST = 128, 12, 24, 0.25, 4
NEAREST, QUERY_BYTES = 20, 16 << 20


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the vectors that take part: with an id, finite throughout, not all zero, of the commonest length."""
    v = F.col("embedding").cast("array<double>")
    given = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    kept = given.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0))
    length = kept.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return kept.where(F.size("v") == (length.n if length else 0))


def fit_pivots(vectors: DataFrame, pivots: int = PIVOTS) -> np.ndarray:
    """At most ``pivots`` of the vectors, those whose ids have the smallest hashes."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).collect()
    return np.array([r.v for r in rows], dtype=np.float64)


def matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(column), -1)


def build_index(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(vec_id, v, ranks): every vector with the rank of each pivot in its order of nearness, a byte each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                order = np.argsort(-(matrix(batch.column(1)) @ pivots.T), axis=1, kind="stable")
                ranks = np.argsort(order, axis=1, kind="stable").astype(np.uint8)
                columns = [batch.column(0), batch.column(1), pa.array([r.tobytes() for r in ranks], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "v", "ranks"])

    return vectors.mapInArrow(run, "vec_id bigint, v array<double>, ranks binary")


def inner_products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Row by row in the same order of additions, so equal vectors score alike wherever they stand in a block."""
    return (rows * query).sum(1)


def search_block(
    ids: np.ndarray, vectors: np.ndarray, ranks: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
    query_ranks: np.ndarray, k: int, share: float,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query number, row numbers, scores): of each query its best k rows of the block.

    The inverted file of a pivot lists the rows that have it among their nearest. A query reads the files of its own
    nearest pivots, orders what it finds by the footrule (the sum of differences of ranks, ties to the smaller id),
    and compares the best of that order exactly.
    """
    pivots = ranks.shape[1]
    files = [np.flatnonzero(ranks[:, p] < POSTED) for p in range(pivots)]
    wide = ranks.astype(np.int16)
    place = np.argsort(np.argsort(ids, kind="stable"), kind="stable")
    keep = max(LEAST * k, int(np.ceil(share * len(ids))))
    for number in range(len(query_ids)):
        met = np.zeros(len(ids), dtype=bool)
        for p in np.flatnonzero(query_ranks[number] < PROBED):
            met[files[p]] = True
        met[ids == query_ids[number]] = False
        found = np.flatnonzero(met)
        if len(found) < k:  # too few under these pivots: all rows are candidates
            found = np.flatnonzero(ids != query_ids[number])
        if len(found) > keep:
            footrule = np.abs(wide[found] - query_ranks[number].astype(np.int16)).sum(1, dtype=np.int32)
            order = footrule.astype(np.int64) * len(ids) + place[found]
            found = found[np.argpartition(order, keep - 1)[:keep]]
        scores = inner_products(vectors[found], queries[number])
        best = np.lexsort((ids[found], -scores))[:k]
        yield number, found[best], scores[best]


def search(index: DataFrame, queries: DataFrame, k: int = NEAREST, share: float = SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row of ``queries`` (an index table too).

    Queries go to all tasks in blocks of at most ``QUERY_BYTES``, one scan of the index each; every task returns k
    rows per query, so pairs are never rows and the index is never moved.
    """
    width = index.select(F.size("v").alias("n"), F.length("ranks").alias("m")).first()
    row_bytes = 8 + 8 * width.n + width.m if width else 1
    parts = 1 + queries.count() * row_bytes // QUERY_BYTES
    found = []
    for part in range(parts):
        rows = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == part).toArrow()
        if not rows.num_rows:
            continue
        columns = [c.combine_chunks() for c in rows.columns]
        block = (columns[0].to_numpy(), matrix(columns[1]), np.array([np.frombuffer(r, np.uint8) for r in columns[2].to_pylist()]))
        sent = index.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            query_ids, vectors, ranks = sent.value
            best = [(np.zeros(0, np.int64), np.zeros(0)) for _ in query_ids]
            for batch in batches:
                if not batch.num_rows:
                    continue
                ids = batch.column(0).to_numpy()
                own = np.array([np.frombuffer(r, np.uint8) for r in batch.column(2).to_pylist()])
                for at, rows, scores in search_block(ids, matrix(batch.column(1)), own, query_ids, vectors, ranks, k, share):
                    all_ids, all_scores = np.append(best[at][0], ids[rows]), np.append(best[at][1], scores)
                    first = np.lexsort((all_ids, -all_scores))[:k]
                    best[at] = all_ids[first], all_scores[first]
            for at, query_id in enumerate(query_ids):
                if len(best[at][0]):
                    columns = [pa.array(np.full(len(best[at][0]), query_id)), pa.array(best[at][0]), pa.array(best[at][1])]
                    yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

        found.append(index.mapInArrow(run, "query_id bigint, vec_id bigint, score double"))
    if not found:
        empty = "query_id bigint, rank int, vec_id bigint, score double"
        return index.sparkSession.createDataFrame([], empty)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = union_all(found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(vectors: DataFrame, is_query: Column, k: int = NEAREST, share: float = SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest by inner product of each row that ``is_query`` picks.

    All rows of ``vectors`` (vec_id, embedding) are indexed and searched but the query's own id. Vectors that are
    null, zero, hold null or non-finite components, have no id or another length than most take no part. Ties go
    to the smaller vec_id; repeated rows are found as often as they stand. Other columns are not read.
    """
    given = usable(vectors)
    pivots = fit_pivots(given)
    if not len(pivots):
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    index = written(build_index(given, pivots), "permutations")
    return search(index, index.where(is_query).dropDuplicates(["vec_id"]), k, share)
