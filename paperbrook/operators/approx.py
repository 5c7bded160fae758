"""Approximate nearest neighbours through an index of hashed vectors.

Random hyperplanes (Charikar, STOC 2002) give each vector one short code per table; vectors with a small
angle between them tend to share a code. A search reads only the rows whose code a query shares.
"""

from __future__ import annotations

import hashlib
import operator
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperbrook.operators.search import (
    BROADCAST_QUERIES, BROADCAST_VALUES, K, SPREAD, _Best, _matrix, _no_hits, _ranked_schema, _rounded,
    ids_of, refuse_repeats, top_k,
)

TABLES, BITS = 8, 8
# Codes of a block of queries that are written into the filter of its scan.
BLOCK_CODES = 8192
# Queries and rows of a code that meet in one call of a search, and in one that gives all their pairs.
MEET_QUERIES, MEET_ROWS = 4096, 16384
PAIR_QUERIES, PAIR_ROWS = 1024, 4096


def _planes(tables: int, bits: int, dim: int) -> np.ndarray:
    """Plane entries of +1 or -1 taken from a hash of their position: the same on every machine."""

    def sign(table: int, bit: int, d: int) -> float:
        return 1.0 - 2.0 * (hashlib.md5(f"{table}|{bit}|{d}".encode()).digest()[3] & 1)

    return np.array([[sign(t, b, d) for d in range(dim)] for t in range(tables) for b in range(bits)])


def plane_codes(vector: Column, dim: int, tables: int = TABLES, bits: int = BITS) -> Column:
    """One code per table: a bit for each plane the vector lies on the positive side of."""
    planes = _planes(tables, bits, dim)

    def code(vectors: pa.Array) -> pa.Array:
        if not len(vectors):
            return pa.array([], pa.list_(pa.int32()))
        positive = (_matrix(vectors) @ planes.T > 0).reshape(len(vectors), tables, bits)
        codes = (positive * (1 << np.arange(bits))).sum(axis=2).astype(np.int32)
        return pa.ListArray.from_arrays(np.arange(len(vectors) + 1, dtype=np.int32) * np.int32(tables), codes.ravel())

    code.__annotations__ = {"vectors": pa.Array, "return": pa.Array}
    return F.arrow_udf(code, "array<int>")(vector)


def hash_vectors(df: DataFrame, dim: int, tables: int = TABLES, bits: int = BITS, vector: str = "embedding") -> DataFrame:
    """One row per vector and table: the index. Write it partitioned by ``lsh_table`` and ``lsh_code``
    and a search prunes to the codes its queries have."""
    codes = df.where(F.col(vector).isNotNull()).withColumn("_codes", plane_codes(F.col(vector), dim, tables, bits))
    # The outer form: a plain explode makes Spark add a filter that computes the codes a second time.
    return codes.select(*df.columns, F.posexplode_outer("_codes").alias("lsh_table", "lsh_code"))


def _has_code(rows) -> Column:
    """The codes of the queries as plain values, which prune the folders of an index split by code."""
    codes: dict[int, set[int]] = {}
    for r in rows:
        for table, code in enumerate(r["codes"]):
            codes.setdefault(table, set()).add(code)
    tests = [(F.col("lsh_table") == t) & F.col("lsh_code").isin(sorted(c)) for t, c in sorted(codes.items())]
    return reduce(operator.or_, tests)


def _scan_codes(rows, ids: pa.Array, hashed: DataFrame, k: int, key: str, vector: str, schema) -> DataFrame:
    """A block of queries: each task scores its rows against the queries of the same code and keeps k per query.

    A code held by a third of all vectors stays spread over the tasks that read it.
    """
    matrix = np.array([r[vector] for r in rows], dtype=np.float64)
    asked: dict[tuple[int, int], list[int]] = {}
    for place, r in enumerate(rows):
        for code in enumerate(r["codes"]):
            asked.setdefault(code, []).append(place)
    sent = hashed.sparkSession.sparkContext.broadcast((ids, matrix, {c: np.array(q) for c, q in asked.items()}))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix, asked = sent.value
        best = _Best(len(matrix), k)
        for batch in batches:
            table, code = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("lsh_table", "lsh_code"))
            order = np.lexsort((code, table))
            change = np.flatnonzero((np.diff(table[order]) != 0) | (np.diff(code[order]) != 0)) + 1
            vectors = _matrix(batch.column(vector))
            for group in np.split(order, change):
                queries = asked.get((table[group[0]], code[group[0]])) if len(group) else None
                for at in range(0, len(group) if queries is not None else 0, best.block):
                    part = group[at : at + best.block]
                    best.add(batch.column(key).take(pa.array(part)), matrix[queries] @ vectors[part].T, queries)
        yield from best.batches(ids, schema.names)

    return hashed.select(key, vector, "lsh_table", "lsh_code").mapInArrow(score, schema)


def _meet(
    asked: DataFrame, rows: DataFrame, query_id: str, key: str, most_asked: int, most_rows: int, run, schema,
) -> DataFrame:
    """``run`` on the queries and the rows of each code, where neither side of a call is much larger than the limits.

    Codes are counted first, both sides of a frequent one are dealt into parts by their keys, and every part of the
    one side meets every part of the other.
    """
    code = ["lsh_table", "lsh_code"]
    counted = asked.groupBy(*code).agg(F.count("*").alias("_n")).join(rows.groupBy(*code).agg(F.count("*").alias("_m")), code)
    parts = F.broadcast(counted.select(
        *code, F.ceil(F.col("_n") / most_asked).cast("int").alias("_qs"), F.ceil(F.col("_m") / most_rows).cast("int").alias("_rs")
    ))

    def dealt(side: DataFrame, name: str, own: str, number: str, others: str, copies: str) -> DataFrame:
        part = F.pmod(F.xxhash64(name), F.col(number)).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.col(copies) - 1)).alias(others)
        # Both sides may come from one table: columns of their own keep them apart.
        return side.join(parts, code).select(*[F.col(c).alias(c) for c in side.columns], part, every)

    at = [*code, "_q", "_r"]
    left = dealt(asked, query_id, "_q", "_qs", "_r", "_rs").groupBy(*at)
    right = dealt(rows, key, "_r", "_rs", "_q", "_qs").groupBy(*at)
    return left.cogroup(right).applyInArrow(run, schema)


def _search_codes(
    asked: DataFrame, hashed: DataFrame, k: int, query_id: str, key: str, vector: str, schema,
) -> DataFrame:
    """More queries than one scan takes along: they meet the rows of their codes, and each call keeps k per query."""

    def score(asked: pa.Table, rows: pa.Table) -> pa.Table:
        asked, rows = asked.combine_chunks(), rows.combine_chunks()
        kinds = [asked.schema.field(query_id).type, rows.schema.field(key).type, pa.float64()]
        found = pa.schema([*zip(schema.names, kinds, strict=True)])
        if not asked.num_rows or not rows.num_rows:
            return found.empty_table()
        whole = lambda t, c: pa.concat_arrays(t.column(c).chunks)
        matrix, best = _matrix(whole(asked, vector)), _Best(asked.num_rows, k)
        for at in range(0, rows.num_rows, best.block):
            part = rows.slice(at, best.block)
            best.add(whole(part, key), matrix @ _matrix(whole(part, vector)).T)
        return pa.Table.from_batches(best.batches(whole(asked, query_id), schema.names), found)

    queries = asked.select(query_id, vector, F.posexplode("codes").alias("lsh_table", "lsh_code"))
    rows = hashed.select(key, vector, "lsh_table", "lsh_code")
    return _meet(queries, rows, query_id, key, MEET_QUERIES, MEET_ROWS, score, schema)


def _with_earlier(hashed: DataFrame, key: str, vector: str) -> DataFrame:
    """A row for each key and code of it, with the key's codes that come before, as numbers."""
    one = hashed.groupBy(key, "lsh_table", "lsh_code").agg(F.first(vector).alias(vector))
    number = F.shiftleft(F.col("lsh_table").cast("bigint"), 32) + F.col("lsh_code")
    listed = one.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(number.alias("cell"), "lsh_table", "lsh_code", vector))).alias("_all"))
    each = listed.select(key, F.col("_all.cell").alias("_cells"), F.posexplode("_all").alias("_at", "_one"))
    return each.select(key, f"_one.{vector}", "_one.lsh_table", "_one.lsh_code", F.slice("_cells", F.lit(1), F.col("_at")).alias("_earlier"))


def candidate_scores(
    queries: DataFrame, hashed: DataFrame, query_id: str = "query_id", key: str = "chunk_id", vector: str = "embedding",
) -> DataFrame:
    """Score of every vector that shares a code with a query, once per pair.

    The two sides meet on the code, dealt into parts where it is frequent. Both carry their codes that come before, and a
    pair counts at the first code it shares, so pairs are never moved to find those that come twice.
    """
    kinds = [T.StructField(query_id, queries.schema[query_id].dataType), T.StructField(key, hashed.schema[key].dataType)]
    schema = T.StructType([*kinds, T.StructField("score", T.DoubleType())])

    def holders(lists: pa.Array) -> dict[int, np.ndarray]:
        lengths = lists.value_lengths().to_numpy()
        cells, rows = lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), lengths)
        order = np.argsort(cells, kind="stable")
        change = np.flatnonzero(np.diff(cells[order])) + 1
        return {int(cells[g[0]]): rows[g] for g in np.split(order, change) if len(g)}

    def score(asked: pa.Table, rows: pa.Table) -> pa.Table:
        found = pa.schema([*zip(schema.names, [asked.schema.field(query_id).type, rows.schema.field(key).type, pa.float64()], strict=True)])
        if not asked.num_rows or not rows.num_rows:
            return found.empty_table()
        whole = lambda t, c: pa.concat_arrays(t.column(c).chunks)
        new = np.ones((asked.num_rows, rows.num_rows), bool)
        theirs = holders(whole(rows, "_earlier"))
        for cell, own in holders(whole(asked, "_earlier")).items():
            if cell in theirs:
                new[np.ix_(own, theirs[cell])] = False
        who, what = np.nonzero(new)
        scores = _rounded((_matrix(whole(asked, vector)) @ _matrix(whole(rows, vector)).T)[who, what])
        return pa.table([whole(asked, query_id).take(pa.array(who)), whole(rows, key).take(pa.array(what)), pa.array(scores)], schema=found)

    sides = _with_earlier(queries, query_id, vector), _with_earlier(hashed, key, vector)
    return _meet(*sides, query_id, key, PAIR_QUERIES, PAIR_ROWS, score, schema)


def approx_search(
    queries: DataFrame, index: DataFrame, dim: int, k: int = K, tables: int = TABLES, bits: int = BITS,
    query_id: str = "query_id", key: str = "chunk_id", vector: str = "embedding",
    max_broadcast: int = BROADCAST_QUERIES,
) -> DataFrame:
    """The k best among the vectors sharing a code; give ``hash_vectors`` output to search a built index.

    A block of queries is one scan, and its codes, at most ``BLOCK_CODES`` of them, prune an index written with
    ``lsh_table`` and ``lsh_code`` as partition columns. More queries than that ask for nearly every code: each meets the rows
    of its codes, so the index is read once and not by every block. A query id must stand once.
    """
    hashed = index if "lsh_code" in index.columns else hash_vectors(index, dim, tables, bits, vector)
    asked = queries.where(F.col(vector).isNotNull())
    asked = asked.select(query_id, vector, plane_codes(F.col(vector), dim, tables, bits).alias("codes"))
    refuse_repeats(queries, query_id)
    schema = _ranked_schema(queries, index, query_id, key)
    most = max(1, min(max_broadcast, BLOCK_CODES // tables, BROADCAST_VALUES // dim))
    if queries.count() > most:
        found = _search_codes(asked, hashed, k, query_id, key, vector, schema)
    else:
        rows = asked.collect()
        if not rows:
            return _no_hits(index, schema)
        found = _scan_codes(rows, ids_of(rows, queries, query_id), hashed.where(_has_code(rows)), k, key, vector, schema)
    # A pair found through several tables has the same score in each.
    scored = found.groupBy(query_id, key).agg(F.first("score").alias("score"))
    return top_k(scored, k, query_id, key, SPREAD)


def recall_report(
    exact: DataFrame, approx: DataFrame, candidates: DataFrame, n_pairs: Column,
    query_id: str = "query_id", key: str = "chunk_id",
) -> DataFrame:
    """Recall beside the share of pairs examined: the one means nothing without the other."""
    found = exact.select(query_id, key).join(
        approx.select(query_id, key).withColumn("_hit", F.lit(1)), [query_id, key], "left"
    )
    return found.agg(F.round(F.avg(F.coalesce("_hit", F.lit(0))), 6).alias("recall")).select(
        "recall",
        F.round(candidates.agg(F.count("*")).scalar() / n_pairs, 6).alias("share_examined"),
    )
