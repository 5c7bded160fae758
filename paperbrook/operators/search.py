"""Top-k search for a table of queries: by vector, by keyword, and by both fused.

Scores are rounded before they are ranked and ties go to the smaller key, so every run ranks alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import islice
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from paperbrook.functions.ids import salt
from paperbrook.functions.text import tokens
from paperbrook.operators.embedding import DIM, embed
from paperbrook.operators.filters import apply_filters
from paperbrook.operators.index import postings
from paperbrook.operators.statistics import totals
from paperbrook.session import new_run_folder
from paperbrook.sources.tables import write_snapshot

K = 42
SCORE_DIGITS, FUSED_DIGITS = 6, 9
K1, B = 1.2, 0.75  # Robertson and Zaragoza 2009
RRF_K = 60  # Cormack et al. 2009

# Queries, numbers of their vectors, and query terms that one scan of the index takes along; more make more scans.
BROADCAST_QUERIES = 4096
BROADCAST_VALUES = 1 << 22
BROADCAST_TERMS = 200_000
# Scans that one job takes along; the hits of more are written round by round, so that the driver holds one round at a time.
ROUND_SCANS = 16
# Hits that are sent to the table their columns come from, counted as queries times k.
BROADCAST_HITS = 200_000
# No score is moved further than this by rounding.
MOST_ROUNDED = 10.0**-SCORE_DIGITS
# Scores held at a time while a block is ranked.
SCORE_CELLS = 1 << 22
# Terms of more than one in so many pairs of query and chunk are scored by a product of matrices. An entry of the others
# takes some hundred times as long as a cell of the product.
COMMON = 512
SPREAD = 16


def top_k(scored: DataFrame, k: int, group: str = "query_id", key: str = "chunk_id", spread: int = 1) -> DataFrame:
    """The k best rows of each group with their rank.

    Spark cuts every map task's rows to k per group before the shuffle. ``spread`` cuts once more
    within salted parts of a group, so that no task sorts what thousands of map tasks send it.
    """
    order = [F.desc("score"), F.asc(key)]
    if spread > 1:
        part = Window.partitionBy(group, "_part").orderBy(*order)
        scored = (
            scored.withColumn("_part", salt(F.col(key), spread))
            .withColumn("_n", F.row_number().over(part))
            .where(F.col("_n") <= k)
            .drop("_part", "_n")
        )
    whole = Window.partitionBy(group).orderBy(*order)
    return scored.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= k)


def _matrix(vectors: pa.Array) -> np.ndarray:
    """List column as rows of a matrix."""
    lengths = pc.unique(pc.list_value_length(vectors)).to_pylist()
    if len(lengths) > 1:
        raise ValueError(f"vectors differ in length: {sorted(lengths)}")
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), lengths[0] if lengths else 0)


def _cut(rows: pa.Table, k: int) -> pa.Table:
    """The k best rows of each query by score, then key; a pair that came twice counts once."""
    order = [("query", "ascending"), ("score", "descending"), ("key", "ascending")]
    rows = rows.take(pc.sort_indices(rows, sort_keys=order)).combine_chunks()
    query, score, key = (rows[name].combine_chunks() for name in ("query", "score", "key"))
    query, score = query.to_numpy(), score.to_numpy()
    if len(query) > 1:
        same_key = pc.equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False)
        again = (query[1:] == query[:-1]) & (score[1:] == score[:-1]) & same_key
        if again.any():
            keep = np.r_[True, ~again]
            rows, query = rows.filter(pa.array(keep)), query[keep]
    starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.array([], dtype=np.int64)
    place = np.arange(len(query)) - np.repeat(starts, np.diff(np.r_[starts, len(query)]))
    return rows.filter(pa.array(place < k))


def _rounded(scores: np.ndarray) -> np.ndarray:
    """Halves away from zero, as SQL rounds."""
    scaled = scores * 10.0**SCORE_DIGITS
    return np.trunc(scaled + np.copysign(0.5, scaled)) / 10.0**SCORE_DIGITS


class _Best:
    """Running k best keys for each query over the blocks of one task; holds a few times k rows per query."""

    def __init__(self, n_queries: int, k: int):
        self.k = k
        self.floor = np.full(n_queries, -np.inf)
        self.fresh: list[pa.Table] = []
        self.waiting = 0
        self.block = max(SCORE_CELLS // max(n_queries, 1), 1)

    def add(self, keys: pa.Array, scores: np.ndarray, queries: np.ndarray | None = None) -> None:
        """Scores of one block, a row per query (of ``queries``, or all); minus infinity where there is no hit.

        Only scores that may reach the floor are rounded; half a unit of the last digit is what rounding adds at most.
        """
        floor = self.floor if queries is None else self.floor[queries]
        # Without a floor yet only minus infinity is left out.
        hit = scores > np.where(floor > -np.inf, floor - MOST_ROUNDED, floor)[:, None]
        n = scores.shape[1]
        if n > self.k and np.count_nonzero(hit) > 2 * self.k * len(scores):
            kth = np.partition(scores, n - self.k, axis=1)[:, n - self.k]
            hit &= scores >= kth[:, None] - 2 * MOST_ROUNDED
        query, row = np.nonzero(hit)
        values = _rounded(scores[query, row])
        reached = values >= floor[query]
        query, row, values = query[reached], row[reached], values[reached]
        if not len(query):
            return
        query = query if queries is None else queries[query]
        self.fresh.append(pa.table({"query": query, "score": values, "key": keys.take(pa.array(row))}))
        self.waiting += len(query)
        if self.waiting > max(4 * self.k * len(self.floor), 1 << 16):
            self._settle()

    def _settle(self) -> None:
        rows = _cut(pa.concat_tables(self.fresh), self.k)
        self.fresh, self.waiting = [rows], 0
        held = rows["query"].to_numpy()
        last = np.r_[np.flatnonzero(held[1:] != held[:-1]), len(held) - 1]
        full = np.bincount(held, minlength=len(self.floor)) >= self.k
        self.floor[held[last]] = rows["score"].to_numpy()[last]
        self.floor[~full] = -np.inf

    def batches(self, query_ids: pa.Array, names: list[str]) -> list[pa.RecordBatch]:
        """The k best rows per query, with the queries' own ids; nothing when there was no hit."""
        if not self.fresh:
            return []
        self._settle()
        rows = self.fresh[0].combine_chunks()
        ids = query_ids.take(rows["query"].combine_chunks())
        return pa.table([ids, rows["key"], rows["score"]], names=names).combine_chunks().to_batches()


def _blocks(batch: pa.RecordBatch | pa.Table, rows: int) -> Iterator[pa.RecordBatch | pa.Table]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _ranked_schema(queries: DataFrame, vectors: DataFrame, query_id: str, key: str) -> T.StructType:
    return T.StructType([
        T.StructField(query_id, queries.schema[query_id].dataType),
        T.StructField(key, vectors.schema[key].dataType),
        T.StructField("score", T.DoubleType()),
    ])


def refuse_repeats(queries: DataFrame, query_id: str) -> None:
    """A query id that stands twice would mix two queries in one answer."""
    twice = queries.groupBy(query_id).count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"query id given more than once: {twice[0][0]!r}")


# Tasks that write the parts of a table of queries.
BLOCK_TASKS = 64


def each_block(queries: DataFrame, query_id: str, parts: int) -> Iterator[DataFrame]:
    """The queries in parts by a hash of their id, each written to a folder of its own, so that no part reads the others."""
    if parts <= 1:
        yield queries
        return
    spark, folder = queries.sparkSession, new_run_folder(queries.sparkSession, "queries")
    dealt = queries.withColumn("_part", F.pmod(F.xxhash64(query_id), F.lit(parts)).cast("int"))
    write_snapshot(dealt.repartition(min(parts, BLOCK_TASKS), "_part"), folder, ["_part"])
    found = sorted(r["_part"] for r in spark.read.schema("_part int").parquet(folder).select("_part").distinct().collect())
    yield from (spark.read.schema(queries.schema).parquet(f"{folder}/_part={part}") for part in found)


def query_blocks(queries: DataFrame, query_id: str, parts: int) -> list[DataFrame]:
    """All parts of :func:`each_block`."""
    return [*each_block(queries, query_id, parts)]


def query_size(asked: DataFrame, query_id: str, vector: str) -> tuple[int, int]:
    """Rows and numbers of a table of query vectors, whose ids must stand once; one pass."""
    each = asked.groupBy(query_id).agg(F.count("*").alias("n"), F.sum(F.size(vector)).alias("values"))
    sums = each.agg(F.sum("n").alias("n"), F.sum("values").alias("values"), F.max("n").alias("most")).first()
    if (sums["most"] or 0) > 1:
        refuse_repeats(asked, query_id)
    return sums["n"] or 0, sums["values"] or 0


def ids_of(rows, queries: DataFrame, query_id: str) -> pa.Array:
    """Ids in the type the result has, whatever Python makes of them."""
    return pa.array([r[query_id] for r in rows], to_arrow_type(queries.schema[query_id].dataType))


def _scan_top_k(rows: pa.Table, vectors: DataFrame, k: int, key: str, vector: str, schema) -> tuple[DataFrame, Broadcast]:
    """A block of queries (id, vector) goes to every task, each task scans its vectors once and keeps k rows per query. Gives
    these rows and what is sent."""
    ids, found = (c.combine_chunks() for c in rows.columns)
    sent = vectors.sparkSession.sparkContext.broadcast((ids, _matrix(found)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix = sent.value
        best = _Best(len(matrix), k)
        for batch in batches:
            for block in _blocks(batch, best.block):
                found = _matrix(block.column(vector))
                pointed = found.any(axis=1)
                if not pointed.all():
                    block, found = block.filter(pa.array(pointed)), found[pointed]
                best.add(block.column(key), matrix @ found.T)
        yield from best.batches(ids, schema.names)

    return vectors.mapInArrow(score, schema), sent


def similarity_search(
    queries: DataFrame,
    index: DataFrame,
    k: int = K,
    filters: list[dict[str, Any]] | None = None,
    query_id: str = "query_id",
    key: str = "chunk_id",
    vector: str = "embedding",
    max_broadcast: int = BROADCAST_QUERIES,
) -> DataFrame:
    """Exact k nearest by dot product, which is the cosine on unit vectors.

    Filters hold before ranking. A zero vector on either side has no direction and gives no hit. Queries are
    counted by rows and numbers, and each block of at most ``max_broadcast`` of them is one scan of the index,
    which is never moved. A query id must stand once.
    """
    candidates = apply_filters(index, filters).where(F.col(vector).isNotNull()).select(key, vector)
    asked = queries.where(F.exists(vector, lambda x: x != 0)).select(query_id, vector)
    schema = _ranked_schema(queries, index, query_id, key)
    n, values = query_size(asked, query_id, vector)
    parts = max(-(-n // max(max_broadcast, 1)), -(-values // BROADCAST_VALUES))
    scan = lambda rows: _scan_top_k(rows, candidates, k, key, vector, schema)
    blocks = (rows for block in each_block(asked, query_id, parts) if (rows := block.toArrow()).num_rows)
    return _ranked_rounds(blocks, parts, scan, index, k, query_id, key, schema)


def _ranked_rounds(
    blocks: Iterable[Any], parts: int, scan: Callable[[Any], tuple[DataFrame, Broadcast]], index: DataFrame, k: int,
    query_id: str, key: str, schema: T.StructType,
) -> DataFrame:
    """The k best of each query over a scan for each block of queries. A block has its queries to itself, so rounds of
    ``ROUND_SCANS`` scans are ranked and written one after the other, and what was sent for them goes."""
    spark, folder = index.sparkSession, new_run_folder(index.sparkSession, "hits")
    rounds, blocks = 0, iter(blocks)
    while scans := [scan(block) for block in islice(blocks, ROUND_SCANS)]:
        hits = top_k(reduce(DataFrame.unionByName, [rows for rows, _ in scans]), k, query_id, key, SPREAD)
        if not rounds and parts <= ROUND_SCANS:
            return hits
        write_snapshot(hits, f"{folder}/round={rounds}")
        rounds += 1
        for _, sent in scans:
            sent.destroy()
    return spark.read.schema(hits.schema).parquet(folder).select(hits.columns) if rounds else _no_hits(index, schema)


def query_terms(queries: DataFrame, query_id: str = "query_id", text: str = "text") -> DataFrame:
    """Distinct terms of each query."""
    return queries.select(query_id, F.explode(F.array_distinct(tokens(F.col(text)))).alias("term"))


class _TermWeights(NamedTuple):
    """Query terms with their weight, and for each term the queries that ask for it."""

    query_ids: pa.Array
    terms: pa.Array
    idf: np.ndarray
    first: np.ndarray  # queries[first[t]:first[t + 1]] ask for term t
    queries: np.ndarray
    average: float  # chunk length in tokens


def _term_weights(ids: pa.Array, terms: pa.Array, idf: np.ndarray, average: float) -> _TermWeights:
    """From one entry per query and term."""
    who, what = ids.dictionary_encode(), terms.dictionary_encode()
    term = what.indices.to_numpy()
    order = np.argsort(term, kind="stable")
    weight = np.empty(len(what.dictionary))
    weight[term] = idf
    first = np.searchsorted(term[order], np.arange(len(weight) + 1))
    return _TermWeights(who.dictionary, what.dictionary, weight, first, who.indices.to_numpy()[order].astype(np.int64), average)


def _bm25(block: pa.RecordBatch, weights: _TermWeights) -> np.ndarray:
    """Scores of a block of chunks, a row per query; minus infinity where no term is shared."""
    n, n_queries = block.num_rows, len(weights.query_ids)
    terms = block.column("terms")
    lengths = pc.list_value_length(terms).to_numpy(zero_copy_only=False)
    code = pc.fill_null(pc.index_in(terms.flatten(), value_set=weights.terms), -1).to_numpy(zero_copy_only=False)
    asked = np.flatnonzero(code >= 0)
    code = code[asked]
    row = np.repeat(np.arange(n), lengths)[asked]
    tf = block.column("tfs").flatten().to_numpy(zero_copy_only=False)[asked].astype(np.float64)
    length = block.column("doc_len").to_numpy(zero_copy_only=False)[row] / weights.average
    part = weights.idf[code] * tf * (K1 + 1.0) / (tf + K1 * (1.0 - B + B * length))
    # Terms that many of the chunks have and many of the queries ask for are one product of matrices.
    asking = np.diff(weights.first)
    had = np.bincount(code, minlength=len(asking))
    common = np.flatnonzero(had * asking > n * n_queries // COMMON)
    scores = np.zeros((n_queries, n))
    if len(common):
        column = np.full(len(asking), -1)
        column[common] = np.arange(len(common))
        chosen = column[code] >= 0
        values, wanted = np.zeros((len(common), n)), np.zeros((n_queries, len(common)))
        values[column[code[chosen]], row[chosen]] = part[chosen]
        for at, term in enumerate(common):
            wanted[weights.queries[weights.first[term] : weights.first[term + 1]], at] = 1.0
        np.matmul(wanted, values, out=scores)
        code, row, part = code[~chosen], row[~chosen], part[~chosen]
    # Of the others one entry for each query that asks for the term.
    times = asking[code]
    entry = np.repeat(np.arange(len(code)), times)
    within = np.arange(len(entry)) - np.repeat(np.cumsum(times) - times, times)
    query = weights.queries[weights.first[code][entry] + within]
    scores += np.bincount(query * n + row[entry], weights=part[entry], minlength=n_queries * n).reshape(n_queries, n)
    scores[scores <= 0] = -np.inf
    return scores


def _scan_keywords(candidates: DataFrame, weights: _TermWeights, k: int, key: str, schema) -> DataFrame:
    """Each task scores its chunks against all queries and keeps k rows per query: pairs never become rows."""
    # Broadcasts are pickled plainly, so no class of this package may go along.
    sent = candidates.sparkSession.sparkContext.broadcast(tuple(weights))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = _TermWeights(*sent.value)
        best = _Best(len(weights.query_ids), k)
        for batch in batches:
            for block in _blocks(batch, best.block):
                best.add(block.column(key), _bm25(block, weights))
        yield from best.batches(weights.query_ids, schema.names)

    return candidates.mapInArrow(score, schema)


def _asked_postings(candidates: DataFrame, blocks: list[_TermWeights]) -> DataFrame:
    """The candidates, written once for several scans: only chunks and postings of terms that some block asks for.

    Beyond ``BROADCAST_TERMS`` distinct terms all postings are kept. The scans together keep all slots busy, so the more
    there are, the fewer tasks each has: what they send on is k rows for each task and query.
    """
    spark = candidates.sparkSession
    tasks = -(-2 * spark.sparkContext.defaultParallelism // len(blocks))
    terms = pc.unique(pa.concat_arrays([b.terms for b in blocks]))
    if len(terms) <= BROADCAST_TERMS:
        sent = spark.sparkContext.broadcast(terms)

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = batch.column("terms")
                lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
                asked = pc.is_in(lists.flatten(), value_set=sent.value)
                row = np.repeat(np.arange(len(lists)), lengths)[asked.to_numpy(zero_copy_only=False)]
                offsets = pa.array(np.r_[0, np.cumsum(np.bincount(row, minlength=len(lists)))].astype(np.int32))
                found = {c: pa.ListArray.from_arrays(offsets, batch.column(c).flatten().filter(asked)) for c in ("terms", "tfs")}
                columns = [found.get(name, batch.column(name)) for name in batch.schema.names]
                yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

        candidates = candidates.where("terms is not null").mapInArrow(keep, candidates.schema).where("size(terms) > 0")
    return write_snapshot(candidates, new_run_folder(spark, "candidates")).coalesce(tasks)


def _document_frequencies(index: DataFrame, vocabulary: DataFrame | None) -> DataFrame:
    """Number of chunks of each term, counted within tasks before they meet; of a small vocabulary only."""
    pairs = postings(index)
    if vocabulary is not None:
        pairs = pairs.join(F.broadcast(vocabulary), "term", "left_semi")
    return pairs.groupBy("term").agg(F.count("*").alias("df"))


def term_weights(
    queries: DataFrame, statistics: DataFrame | None, query_id: str, text: str, max_broadcast: int,
    index: DataFrame | None = None,
) -> Iterator[tuple[pa.Array, _TermWeights, np.ndarray]]:
    """For each block of queries their ids, the weights of their terms, and the number of chunks of each term.

    ``statistics`` are those of the whole index; without them the index is counted. Terms that no chunk has are
    left out, and so are queries without any other. A block has at most ``max_broadcast`` terms.
    """
    if statistics is None:
        corpus = index.agg(F.count("*").alias("n"), F.avg("doc_len").alias("length")).first()
        n, average = corpus["n"], corpus["length"]
    else:
        n, average = totals(statistics)
    if not average:
        return
    terms = query_terms(queries, query_id, text)
    size = terms.agg(F.count("*").alias("terms"), F.count_distinct(query_id).alias("queries")).first()
    vocabulary = terms.select("term").distinct()
    few = size["terms"] <= BROADCAST_TERMS
    if statistics is not None:
        df = statistics.select("term", "df")
        df = df.join(F.broadcast(vocabulary) if few else vocabulary, "term", "left_semi")
    elif few:
        df = _document_frequencies(index, vocabulary)
    else:
        df = _document_frequencies(index, None).join(vocabulary, "term", "left_semi")
    weights = terms.join(df, "term").select(query_id, "term", "df")
    parts = max(-(-size["terms"] // max(max_broadcast, 1)), -(-size["queries"] // BROADCAST_QUERIES))
    for block in query_blocks(weights, query_id, parts):
        rows = block.toArrow()
        if rows.num_rows:
            ids, words, counts = (rows.column(c).combine_chunks() for c in (query_id, "term", "df"))
            counts = counts.to_numpy().astype(np.float64)
            sent = _term_weights(ids, words, np.log(1.0 + (n - counts + 0.5) / (counts + 0.5)), average)
            of_term = np.zeros(len(sent.terms), np.int64)
            of_term[pc.index_in(words, value_set=sent.terms).to_numpy()] = counts.astype(np.int64)
            yield sent.query_ids, sent, of_term


def keyword_search(
    queries: DataFrame,
    index: DataFrame,
    k: int = K,
    filters: list[dict[str, Any]] | None = None,
    query_id: str = "query_id",
    text: str = "text",
    key: str = "chunk_id",
    max_broadcast: int = BROADCAST_TERMS,
    statistics: DataFrame | None = None,
) -> DataFrame:
    """BM25. Filters hold before ranking; term weights and lengths always come from the whole index.

    With the kept ``statistics`` of the index no posting is counted; without them the terms of the queries are
    counted first, within tasks before they meet, so a term of every chunk gathers nowhere. Each block of at most
    ``max_broadcast`` query terms is one scan; of several, the index is read once and what they need of it is written.
    """
    candidates = apply_filters(index, filters).select(key, "doc_len", "terms", "tfs")
    schema = _ranked_schema(queries, index, query_id, key)
    refuse_repeats(queries, query_id)
    blocks = [sent for _, sent, _ in term_weights(queries, statistics, query_id, text, max_broadcast, index)]
    if len(blocks) > 1:
        candidates = _asked_postings(candidates, blocks)
    scans = [_scan_keywords(candidates, sent, k, key, schema) for sent in blocks]
    if not scans:
        return _no_hits(index, schema)
    return top_k(reduce(DataFrame.unionByName, scans), k, query_id, key, SPREAD)


def _no_hits(index: DataFrame, schema: T.StructType) -> DataFrame:
    return index.sparkSession.createDataFrame([], schema).withColumn("rank", F.lit(1))


def fuse(
    first: DataFrame, second: DataFrame, k: int = K, query_id: str = "query_id", key: str = "chunk_id"
) -> DataFrame:
    """Reciprocal rank fusion of two ranked lists. Both hold at most k rows per query."""
    a = first.select(query_id, key, F.col("rank").alias("vector_rank"))
    b = second.select(query_id, key, F.col("rank").alias("keyword_rank"))

    def share(rank: str):
        return F.coalesce(1.0 / (RRF_K + F.col(rank)), F.lit(0.0))

    both = a.join(b, [query_id, key], "full_outer").withColumn(
        "score", F.round(share("vector_rank") + share("keyword_rank"), FUSED_DIGITS)
    )
    return top_k(both, k, query_id, key).select(query_id, key, "score", "vector_rank", "keyword_rank", "rank")


def hybrid_search(
    queries: DataFrame,
    index: DataFrame,
    k: int = K,
    filters: list[dict[str, Any]] | None = None,
    query_id: str = "query_id",
    text: str = "text",
    key: str = "chunk_id",
    dim: int = DIM,
    statistics: DataFrame | None = None,
) -> DataFrame:
    """Vector and keyword search over the same filtered chunks, fused. Query vectors are made unless given."""
    embedded = queries if "embedding" in queries.columns else embed(queries, text, dim)
    by_vector = similarity_search(embedded, index, k, filters, query_id, key)
    by_keyword = keyword_search(queries, index, k, filters, query_id, text, key, statistics=statistics)
    return fuse(by_vector, by_keyword, k, query_id, key)


def with_columns(
    hits: DataFrame, chunks: DataFrame, columns: list[str], key: str = "chunk_id", max_chars: int | None = None,
    text: str = "chunk_text", queries: DataFrame | None = None, k: int = K,
) -> DataFrame:
    """Bring result columns to the ranked keys, after ranking.

    Hits are at most k per query: given the query table, its rows are counted, and when queries times k are few
    enough the hits are sent to the wide chunk table, which then is not shuffled.
    """
    wanted = [c for c in columns if c != key]
    rows = chunks.select(key, *wanted)
    if max_chars is not None and text in wanted:
        rows = rows.withColumn(text, F.left(F.col(text), F.lit(max_chars)))
    most = BROADCAST_HITS // max(k, 1)
    few = queries is not None and queries.limit(most + 1).count() <= most
    return rows.join(F.broadcast(hits) if few else hits, key).select(*hits.columns, *wanted)


def result_envelope(
    queries: DataFrame,
    hits: DataFrame,
    columns: list[str],
    query_id: str = "query_id",
    as_json: bool = False,
    k: int = K,
) -> DataFrame:
    """One row per query: status OK or NO_RESULTS, num_results and the documents by rank.

    A query has at most k documents, so its list is bounded. ``as_json`` gives the same as one string.
    """
    listed = (
        hits.where(F.col("rank") <= k)
        .groupBy(query_id)
        .agg(F.array_sort(F.collect_list(F.struct("rank", *columns))).alias("docs"))
    )
    docs = F.coalesce(F.transform("docs", lambda d: F.struct(*[d[c].alias(c) for c in columns])), F.array())
    rows = queries.select(query_id).join(listed, query_id, "left").withColumn("docs", docs)
    result = rows.select(
        query_id,
        F.when(F.size("docs") > 0, "OK").otherwise("NO_RESULTS").alias("status"),
        F.size("docs").alias("num_results"),
        "docs",
    )
    if not as_json:
        return result
    return result.select(query_id, F.to_json(F.struct("status", "num_results", "docs")).alias("result"))
