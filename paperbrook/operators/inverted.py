"""A stored inverted file of an index, and keyword search that skips the blocks of it that cannot matter.

Chunks are numbered in the order of their keys. The postings of a term are cut at segments, so many chunk numbers in a
row, and each part into blocks of ``BLOCK`` postings: the first number, gaps to the following ones, counts and
chunk lengths, with the most that the block can add to a score but for the term's weight, at the mean length of the
time. Rows lie in folders by a hash of the term. A term of every chunk is as many parts as there are segments, and
no part is larger than a segment.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paperbrook.functions.ids import salt
from paperbrook.operators.filters import apply_filters
from paperbrook.operators.index import META
from paperbrook.operators.search import (
    B, BROADCAST_HITS, BROADCAST_TERMS, K, K1, SCORE_DIGITS, SPREAD, refuse_repeats, term_weights, top_k,
)
from paperbrook.session import new_run_folder
from paperbrook.sources.tables import write_snapshot

# Chunk numbers of a segment and of a window within it (powers of two), postings of a block, folders by term.
SEGMENT_BITS, WINDOW_BITS, BLOCK, BUCKETS = 14, 4, 64, 32
# Files of one folder at most, so that a very frequent term is written by several tasks.
FILES = 8
# A first floor in a segment comes from a query's rarest terms, until they have so many times k postings there; so many
# times k chunks that have most of them are scored in full.
RARE, FULL = 16, 2
BLOCKS = (
    "term string, seg bigint, first bigint, last bigint, n int, gaps array<int>, tfs array<int>, lens array<int>, "
    "best double, average double, bucket int"
)
# Blocks that are decoded together.
DECODED = 4096
ROUNDING = 0.6 * 10.0**-SCORE_DIGITS


@dataclass(frozen=True)
class Inverted:
    """The folders of an inverted file: ``docs`` (doc, key, columns to filter by) and ``blocks`` by bucket."""

    spark: SparkSession
    folder: str
    key: str = "chunk_id"
    buckets: int = BUCKETS

    def docs(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/docs").drop("terms", "tfs")

    def blocks(self, terms: list[str] | None = None) -> DataFrame:
        """All blocks, or those in the folders of ``terms``."""
        rows = self.spark.read.schema(BLOCKS).parquet(f"{self.folder}/blocks")
        if terms is None:
            return rows
        wanted = self.spark.createDataFrame([(t,) for t in terms], "term string").select(bucket_of(F.col("term"), self.buckets)).distinct()
        return rows.where(F.col("bucket").isin([r[0] for r in wanted.collect()]))

    def postings(self, carry: list[str] | None = None) -> DataFrame:
        """(term, doc, tf, doc_len), decoded, and columns of ``docs`` that are named.

        For these the blocks as they are meet the rows of their segment's chunks; no decoded posting is moved.
        """
        carry = [c for c in carry or [] if c != "doc_len"]
        blocks = self.blocks().select("seg", "term", "first", "gaps", "tfs", "lens")
        kept = "term string, doc bigint, tf int, doc_len int"
        names = ["term", "doc", "tf", "doc_len"]
        if not carry:

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for rows in (batch.slice(at, DECODED) for at in range(0, batch.num_rows, DECODED)):
                        yield pa.RecordBatch.from_arrays([*_decoded(rows), rows.column("lens").flatten()], ["term", "doc", "tf", "doc_len"])

            return blocks.mapInArrow(run, kept)

        docs = self.docs().select(F.shiftright("doc", SEGMENT_BITS).alias("seg"), F.col("doc").alias("first"), "doc_len", *carry)
        fields = {f.name: f for f in docs.schema}

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seg, held, known = None, [], None
            for batch in batches:
                for rows in (batch.slice(at, DECODED) for at in range(0, batch.num_rows, DECODED)):
                    segs = rows.column("seg").to_numpy()
                    cuts = [0, *(np.flatnonzero(np.diff(segs)) + 1).tolist(), len(segs)]
                    for a, b in zip(cuts, cuts[1:]):
                        if segs[a] != seg:
                            seg, held, known = segs[a], [], None
                        part = rows.slice(a, b - a)
                        chunks = part.filter(part.column("term").is_null())
                        if chunks.num_rows:
                            held.append(chunks.select(["first", "doc_len", *carry]))
                        part = part.filter(part.column("term").is_valid())
                        if not part.num_rows or not held:
                            continue
                        if known is None:
                            known = pa.Table.from_batches(held).sort_by("first").combine_chunks()
                            numbers = known.column("first").to_numpy()
                        terms, docs, tfs = _decoded(part)
                        at = np.minimum(np.searchsorted(numbers, docs.to_numpy()), len(numbers) - 1)
                        found = known.take(pa.array(at)).combine_chunks().to_batches()[0]
                        columns = [terms, docs, tfs, *(found.column(c) for c in ("doc_len", *carry))]
                        yield pa.RecordBatch.from_arrays(columns, [*names, *carry])

        both = blocks.drop("lens").unionByName(docs, allowMissingColumns=True)
        dealt = both.repartition("seg").sortWithinPartitions("seg", F.col("term").isNotNull())
        more = [f"{c} {fields[c].dataType.simpleString()}" for c in carry]
        return dealt.mapInArrow(meet, ", ".join([kept, *more]))


def _decoded(rows: pa.RecordBatch) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Term, chunk number and count of each posting of some blocks."""
    n = pc.list_value_length(rows.column("gaps")).to_numpy(zero_copy_only=False).astype(np.int64)
    sums = np.cumsum(rows.column("gaps").flatten().to_numpy().astype(np.int64))
    head = np.cumsum(n) - n  # a block's first gap is zero
    docs = sums + np.repeat(rows.column("first").to_numpy() - sums[head], n)
    terms = rows.column("term").take(pa.array(np.repeat(np.arange(len(n)), n)))
    return terms, pa.array(docs), rows.column("tfs").flatten()


def bucket_of(term: Column, buckets: int) -> Column:
    return salt(term, buckets).alias("bucket")


def _block_rows(docs: DataFrame, average: float) -> DataFrame:
    """The blocks of a table of numbered chunks, as they stand in its files: a segment is inverted in one task, or each
    part of it where a scan cuts it, and no posting is moved. Ranges of numbers of a term's blocks never overlap."""
    bits, size = SEGMENT_BITS, BLOCK

    def blocks_of(table: pa.Table) -> pa.RecordBatch:
        lists = table.column("terms").combine_chunks()
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        found = lists.flatten().dictionary_encode()
        code = found.indices.to_numpy()
        doc = np.repeat(table.column("doc").to_numpy(), lengths)
        order = np.lexsort((doc, code))
        code, doc = code[order], doc[order]
        tf = table.column("tfs").combine_chunks().flatten().to_numpy()[order]
        length = np.repeat(table.column("doc_len").to_numpy(), lengths)[order]
        begins = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, np.int64)
        within = np.arange(len(code)) - np.repeat(begins, np.diff(np.r_[begins, len(code)]))
        start = np.flatnonzero(within % size == 0)
        gaps = np.diff(doc, prepend=doc[:1])
        gaps[start] = 0
        offsets = np.r_[start, len(code)].astype(np.int32)
        best = np.maximum.reduceat(_part(tf.astype(float), length, average), start) if len(start) else np.zeros(0)

        def lists_of(values: np.ndarray) -> pa.ListArray:
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))

        columns = [
            found.dictionary.take(pa.array(code[start])), pa.array(doc[start] >> bits), pa.array(doc[start]), pa.array(doc[offsets[1:] - 1]),
            pa.array(np.diff(offsets)), lists_of(gaps), lists_of(tf), lists_of(length), pa.array(best), pa.array(np.full(len(start), average)),
        ]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in BLOCKS.split(", ")[:-1]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        seg = None
        for batch in batches:
            segs = batch.column("doc").to_numpy() >> bits
            cuts = [0, *(np.flatnonzero(np.diff(segs)) + 1).tolist(), len(segs)]
            for a, b in zip(cuts, cuts[1:]):
                if held and segs[a] != seg:
                    yield blocks_of(pa.Table.from_batches(held))
                    held = []
                if b > a:
                    seg = segs[a]
                    held.append(batch.slice(a, b - a))
        if held:
            yield blocks_of(pa.Table.from_batches(held))

    return docs.select("doc", "doc_len", "terms", "tfs").mapInArrow(run, BLOCKS.rsplit(", ", 1)[0])


def write_inverted(
    index: DataFrame, folder: str, key: str = "chunk_id", carry: list[str] = META, buckets: int = BUCKETS
) -> Inverted:
    """Number the chunks of an index by key and write its postings by term. Keys must stand once and not be null."""
    ordered = index.select(key, *carry, "doc_len", "terms", "tfs").orderBy(key)
    docs = write_snapshot(ordered.withColumn("doc", F.monotonically_increasing_id()), f"{folder}/docs")
    average = docs.agg(F.coalesce(F.avg("doc_len"), F.lit(0.0))).first()[0] or 1.0
    rows = _block_rows(docs, average).withColumn("bucket", bucket_of(F.col("term"), buckets))
    dealt = rows.repartition("bucket", F.col("seg") % FILES).sortWithinPartitions("bucket", "term", "first")
    write_snapshot(dealt, f"{folder}/blocks", ["bucket"])
    return Inverted(index.sparkSession, folder, key, buckets)


class _Segment(NamedTuple):
    """Blocks of one segment by term: where each term's blocks begin, and the flat lists of all blocks."""

    term: np.ndarray
    first: np.ndarray
    last: np.ndarray
    start: np.ndarray
    gaps: np.ndarray
    tfs: np.ndarray
    lens: np.ndarray
    bound: np.ndarray
    allowed: np.ndarray | None

    def blocks_of(self, term: int) -> slice:
        return slice(*np.searchsorted(self.term, [term, term + 1]))


def _part(tf: np.ndarray, length: np.ndarray, average: float) -> np.ndarray:
    return tf * (K1 + 1.0) / (tf + K1 * (1.0 - B + B * length / average))


class _Scorer:
    """Scores one segment for one query after another; decoded lists and bounds of a term serve all of them."""

    def __init__(self, segment: _Segment, idf: np.ndarray, average: float, base: int):
        self.segment, self.base, self.idf, self.average = segment, base, idf, average
        self.bounds: dict[int, np.ndarray] = {}
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.scored = 0

    def bound(self, term: int) -> np.ndarray:
        """The most that the term can add to a score, for each window."""
        if term not in self.bounds:
            found = np.zeros(1 << (SEGMENT_BITS - WINDOW_BITS))
            own = self.segment.blocks_of(term)
            low = (self.segment.first[own] - self.base) >> WINDOW_BITS
            high = (self.segment.last[own] - self.base) >> WINDOW_BITS
            for a, b, most in zip(low, high, self.segment.bound[own] * self.idf[term], strict=True):
                np.maximum(found[a : b + 1], most, out=found[a : b + 1])
            self.bounds[term] = found
        return self.bounds[term]

    def listed(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """Places in the segment and what the term adds there."""
        if term not in self.lists:
            s, own = self.segment, self.segment.blocks_of(term)
            low, high = s.start[own.start], s.start[own.stop]
            gaps = s.gaps[low:high].astype(np.int64)
            head = s.start[own] - low  # a block's first gap is zero: put the distance to the block before there
            sums = np.cumsum(gaps)
            lengths = np.diff(np.append(head, high - low))
            places = sums - np.repeat(sums[head], lengths) + np.repeat(s.first[own] - self.base, lengths)
            self.lists[term] = places, self.idf[term] * _part(s.tfs[low:high].astype(float), s.lens[low:high], self.average)
        return self.lists[term]

    def likely(self, terms: list[int], k: int) -> np.ndarray:
        """Full scores of chunks that have much of the rarest terms."""
        partial, used = np.zeros(1 << SEGMENT_BITS), 0
        for t in sorted(terms, key=lambda t: len(self.listed(t)[0])):
            places, parts = self.listed(t)
            if used >= RARE * k:
                break
            partial[places] += parts
            used += len(places)
        if self.segment.allowed is not None:
            partial[~self.segment.allowed] = 0.0
        top = np.sort(np.argpartition(-partial, FULL * k)[: FULL * k]) if FULL * k < len(partial) else np.arange(len(partial))
        top = top[partial[top] > 0]
        full = np.zeros(len(top))
        self.scored += used
        for t in terms:
            places, parts = self.listed(t)
            at = np.minimum(np.searchsorted(places, top), len(places) - 1)
            there = places[at] == top
            self.scored += int(there.sum())
            full[there] += parts[at[there]]
        return full

    def hits(self, terms: list[int], floor: float) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of all chunks of the segment that may score ``floor`` or more.

        Windows whose bounds add up to less are left out. Long lists of small bounds find no chunk of their own, as
        long as they cannot reach the floor together: they only add to chunks that the others have found and that what
        is left can still lift to the floor.
        """
        bounds = np.array([self.bound(t) for t in terms])
        live = bounds.sum(0) >= floor
        most = bounds[:, live].max(1, initial=0.0)
        sizes = np.array([len(self.listed(t)[0]) for t in terms])
        helpers, room = [], floor
        for t in np.argsort(most / sizes, kind="stable"):
            if most[t] < room:
                helpers.append(t)
                room -= most[t]
        score = np.zeros(1 << SEGMENT_BITS)
        for t in np.setdiff1d(np.arange(len(terms)), helpers):
            places, parts = self.listed(terms[t])
            chosen = live[places >> WINDOW_BITS]
            self.scored += int(chosen.sum())
            score[places[chosen]] += parts[chosen]
        if self.segment.allowed is not None:
            score[~self.segment.allowed] = 0.0
        rest = np.cumsum(bounds[helpers], axis=0)
        for at in range(len(helpers) - 1, -1, -1):
            found = np.flatnonzero(score)
            low = found[score[found] + rest[at][found >> WINDOW_BITS] < floor]
            score[low] = 0.0
            places, parts = self.listed(terms[helpers[at]])
            chosen = score[places] > 0
            self.scored += int(chosen.sum())
            score[places[chosen]] += parts[chosen]
        places = np.flatnonzero(score > 0)
        places = places[score[places] >= floor]
        return places, score[places]


def _segments(batches: Iterator[pa.RecordBatch], terms: pa.Array, average: float) -> Iterator[tuple[int, _Segment]]:
    """The segments of one task, whose rows stand together; rows without a term say which chunks are allowed."""
    held: list[pa.RecordBatch] = []

    def close() -> tuple[int, _Segment]:
        rows = pa.Table.from_batches(held).combine_chunks()
        seg = rows.column("seg")[0].as_py()
        allowed = None
        marks = rows.filter(rows.column("term").is_null())
        if marks.num_rows:
            allowed = np.zeros(1 << SEGMENT_BITS, bool)
            allowed[marks.column("gaps").combine_chunks().flatten().to_numpy()] = True
        rows = rows.filter(rows.column("term").is_valid())
        code = pc.index_in(rows.column("term"), value_set=terms).to_numpy()
        first = rows.column("first").to_numpy()
        order = np.lexsort((first, code))
        rows = rows.take(pa.array(order)).combine_chunks()
        flat = [rows.column(c).combine_chunks().flatten().to_numpy() if rows.num_rows else np.zeros(0, int) for c in ("gaps", "tfs", "lens")]
        start = np.append(0, np.cumsum(rows.column("n").to_numpy()))
        # A longer mean length raises a score by no more than its own growth.
        growth = np.maximum(1.0, average / rows.column("average").to_numpy()) * (1.0 + 1e-9)
        bound = rows.column("best").to_numpy() * growth
        return seg, _Segment(code[order], first[order], rows.column("last").to_numpy(), start, *flat, bound, allowed)

    for batch in batches:
        segs = batch.column("seg").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(segs)) + 1).tolist(), len(segs)]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if held and held[-1].column("seg")[0].as_py() != segs[a]:
                yield close()
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield close()


def _scan(blocks: DataFrame, weights: Any, k: int) -> DataFrame:
    """(query, doc, score): the k best of each task for each query; and a row without query with the postings scored.

    Chunks are numbered in the order of their keys, so ties go to the smaller number. A task's floor for a query is the
    k-th score found in earlier segments, or in the first one among its likely chunks: only better ones matter.
    """
    order = np.argsort(weights.queries, kind="stable")
    of_entry = np.repeat(np.arange(len(weights.terms)), np.diff(weights.first))[order]
    asked = np.split(of_entry, np.searchsorted(weights.queries[order], np.arange(1, len(weights.query_ids))))
    sent = blocks.sparkSession.sparkContext.broadcast((weights.terms, weights.idf, [a.tolist() for a in asked], weights.average))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, idf, asked, average = sent.value
        best = [(np.zeros(0, np.int64), np.zeros(0)) for _ in asked]
        scored = 0
        for seg, segment in _segments(batches, terms, average):
            base = seg << SEGMENT_BITS
            scorer = _Scorer(segment, idf, average, base)
            there = set(segment.term.tolist())
            for q, wanted in enumerate(asked):
                present = [t for t in wanted if t in there]
                if not present:
                    continue
                known = best[q][1] if len(best[q][1]) == k else np.append(best[q][1], scorer.likely(present, k))
                floor = np.partition(known, len(known) - k)[len(known) - k] - ROUNDING if len(known) >= k else 0.0
                places, scores = scorer.hits(present, max(floor, 0.0))
                scaled = scores * 10.0**SCORE_DIGITS
                scores = np.trunc(scaled + 0.5) / 10.0**SCORE_DIGITS
                docs, scores = np.append(best[q][0], places + base), np.append(best[q][1], scores)
                top = np.lexsort((docs, -scores))[:k]
                best[q] = docs[top], scores[top]
            scored += scorer.scored
        queries = np.repeat(np.arange(len(best)), [len(d) for d, _ in best])
        columns = [np.append(-1, queries), np.concatenate([[scored], *(d for d, _ in best)]), np.concatenate([[0.0], *(s for _, s in best)])]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(columns[1].astype(np.int64)), pa.array(columns[2])], ["query", "doc", "score"])

    dealt = blocks.drop("bucket").repartition("seg").sortWithinPartitions("seg")
    return dealt.mapInArrow(run, "query bigint, doc bigint, score double")


def pruned_keyword_search(
    queries: DataFrame,
    inverted: Inverted,
    statistics: DataFrame,
    k: int = K,
    filters: list[dict[str, Any]] | None = None,
    query_id: str = "query_id",
    text: str = "text",
    max_broadcast: int = BROADCAST_TERMS,
) -> tuple[DataFrame, DataFrame]:
    """The hits of :func:`search.keyword_search` from a stored inverted file, and how much of it was scored.

    Only the folders of query terms are read, and of those only rows of the terms, which meet by segment. There every
    window of chunks whose bounds stay below the k-th score known so far is left out. Filters hold before ranking.
    The second table has the postings of all query terms, as often as queries ask for them, and those that were
    scored.
    """
    spark = queries.sparkSession
    refuse_repeats(queries, query_id)
    docs = inverted.docs()
    found = []
    for ids, weights, df in term_weights(queries, statistics, query_id, text, max_broadcast):
        terms = weights.terms.to_pylist()
        vocabulary = spark.createDataFrame([(t,) for t in terms], "term string")
        rows = inverted.blocks(terms).join(F.broadcast(vocabulary), "term", "left_semi")
        if filters:
            place = (F.col("doc") % (1 << SEGMENT_BITS)).cast("int")
            marks = apply_filters(docs, filters).groupBy(F.shiftright("doc", SEGMENT_BITS).alias("seg")).agg(F.collect_list(place).alias("gaps"))
            # segments without an allowed chunk have no mark and go; were both dealt by segment for this, Spark would leave
            # out the dealing of the scan, and then read each side where it lies, which cuts segments apart
            rows = rows.join(F.broadcast(marks.select("seg")), "seg", "left_semi").unionByName(marks, allowMissingColumns=True)
        scanned = write_snapshot(_scan(rows, weights, k), new_run_folder(spark, "scan"))
        names = spark.createDataFrame(pa.table({"query": np.arange(len(ids)), query_id: ids}))
        total = int((df * np.diff(weights.first)).sum())
        found.append((scanned, names, total, len(ids)))
    hits = None
    counts = []
    for scanned, names, total, n in found:
        ranked = top_k(scanned.where("query >= 0"), k, "query", "doc", SPREAD).join(F.broadcast(names), "query")
        hits = ranked if hits is None else hits.unionByName(ranked)
        scored = scanned.where("query < 0").agg(F.sum("doc")).first()[0]
        counts.append((total, scored or 0))
    report = spark.createDataFrame([(sum(c[0] for c in counts), sum(c[1] for c in counts))], "postings bigint, scored bigint")
    kind = queries.schema[query_id].dataType
    if hits is None:
        empty = docs.select(F.lit(None).cast(kind).alias(query_id), inverted.key, F.lit(0.0).alias("score"), F.lit(1).alias("rank"))
        return empty.limit(0), report
    few = sum(n for *_, n in found) * k <= BROADCAST_HITS
    keyed = docs.select("doc", inverted.key).join(F.broadcast(hits) if few else hits, "doc")
    return keyed.select(F.col(query_id).cast(kind).alias(query_id), inverted.key, "score", "rank"), report
