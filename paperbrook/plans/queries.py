"""The registered queries: every operator run over whole tables.

Documents are given folders of the shape ``/corpus/<category>/<year>/<month>/<id>.txt``.
Two listings a day apart differ by whole sources: one has gone, one has come, one was revised.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperbrook.functions import paths, text
from paperbrook.operators import approx, chunk_store, chunking, digests, filters, inverted, quality, reports, search, skipping, statistics, tracking
from paperbrook.operators.embedding import DIM, embed
from paperbrook.operators.index import build_index, postings, sync_index
from paperbrook.plans.corpus import Corpus
from paperbrook.session import new_run_folder
from paperbrook.sources.feed import append_feed, stream_feed
from paperbrook.sources.files import list_files, read_contents, write_text_files
from paperbrook.sources.schemas import TRACKING
from paperbrook.sources.tables import balance, empty_tracking, write_bucketed, write_snapshot
from paperbrook.streaming.files import index_feed, index_stream, latest_batch, stream_new_files, track_stream

Query = Callable[[SparkSession, str], DataFrame]

ROOT = "/corpus/"
GONE_SOURCE, REVISED_SOURCE, NEW_SOURCE = "src0", "src7", "src19"
START = datetime(2024, 1, 1, tzinfo=timezone.utc)
INDEXED_AT = datetime(2024, 2, 1, tzinfo=timezone.utc)
TRACK_BUCKETS = 8
FOLDER_MONTHS = ["Jan", "February", "SEP", "sept", "December", "May"]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Inputs


def folder_path() -> Column:
    category = F.when(F.col("lang") == "en", "Housing").otherwise("Construction")
    month = F.element_at(F.array(*[F.lit(m) for m in FOLDER_MONTHS]), (F.col("doc_id") % 6 + 1).cast("int"))
    year = (2023 + F.col("doc_id") % 3).cast("string")
    return F.concat(
        F.lit(ROOT), category, F.lit("/"), year, F.lit("/"), month, F.lit("/"), F.col("doc_id").cast("string"),
        F.lit(".txt"),
    )


def listing(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    """Day one lacks one source; day two lacks another and has newer files of a third."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    docs = docs.where(F.col("source") != (NEW_SOURCE if day == 1 else GONE_SOURCE))
    minutes = F.col("doc_id") % 1000
    if day == 2:
        minutes = minutes + (F.col("source") == REVISED_SOURCE).cast("int")
    files = docs.select(
        folder_path().alias("path"),
        F.col("n_chars").alias("length"),
        (F.lit(START) + F.make_dt_interval(mins=minutes.cast("int"))).alias("modification_ts"),
        F.lit(START).alias("ingest_ts"),
    )
    return paths.path_metadata(files, ROOT)


def minutes(column: str) -> Column:
    return ((F.unix_seconds(column) - int(START.timestamp())) / 60).cast("bigint")


def day_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tracking table after day one, every file indexed."""
    track = tracking.track_sync(empty_tracking(spark), listing(spark, sf_dir, 1))
    return tracking.track_mark_indexed(track, tracking.to_index(track), INDEXED_AT)


def day_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.track_sync(day_one(spark, sf_dir), listing(spark, sf_dir, 2))


def track_rows(track: DataFrame) -> DataFrame:
    return track.select(
        "path", "length", minutes("modification_ts").alias("mtime"), "category", "year", "month", "status",
        "version", "is_current", F.col("indexed_at").isNotNull().alias("indexed"),
    )


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a file with its text."""
    docs = balance(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"))
    rows = docs.select(folder_path().alias("path"), F.lit(1).cast("bigint").alias("version"), "source", "text")
    return paths.path_metadata(rows, ROOT)


def of_source(files: DataFrame, *sources: str) -> DataFrame:
    return files.where(F.col("source").isin(*sources))


def not_of_source(files: DataFrame, source: str) -> DataFrame:
    return files.where(F.col("source") != source)


def old_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk table of day one."""
    return chunking.make_chunks(not_of_source(files(spark, sf_dir), NEW_SOURCE), fixed=True)


def day_two_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk table of the files listed on day two."""
    return chunking.make_chunks(not_of_source(files(spark, sf_dir), GONE_SOURCE), fixed=True)


def revised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of the new and the revised source; the revised ones have lost their case and are at version 2."""
    rows = of_source(files(spark, sf_dir), REVISED_SOURCE, NEW_SOURCE)
    changed = F.col("source") == REVISED_SOURCE
    return rows.withColumns({
        "version": F.when(changed, 2).otherwise(1).cast("bigint"),
        "text": F.when(changed, F.lower("text")).otherwise(F.col("text")),
    })


def new_chunks(spark: SparkSession, sf_dir: str, version_in_id: bool = True) -> DataFrame:
    rows = revised(spark, sf_dir)
    if not version_in_id:
        rows = rows.withColumn("version", F.lit(1).cast("bigint"))
    return chunking.make_chunks(rows, fixed=True)


def chunk_rows(chunks: DataFrame, *more: str) -> DataFrame:
    return chunks.select("path", "chunk_id", "chunk_text", "category", "year", "month", *more)


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balance(table(spark, sf_dir, "embeddings")).select(F.col("vec_id").alias("chunk_id"), "embedding", "label")


def vector_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("query_id"), "embedding")


_written: dict[tuple[str, str, str], DataFrame] = {}


def written_once(spark: SparkSession, sf_dir: str, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A table in the shared folder, written by the first query of an application that asks for it."""
    at = (spark.sparkContext.applicationId, sf_dir, label)
    if at not in _written:
        _written[at] = write_snapshot(build(), new_run_folder(spark, label))
    return _written[at]


def written_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written_once(spark, sf_dir, "chunks", lambda: chunking.make_chunks(files(spark, sf_dir), fixed=True))


def written_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index over all chunks, as a search would find it."""
    return written_once(spark, sf_dir, "index", lambda: build_index(written_chunks(spark, sf_dir)))


def written_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Term statistics of that index, as a run keeps them."""
    return written_once(spark, sf_dir, "statistics", lambda: statistics.index_statistics(written_index(spark, sf_dir)))


def written_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hashed index of the vectors, sorted by table and code, so that a scan leaves out row groups without any."""
    return written_once(spark, sf_dir, "codes", lambda: approx.hash_vectors(vectors(spark, sf_dir), DIM).repartition("lsh_table").sortWithinPartitions("lsh_table", "lsh_code"))


_inverted: dict[tuple[str, str], inverted.Inverted] = {}


def written_inverted(spark: SparkSession, sf_dir: str) -> inverted.Inverted:
    """The inverted file of that index."""
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _inverted:
        _inverted[at] = inverted.write_inverted(written_index(spark, sf_dir), new_run_folder(spark, "inverted"))
    return _inverted[at]


def ranked(hits: DataFrame, *more: str) -> DataFrame:
    return hits.select("query_id", "chunk_id", "score", F.col("rank").cast("bigint").alias("rank"), *more)


# Tracking


@query
def track_status_by_category(spark, sf_dir):
    return reports.category_status_counts(day_two(spark, sf_dir))


@query
def track_status(spark, sf_dir):
    return reports.status_counts(day_two(spark, sf_dir))


@query
def track_sync(spark, sf_dir):
    return track_rows(reports.full_report(day_two(spark, sf_dir)))


@query
def track_sync_bucketed(spark, sf_dir):
    """The same merge into a table in buckets by path, whose next version is written in buckets too."""
    old = write_bucketed(day_one(spark, sf_dir), new_run_folder(spark, "tracked"), "path", TRACK_BUCKETS)
    new = tracking.track_sync_bucketed(old, listing(spark, sf_dir, 2), TRACK_BUCKETS)
    return track_rows(write_bucketed(new, new_run_folder(spark, "tracked"), "path", TRACK_BUCKETS, dealt=True))


@query
def track_upsert(spark, sf_dir):
    return track_rows(tracking.track_upsert(day_one(spark, sf_dir), listing(spark, sf_dir, 2)))


@query
def track_mark_deleted(spark, sf_dir):
    return track_rows(tracking.track_mark_deleted(day_one(spark, sf_dir), listing(spark, sf_dir, 2)))


@query
def track_deleted_paths(spark, sf_dir):
    return tracking.deleted_paths(day_one(spark, sf_dir), listing(spark, sf_dir, 2))


@query
def track_mark_indexed(spark, sf_dir):
    track = day_two(spark, sf_dir)
    return track_rows(tracking.track_mark_indexed(track, tracking.to_index(track), INDEXED_AT))


@query
def track_revive(spark, sf_dir):
    """Day one's files come back unchanged: still deleted as the rule stands, updated when revived."""
    track, back = day_two(spark, sf_dir), listing(spark, sf_dir, 1)
    reports_ = [
        reports.status_counts(tracking.track_sync(track, back, revive=revive)).withColumn("revive", F.lit(revive))
        for revive in (False, True)
    ]
    return reports_[0].unionByName(reports_[1])


@query
def files_to_index(spark, sf_dir):
    return tracking.to_index(day_two(spark, sf_dir)).select("path", "status", "version")


@query
def files_to_index_full_refresh(spark, sf_dir):
    return tracking.to_index(day_two(spark, sf_dir), full_refresh=True).select("path", "status", "version")


@query
def files_to_delete(spark, sf_dir):
    return tracking.to_delete(day_two(spark, sf_dir)).select("path", "status", "version")


@query
def run_metrics(spark, sf_dir):
    """The state after day two: its listing, and the chunks of its live files."""
    rows = day_two_chunks(spark, sf_dir).agg(F.count("*")).scalar()
    metrics = reports.run_metrics(day_two(spark, sf_dir), rows, chunking.SIZE, chunking.OVERLAP)
    return metrics.select([F.col(c).cast("bigint").alias(c) for c in metrics.columns])


# Paths, metadata and text


@query
def path_metadata(spark, sf_dir):
    return files(spark, sf_dir).select(
        "path", "rel_path", F.array_join("levels", "|").alias("levels"), "category", "year", "month"
    )


@query
def page_paths(spark, sf_dir):
    """Addresses as paths: shallow ones and ones without a year give nulls."""
    pages = table(spark, sf_dir, "pages").select("page_id", paths.normalise_uri(F.col("url"), decode=True).alias("path"))
    return paths.path_metadata(pages, "/").select("page_id", "path", "rel_path", "category", "year", "month")


@query
def month_names(spark, sf_dir):
    """Long and short month names of all events, and names that are no month."""
    names = F.array(F.date_format("ts", "MMMM"), F.upper(F.date_format("ts", "MMM")), F.col("event_type"))
    rows = table(spark, sf_dir, "events").select(F.explode(names).alias("month_name"))
    counted = rows.groupBy("month_name").agg(F.count("*").alias("n"))
    return counted.withColumn("month", paths.month_number(F.col("month_name")))


@query
def metadata_violations(spark, sf_dir):
    checked = quality.validate_metadata(
        files(spark, sf_dir), categories=["Housing"], years=(2023, 2024), months=(1, 11)
    )
    return checked.select("path", F.array_join("violations", ",").alias("violations"))


@query
def page_text(spark, sf_dir):
    return balance(table(spark, sf_dir, "pages")).select("page_id", text.html_text(F.col("html")).alias("text"))


@query
def joined_pages(spark, sf_dir):
    """The words of a text as pages, the one-letter ones without text."""
    docs = balance(table(spark, sf_dir, "documents").select("doc_id", "text"))
    pages = F.transform(F.split("text", " "), lambda page: F.when(F.length(page) > 1, page))
    return docs.select("doc_id", text.join_pages(pages).alias("text"))


def text_folder(spark, sf_dir) -> str:
    """Every document written as a text file of its own, in a folder per language and document."""
    folder = new_run_folder(spark, "files")
    docs = table(spark, sf_dir, "documents").select("lang", "doc_id", "text")
    write_text_files(docs, folder, ["lang", "doc_id"])
    return folder


def parent_folder(path: Column) -> Column:
    return F.element_at(paths.path_levels(path), -3)


@query
def folder_listing(spark, sf_dir):
    """Files in folders, listed without opening them, sized per folder."""
    listed = list_files(spark, text_folder(spark, sf_dir), "*.[tT][xX][tT]", START)
    return listed.groupBy(parent_folder(F.col("path")).alias("folder")).agg(F.sum("length").alias("bytes"))


@query
def folder_text(spark, sf_dir):
    """The same files read and decoded: characters and line breaks per folder."""
    contents = read_contents(spark, text_folder(spark, sf_dir), "*.[tT][xX][tT]")
    rows = contents.select(parent_folder(F.col("path")).alias("folder"), text.decode_text(F.col("content")).alias("text"))
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n")))
    return rows.groupBy("folder").agg(
        F.sum(F.length("text").cast("bigint")).alias("chars"), F.sum(breaks.cast("bigint")).alias("line_breaks")
    )


# Chunks


@query
def chunk_fixed(spark, sf_dir):
    chunks = chunking.make_chunks(files(spark, sf_dir), fixed=True)
    return chunk_rows(chunks, "version", "ordinal")


@query
def chunk_recursive(spark, sf_dir):
    return chunking.chunk_recursive(files(spark, sf_dir).select("path", "text")).select(
        "path", "ordinal", "start", "end", "chunk_text"
    )


@query
def chunk_recursive_invariants(spark, sf_dir):
    """Breaks of the rules a chunk obeys, over all documents; every count must be 0."""
    docs = balance(table(spark, sf_dir, "documents").select("doc_id", "text"))
    cut = docs.withColumn("c", chunking.recursive_chunks(F.col("text")))
    # Offsets must reproduce the text, and what no chunk covers must be white space.
    starts, ends = F.col("c.start"), F.col("c.end")
    following = F.slice(starts, 2, 1 << 30)
    covered = F.transform(F.col("c"), lambda c: F.regexp_replace(c["text"], r"\s", ""))
    checked = cut.select(
        F.size(F.filter("c", lambda c: F.length(c["text"]) > chunking.SIZE)).alias("too_long"),
        F.size(F.filter("c", lambda c: F.length(c["text"]) != c["end"] - c["start"])).alias("wrong_span"),
        F.size(F.filter("c", lambda c: F.trim(c["text"]) == "")).alias("blank"),
        F.size(F.filter(F.zip_with(starts, following, lambda a, b: b <= a), lambda x: x)).alias("unordered"),
        F.size(F.filter(F.zip_with(ends, following, lambda a, b: a - b > chunking.OVERLAP), lambda x: x)).alias("overlapping"),
        F.when(F.length(F.array_join(covered, "")) < F.length(F.regexp_replace("text", r"\s", "")), 1).otherwise(0).alias("uncovered"),
    )
    return checked.agg(*[F.sum(F.col(c).cast("bigint")).alias(c) for c in checked.columns])


@query
def chunks_by_category(spark, sf_dir):
    return reports.chunk_counts(chunking.make_chunks(files(spark, sf_dir), fixed=True))


@query
def distinct_paths(spark, sf_dir):
    return reports.distinct_paths(chunking.make_chunks(files(spark, sf_dir), fixed=True))


@query
def chunk_upsert(spark, sf_dir):
    new = new_chunks(spark, sf_dir, version_in_id=False)
    return chunk_rows(chunk_store.chunk_upsert(old_chunks(spark, sf_dir), new))


@query
def chunk_replace(spark, sf_dir):
    touched = revised(spark, sf_dir).select("path")
    return chunk_rows(
        chunk_store.chunk_replace(old_chunks(spark, sf_dir), new_chunks(spark, sf_dir), touched), "version"
    )


def gone_paths(spark, sf_dir):
    return of_source(files(spark, sf_dir).select("path", "source"), GONE_SOURCE)


@query
def chunk_delete(spark, sf_dir):
    return chunk_rows(chunk_store.chunk_delete(old_chunks(spark, sf_dir), gone_paths(spark, sf_dir)))


def next_chunks(spark, sf_dir, old):
    """Day one's chunks after an upsert on equal ids and the removal of a source."""
    upserted = chunk_store.chunk_upsert(old, new_chunks(spark, sf_dir, version_in_id=False))
    return chunk_store.chunk_delete(upserted, gone_paths(spark, sf_dir))


def touched_paths(spark, sf_dir):
    rows = files(spark, sf_dir).select("path", "source")
    return of_source(rows, GONE_SOURCE, REVISED_SOURCE, NEW_SOURCE)


@query
def chunk_changes(spark, sf_dir):
    old = write_snapshot(old_chunks(spark, sf_dir), new_run_folder(spark, "chunks"))
    feed = chunk_store.change_feed(old, next_chunks(spark, sf_dir, old), scope=touched_paths(spark, sf_dir))
    return chunk_rows(feed, F.col("_change_type").alias("change_type"))


@query
def chunk_changes_by_digest(spark, sf_dir):
    """The same feed from two whole snapshots and no list of touched paths."""
    old = digests.write_digested(old_chunks(spark, sf_dir), new_run_folder(spark, "snapshot"), buckets=64)
    new = digests.write_digested(next_chunks(spark, sf_dir, old.rows()), new_run_folder(spark, "snapshot"), buckets=64)
    return chunk_rows(digests.change_feed_by_digests(old, new), F.col("_change_type").alias("change_type"))


@query
def chunk_changes_applied(spark, sf_dir):
    """The feed applied to the old table is the new table."""
    old = write_snapshot(old_chunks(spark, sf_dir), new_run_folder(spark, "chunks"))
    feed = chunk_store.change_feed(old, next_chunks(spark, sf_dir, old), scope=touched_paths(spark, sf_dir))
    return chunk_rows(chunk_store.apply_changes(old, feed))


# Filters

ALLOWED_VALUES = {"category": ["Housing"], "year": (2023, 2024), "month": (1, 11)}

FILTERS: dict[str, tuple[str, list[str], list[dict]]] = {
    "filter_equal": ("events", ["event_id"], [{"key": "event_type", "value": "error"}]),
    "filter_in": ("events", ["event_id"], [{"key": "event_type", "value": ["click", "error"]}]),
    "filter_not": ("events", ["event_id"], [{"key": "event_type NOT", "value": "click"}]),
    "filter_not_in": ("events", ["event_id"], [{"key": "event_type NOT", "value": ["click", "error"]}]),
    "filter_less": ("events", ["event_id"], [{"key": "value <", "value": 10.5}]),
    "filter_less_equal": ("events", ["event_id"], [{"key": "user_id <=", "value": 20}]),
    "filter_greater": ("events", ["event_id"], [{"key": "value >", "value": 10.5}]),
    "filter_greater_equal": ("events", ["event_id"], [{"key": "user_id >=", "value": 20}]),
    "filter_or": ("events", ["event_id"], [{"key": "event_type OR props", "value": ["click", '{"k": 69}']}]),
    "filter_like": ("documents", ["doc_id"], [{"key": "text LIKE", "value": "The and"}]),
    "filter_and": (
        "events",
        ["event_id"],
        [
            {"key": "event_type", "value": ["click", "error"]},
            {"key": "user_id >=", "value": 5},
            {"key": "value <", "value": 50},
            {"key": "props LIKE", "value": "k"},
        ],
    ),
}


def _filter_query(source: str, columns: list[str], items: list[dict]) -> Query:
    return lambda spark, sf_dir: filters.apply_filters(table(spark, sf_dir, source), items).select(*columns)


QUERIES.update({name: _filter_query(*parts) for name, parts in FILTERS.items()})


@query
def filter_like_skipped(spark, sf_dir):
    """The same filter over documents clustered by language and source; files without one of the words are not opened."""
    docs = table(spark, sf_dir, "documents")
    clustered = skipping.write_clustered(docs, new_run_folder(spark, "clustered"), ["lang", "source"], "text", files=16)
    return clustered.read([{"key": "text LIKE", "value": "The and"}]).select("doc_id")


def refusal(items: list[dict], schema: T.StructType) -> str | None:
    """The column whose filter is refused, None when all are accepted."""
    for item in items:
        try:
            filters.validate_filters([item], schema, list(ALLOWED_VALUES), ALLOWED_VALUES)
        except ValueError:
            return filters.parse_key(item["key"])[0][0]
    return None


@query
def filters_refused(spark, sf_dir):
    """Filters for every folder of the listing, of which some ask for values outside what is allowed."""
    folders = listing(spark, sf_dir, 2).select("category", "year", "month").distinct()
    rows = []
    for r in folders.collect():  # folders, not files: as many as categories, years and months allow
        items = [{"key": "category", "value": r.category}, {"key": "year >=", "value": r.year}, {"key": "month", "value": [r.month]}]
        rows.append((r.category, r.year, r.month, refusal(items, folders.schema)))
    return spark.createDataFrame(rows, "category string, year int, month int, refused string")


@query
def filter_glob(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.where(paths.glob_match(F.col("url"), "*.[hH][tT][mM][lL]")).select("page_id", "url")


# Index


@query
def embed_chunks(spark, sf_dir):
    rows = build_index(chunking.make_chunks(files(spark, sf_dir), fixed=True))
    parts = rows.select("chunk_id", "doc_len", F.posexplode_outer("embedding").alias("bucket", "weight"))
    return parts.where(F.col("weight") > 0).select(
        "chunk_id", F.col("doc_len").cast("bigint").alias("doc_len"), F.col("bucket").cast("bigint").alias("bucket"),
        F.round("weight", 6).alias("weight"),
    )


def posting_rows(index: DataFrame, *columns: str) -> DataFrame:
    return postings(index, "chunk_id", "doc_len", *columns).withColumn("doc_len", F.col("doc_len").cast("bigint"))


@query
def index_postings(spark, sf_dir):
    rows = build_index(chunking.make_chunks(files(spark, sf_dir), fixed=True))
    return posting_rows(rows, "category", "year")


def synced_index(spark, sf_dir) -> DataFrame:
    """Day one's index after the feed of the chunk changes, which is written first, as it is read twice."""
    old = write_snapshot(old_chunks(spark, sf_dir), new_run_folder(spark, "chunks"))
    feed = chunk_store.change_feed(old, next_chunks(spark, sf_dir, old), scope=touched_paths(spark, sf_dir))
    return sync_index(build_index(old), write_snapshot(feed, new_run_folder(spark, "feed")))


@query
def index_sync_postings(spark, sf_dir):
    return posting_rows(synced_index(spark, sf_dir))


@query
def index_sync_vectors(spark, sf_dir):
    """One number per chunk that any change of its vector changes."""
    rows = synced_index(spark, sf_dir)
    weighted = F.transform("embedding", lambda x, i: x * (i + 1))
    total = F.aggregate(weighted, F.lit(0.0), lambda a, x: a + x)
    return rows.select("chunk_id", F.col("doc_len").cast("bigint").alias("doc_len"), F.round(total, 6).alias("moment"))


def posting_statistics(rows: DataFrame) -> DataFrame:
    return rows.select("term", "df", "length")


@query
def postings_stored(spark, sf_dir):
    """Postings decoded from the blocks of the inverted file, with the keys of their chunks."""
    file = written_inverted(spark, sf_dir)
    rows = file.postings(["chunk_id", "category", "year"])
    lengths = {c: F.col(c).cast("bigint") for c in ("tf", "doc_len")}
    return rows.select("term", "chunk_id", "tf", "doc_len", "category", "year").withColumns(lengths)


@query
def index_statistics(spark, sf_dir):
    return posting_statistics(statistics.index_statistics(build_index(chunking.make_chunks(files(spark, sf_dir), fixed=True))))


@query
def index_statistics_synced(spark, sf_dir):
    """Day one's statistics after the signed rows of the change feed; the index is not read again."""
    old = write_snapshot(old_chunks(spark, sf_dir), new_run_folder(spark, "chunks"))
    feed = chunk_store.change_feed(old, next_chunks(spark, sf_dir, old), scope=touched_paths(spark, sf_dir))
    before = statistics.index_statistics(build_index(old))
    return posting_statistics(statistics.sync_statistics(before, statistics.feed_delta(feed)))


# Search


@query
def knn_topk(spark, sf_dir):
    """Every vector against every vector by ready-made embeddings."""
    return ranked(search.similarity_search(vector_queries(spark, sf_dir), vectors(spark, sf_dir)))


@query
def knn_topk_blocks(spark, sf_dir):
    """The same search in several scans, as when there are too many queries for one."""
    return ranked(search.similarity_search(vector_queries(spark, sf_dir), vectors(spark, sf_dir), max_broadcast=200))


@query
def knn_int_ids(spark, sf_dir):
    """Ten nearest, with ids of a narrower type than the index has."""
    asked = vector_queries(spark, sf_dir).withColumn("query_id", F.col("query_id").cast("int"))
    return ranked(search.similarity_search(asked, vectors(spark, sf_dir), k=10))


@query
def knn_filtered(spark, sf_dir):
    items = [{"key": "label", "value": [1, 2, 3]}, {"key": "label NOT", "value": 2}]
    return ranked(search.similarity_search(vector_queries(spark, sf_dir), vectors(spark, sf_dir), filters=items))


@query
def similarity_topk(spark, sf_dir):
    queries = embed(benchmark_queries(spark, sf_dir))
    return ranked(search.similarity_search(queries, written_index(spark, sf_dir)))


@query
def bm25_topk(spark, sf_dir):
    kept = written_statistics(spark, sf_dir)
    return ranked(search.keyword_search(benchmark_queries(spark, sf_dir), written_index(spark, sf_dir), statistics=kept))


@query
def bm25_pruned(spark, sf_dir):
    """The same hits from the stored inverted file, whose blocks are skipped where they cannot matter."""
    kept, file = written_statistics(spark, sf_dir), written_inverted(spark, sf_dir)
    return ranked(inverted.pruned_keyword_search(benchmark_queries(spark, sf_dir), file, kept)[0])


@query
def bm25_pruned_filtered(spark, sf_dir):
    """One category, a year and months, in several scans."""
    items = [{"key": "category", "value": "Construction"}, {"key": "year >=", "value": 2024}, {"key": "month <", "value": 9}]
    kept, file = written_statistics(spark, sf_dir), written_inverted(spark, sf_dir)
    asked = benchmark_queries(spark, sf_dir)
    return ranked(inverted.pruned_keyword_search(asked, file, kept, filters=items, max_broadcast=5000)[0])


@query
def bm25_topk_blocks(spark, sf_dir):
    """The same search in several scans, as when there are too many query terms for one."""
    return ranked(
        search.keyword_search(benchmark_queries(spark, sf_dir), written_index(spark, sf_dir), max_broadcast=500)
    )


@query
def hybrid_topk(spark, sf_dir):
    kept = written_statistics(spark, sf_dir)
    return ranked(search.hybrid_search(benchmark_queries(spark, sf_dir), written_index(spark, sf_dir), statistics=kept))


@query
def hybrid_no_hits(spark, sf_dir):
    """Every other query has lost its words: it gets NO_RESULTS, not the first chunks."""
    words = F.when(F.col("query_id") % 2 == 0, F.regexp_replace("text", r"[\p{L}\p{N}]", ".")).otherwise(F.col("text"))
    queries = benchmark_queries(spark, sf_dir).withColumn("text", words)
    hits = search.hybrid_search(queries, written_index(spark, sf_dir))
    answers = search.result_envelope(queries, hits, ["chunk_id"])
    return answers.select("query_id", "status", F.col("num_results").cast("bigint").alias("num_results"))


SEARCH_FILTERS = [
    {"key": "category", "value": "Construction"},
    {"key": "year >=", "value": 2024},
    {"key": "month <", "value": 9},
]


@query
def hybrid_filtered(spark, sf_dir):
    """Hits of a filtered search with their result columns."""
    queries = benchmark_queries(spark, sf_dir)
    hits = search.hybrid_search(queries, written_index(spark, sf_dir), filters=SEARCH_FILTERS)
    columns = ["chunk_text", "path", "year", "month"]
    return ranked(search.with_columns(hits, written_chunks(spark, sf_dir), columns, queries=queries), *columns)


@query
def hybrid_one_month(spark, sf_dir):
    """The search by three exact keys: one category, year and month."""
    items = [{"key": "category", "value": "Construction"}, {"key": "year", "value": 2025}, {"key": "month", "value": 5}]
    filters.validate_filters(items, written_index(spark, sf_dir).schema, domains=filters.CORPUS_DOMAINS)
    return ranked(search.hybrid_search(benchmark_queries(spark, sf_dir), written_index(spark, sf_dir), filters=items))


@query
def hybrid_one_month_skipped(spark, sf_dir):
    """The same search over an index clustered by the three keys, of which only the files of that month are opened."""
    items = [{"key": "category", "value": "Construction"}, {"key": "year", "value": 2025}, {"key": "month", "value": 5}]
    keys = ["category", "year", "month"]
    clustered = skipping.write_clustered(written_index(spark, sf_dir), new_run_folder(spark, "clustered"), keys, files=16)
    kept = written_statistics(spark, sf_dir)
    return ranked(search.hybrid_search(benchmark_queries(spark, sf_dir), clustered.read(items), statistics=kept))


@query
def hybrid_before_september(spark, sf_dir):
    items = [{"key": "month <", "value": 9}]
    return ranked(search.hybrid_search(benchmark_queries(spark, sf_dir), written_index(spark, sf_dir), filters=items))


def user_queries(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").where(F.col("role") == "user")
    return turns.select(F.concat_ws("-", "conv_id", "turn").alias("query_id"), "text")


@query
def search_envelope(spark, sf_dir):
    """One answer per user turn from its keyword hits of one month, with NO_RESULTS where nothing matches."""
    queries = user_queries(spark, sf_dir)
    items = [{"key": "category", "value": "Housing"}, {"key": "month", "value": 5}]
    hits = search.keyword_search(queries, written_index(spark, sf_dir), filters=items)
    answers = search.result_envelope(queries, hits, ["chunk_id"])
    return answers.select(
        "query_id", "status", F.col("num_results").cast("bigint").alias("num_results"),
        F.array_join(F.transform("docs", lambda d: d["chunk_id"]), ",").alias("docs"),
    )


@query
def search_envelope_json(spark, sf_dir):
    """The keyword answers of one month to every benchmark text, each as one string."""
    queries = benchmark_queries(spark, sf_dir)
    hits = search.keyword_search(queries, written_index(spark, sf_dir), k=10, filters=[{"key": "month", "value": 5}])
    return search.result_envelope(queries, hits, ["chunk_id"], as_json=True)


@query
def approx_topk(spark, sf_dir):
    return ranked(approx.approx_search(vector_queries(spark, sf_dir), written_codes(spark, sf_dir), DIM))


@query
def approx_recall(spark, sf_dir):
    queries, rows = vector_queries(spark, sf_dir), vectors(spark, sf_dir)
    exact = search.similarity_search(queries, rows, k=10)
    found = approx.approx_search(queries, written_codes(spark, sf_dir), DIM, k=10)
    hashed = written_codes(spark, sf_dir)
    pairs = approx.candidate_scores(approx.hash_vectors(queries, DIM), hashed)
    n = rows.agg(F.count("*")).scalar()
    return approx.recall_report(exact, found, pairs, n * n)


# Whole runs


@query
def corpus_runs(spark, sf_dir):
    """Two runs over written tables: chunks and files per category and status after the second."""
    corpus = Corpus(spark, new_run_folder(spark, "corpus"))
    texts = files(spark, sf_dir).select("path", "text")
    corpus.sync(listing(spark, sf_dir, 1), texts, INDEXED_AT)
    corpus.sync(listing(spark, sf_dir, 2), texts, INDEXED_AT)
    per_path = corpus.chunks().groupBy("path").agg(F.count("*").alias("chunks"))
    tracked = corpus.tracking().join(per_path, "path", "left")
    return tracked.groupBy("category", "status", "version").agg(
        F.count("*").alias("files"), F.sum(F.coalesce("chunks", F.lit(0))).alias("chunks")
    )


@query
def corpus_full_refresh(spark, sf_dir):
    """A first run, then a full refresh in which half of the files have older times than they had: all are split again."""
    corpus = Corpus(spark, new_run_folder(spark, "corpus"))
    given = files(spark, sf_dir)
    first = listing(spark, sf_dir, 2).unionByName(listing(spark, sf_dir, 1), allowMissingColumns=True)
    first = first.dropDuplicates(["path"]).withColumn("modification_ts", F.lit(START))
    older = F.when(F.pmod(F.length("path"), F.lit(2)) == 0, F.lit(START) - F.expr("interval 1 day")).otherwise(F.lit(START))
    again = first.withColumn("modification_ts", older)
    times = again.select("path", "modification_ts")
    corpus.sync(first, given.select("path", "text"), INDEXED_AT)
    corpus.sync(again, given.select("path", "text").join(times, "path"), INDEXED_AT, full_refresh=True)
    per_path = corpus.chunks().groupBy("path").agg(F.count("*").alias("chunks"))
    tracked = corpus.tracking().join(per_path, "path", "left")
    return tracked.groupBy("category", "status", "version").agg(
        F.count("*").alias("files"), F.sum(F.coalesce("chunks", F.lit(0))).alias("chunks")
    )


@query
def corpus_answers(spark, sf_dir):
    """Filtered answers from a corpus kept in step by two runs."""
    corpus = Corpus(spark, new_run_folder(spark, "corpus"))
    texts = files(spark, sf_dir).select("path", "text")
    corpus.sync(listing(spark, sf_dir, 1), texts, INDEXED_AT)
    corpus.sync(listing(spark, sf_dir, 2), texts, INDEXED_AT)
    answers = corpus.answer(benchmark_queries(spark, sf_dir), SEARCH_FILTERS, k=10)
    found = F.array_join(F.transform("docs", lambda d: d["path"]), ",")
    return answers.select("query_id", "status", "num_results", found.alias("paths"))


@query
def corpus_answer_texts(spark, sf_dir):
    """The documents of the answers as they are sent: as many as a search gives, with their texts, in order."""
    corpus = Corpus(spark, new_run_folder(spark, "corpus"))
    texts = files(spark, sf_dir).select("path", "text")
    corpus.sync(listing(spark, sf_dir, 1), texts, INDEXED_AT)
    corpus.sync(listing(spark, sf_dir, 2), texts, INDEXED_AT)
    answers = corpus.answer(benchmark_queries(spark, sf_dir), SEARCH_FILTERS)
    docs = answers.select("query_id", F.posexplode("docs").alias("at", "doc"))
    return docs.select("query_id", (F.col("at") + 1).cast("bigint").alias("rank"), "doc.chunk_id", "doc.path", "doc.chunk_text")


@query
def track_streamed(spark, sf_dir):
    """Two arrivals of listing files, each taken in by a triggered stream run from the same checkpoint."""
    folder = new_run_folder(spark, "stream")
    columns = ["path", "length", "modification_ts"]
    schema = T.StructType([TRACKING[c] for c in columns])
    for day in (1, 2):
        listing(spark, sf_dir, day).select(*columns).write.mode("append").parquet(f"{folder}/listings")
        arrivals = spark.readStream.schema(schema).parquet(f"{folder}/listings")
        track_stream(arrivals, folder, ROOT, START)
    return track_rows(latest_batch(spark, folder)).drop("indexed")


def written_file(path: Column) -> Column:
    """The path a document would have, from that of the file Spark wrote for it: folders without column names."""
    return F.regexp_replace(F.regexp_replace(path, "/[a-z_]+=", "/"), "/([0-9]+)/part-[^/]*$", "/$1.txt")


@query
def files_streamed(spark, sf_dir):
    """Real files, one for each document, arriving in two lots and indexed by a stream of their bytes."""
    root, corpus = new_run_folder(spark, "arrivals"), Corpus(spark, new_run_folder(spark, "corpus"))
    levels = F.split(F.col("path"), "/")
    docs = files(spark, sf_dir).select(
        "text", *[F.get(levels, F.lit(at)).alias(name) for at, name in ((2, "category"), (3, "year"), (4, "month"))],
        F.regexp_replace(F.get(levels, F.lit(5)), "[.]txt$", "").cast("bigint").alias("doc_id"),
    )
    for lot in (0, 1):
        half = docs.where(F.col("doc_id") % 2 == lot)
        write_text_files(half, f"{root}/documents", ["category", "year", "month", "doc_id"])
        arriving = stream_new_files(spark, f"{root}/documents", "*.[tT][xX][tT]", content=True)
        named = arriving.withColumn("path", F.concat(F.lit(ROOT), F.substring_index(written_file(F.col("path")), "/documents/", -1)))
        index_stream(named, corpus, ROOT, INDEXED_AT)
    per_path = corpus.chunks().groupBy("path").agg(F.count("*").alias("chunks"))
    return corpus.tracking().join(per_path, "path", "left").select(
        "path", "category", "year", "month", "status", "version", F.coalesce("chunks", F.lit(0)).alias("chunks")
    )


@query
def feed_streamed(spark, sf_dir):
    """Day one's index kept in step by a stream of the change feed, which comes in two runs."""
    folder = new_run_folder(spark, "feed")
    old = write_snapshot(old_chunks(spark, sf_dir), new_run_folder(spark, "chunks"))
    index = write_snapshot(build_index(old), new_run_folder(spark, "index"))
    feed = chunk_store.change_feed(old, next_chunks(spark, sf_dir, old), scope=touched_paths(spark, sf_dir))
    feed = write_snapshot(feed, new_run_folder(spark, "feed"))
    for run in (0, 1):
        append_feed(feed.where(F.pmod(F.xxhash64("path"), F.lit(2)) == run), folder, run)
        synced = index_feed(stream_feed(spark, folder, feed.schema), f"{folder}/stream", index)
    return posting_rows(synced)
