from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from paperbrook.functions.paths import path_metadata
from paperbrook.operators.chunking import make_chunks
from paperbrook.operators.filters import CORPUS_DOMAINS
from paperbrook.operators.index import build_index
from paperbrook.operators.statistics import index_statistics
from paperbrook.plans.corpus import Corpus
from paperbrook.sources.files import list_files, read_contents
from paperbrook.functions.text import decode_text
from paperbrook.streaming.files import (
    fold_stream,
    index_stream,
    last_batch,
    latest_batch,
    stream_new_files,
    track_stream,
)

T0 = datetime(2024, 1, 1)


def listing(spark, files):
    rows = [(f"/r/Housing/2024/May/{p}", 1, T0 + timedelta(minutes=m), T0) for p, m, _ in files]
    df = spark.createDataFrame(rows, "path string, length long, modification_ts timestamp, ingest_ts timestamp")
    return path_metadata(df, "/r/")


def texts(spark, files):
    return spark.createDataFrame([(f"/r/Housing/2024/May/{p}", t) for p, _, t in files], "path string, text string")


ONE = [("a", 0, "alpha beta " * 200), ("b", 0, "gamma delta"), ("c", 0, "gone soon " * 150)]
TWO = [("a", 1, "alpha omega " * 150), ("b", 0, "gamma delta"), ("d", 0, "new file")]


@pytest.fixture
def corpus(spark, tmp_path):
    return Corpus(spark, str(tmp_path / "corpus"))


def test_two_runs_equal_a_rebuild(spark, corpus, rows):
    corpus.sync(listing(spark, ONE), texts(spark, ONE), T0)
    metrics = corpus.sync(listing(spark, TWO), texts(spark, TWO), T0).first()
    assert (metrics.rows_to_index, metrics.rows_to_delete) == (2, 1)
    tracked = {r.path[-1]: (r.status, r.version) for r in corpus.tracking().collect()}
    assert tracked == {"a": ("INDEXED", 2), "b": ("INDEXED", 1), "c": ("DELETED", 1), "d": ("INDEXED", 1)}

    live = corpus.tracking().where("is_current").join(texts(spark, TWO), "path")
    expected = make_chunks(live)
    assert rows(corpus.chunks().drop("run")) == rows(expected)
    assert rows(corpus.index().drop("run")) == rows(build_index(expected))
    assert metrics.vector_rows == expected.count()


def test_a_run_writes_only_what_changed(spark, corpus):
    corpus.sync(listing(spark, ONE), texts(spark, ONE), T0)
    corpus.sync(listing(spark, TWO), texts(spark, TWO), T0)
    written = spark.read.parquet(f"{corpus.folder}/chunks/run=2")
    assert {p.path[-1] for p in written.select("path").distinct().collect()} == {"a", "d"}


def test_third_run_without_change_is_empty(spark, corpus, rows):
    for _ in range(2):
        corpus.sync(listing(spark, ONE), texts(spark, ONE), T0)
    before = rows(corpus.chunks())
    metrics = corpus.sync(listing(spark, ONE), texts(spark, ONE), T0).first()
    assert metrics.rows_to_index == 0 and rows(corpus.chunks()) == before


def test_compact_and_full_refresh_keep_the_rows(spark, corpus, rows):
    corpus.sync(listing(spark, ONE), texts(spark, ONE), T0)
    corpus.sync(listing(spark, TWO), texts(spark, TWO), T0)
    chunks, index = rows(corpus.chunks().drop("run")), rows(corpus.index().drop("run"))
    corpus.compact()
    assert corpus.last_run() == (3, 3)
    assert rows(corpus.chunks().drop("run")) == chunks and rows(corpus.index().drop("run")) == index
    metrics = corpus.sync(listing(spark, TWO), texts(spark, TWO), T0, full_refresh=True).first()
    assert metrics.rows_to_index == 3 and metrics.base_run == 4
    assert rows(corpus.chunks().drop("run")) == chunks


def test_statistics_follow_the_runs(spark, corpus, rows):
    for files, full in ((ONE, False), (TWO, False), (TWO, False), (ONE, True), (TWO, False)):
        corpus.sync(listing(spark, files), texts(spark, files), full_refresh=full)
        assert rows(corpus.statistics()) == rows(index_statistics(corpus.index()))
    corpus.compact()
    assert rows(corpus.statistics()) == rows(index_statistics(corpus.index()))
    corpus.sync(listing(spark, ONE[:1]), texts(spark, ONE[:1]))
    assert rows(corpus.statistics()) == rows(index_statistics(corpus.index()))


def test_a_path_given_twice_in_texts_is_refused(spark, corpus):
    given = texts(spark, ONE)
    with pytest.raises(ValueError, match="more than once in texts: '/r/Housing/2024/May/b'"):
        corpus.sync(listing(spark, ONE), given.unionByName(given.where("path like '%/b'")))
    assert corpus.last_run() == (0, 1)
    assert corpus.sync(listing(spark, ONE), given).first()["rows_unread"] == 0


def test_a_failed_run_does_not_count(spark, corpus, rows):
    corpus.sync(listing(spark, ONE), texts(spark, ONE), T0)
    before = rows(corpus.chunks()), rows(corpus.tracking())
    broken = texts(spark, TWO).withColumn("text", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        corpus.sync(listing(spark, TWO), broken, T0)
    assert (rows(corpus.chunks()), rows(corpus.tracking())) == before
    corpus.sync(listing(spark, TWO), texts(spark, TWO), T0)
    assert corpus.last_run() == (2, 1)


def test_empty_listing_needs_permission(spark, corpus):
    corpus.sync(listing(spark, ONE), texts(spark, ONE), T0)
    nothing = listing(spark, ONE).limit(0)
    with pytest.raises(ValueError, match="empty"):
        corpus.sync(nothing, texts(spark, ONE), T0)
    corpus.sync(nothing, texts(spark, ONE), T0, allow_empty_listing=True)
    assert corpus.chunks().count() == 0
    answers = corpus.answer(spark.createDataFrame([(1, "alpha")], "query_id long, text string")).first()
    assert (answers.status, answers.num_results, answers.docs) == ("NO_RESULTS", 0, [])


def test_answers(spark, corpus):
    corpus.sync(listing(spark, ONE), texts(spark, ONE), T0)
    queries = spark.createDataFrame([(1, "gamma")], "query_id long, text string")
    answer = corpus.answer(queries, [{"key": "category", "value": "Housing"}, {"key": "year", "value": 2024}], k=3).first()
    assert answer.status == "OK" and answer.docs[0].chunk_text == "gamma delta"
    with pytest.raises(ValueError):
        corpus.answer(queries, [{"key": "colour", "value": "red"}])
    with pytest.raises(ValueError):
        corpus.answer(queries, [{"key": "month", "value": 13}], domains=CORPUS_DOMAINS)
    with pytest.raises(ValueError):
        corpus.answer(queries, [{"key": "path", "value": "x"}], domains=CORPUS_DOMAINS)


def test_from_real_files(spark, corpus, tmp_path):
    root = tmp_path / "docs"
    target = root / "Housing" / "2024" / "Sept"
    target.mkdir(parents=True)
    (target / "a b.txt").write_text("hello file")
    files = path_metadata(list_files(spark, str(root), "*.txt"), f"file:{root}/")
    contents = read_contents(spark, str(root), "*.txt").select("path", "modification_ts", decode_text(F.col("content")).alias("text"))
    corpus.sync(files, contents, T0)
    row = corpus.chunks().first()
    assert (row.chunk_text, row.category, row.year, row.month) == ("hello file", "Housing", 2024, 9)


def test_files_older_than_all_pending_ones_are_not_opened(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x")
    plan = read_contents(spark, str(tmp_path), "*.txt").where(F.col("modification_ts") >= F.lit(T0))
    assert "PushedFilters: [IsNotNull(modificationTime), GreaterThanOrEqual(modificationTime" in (
        plan._jdf.queryExecution().executedPlan().toString()
    )


def test_file_stream(spark, tmp_path):
    root, folder = tmp_path / "in", str(tmp_path / "state")
    target = root / "Housing" / "2024" / "May"
    target.mkdir(parents=True)
    for name in ["a.pdf", "b.PDF", "c.txt"]:
        (target / name).write_bytes(b"x")
    run = lambda: track_stream(stream_new_files(spark, str(root)), folder, f"file:{root}/", T0)
    assert {r.path[-5:]: (r.status, r.category, r.month) for r in run().collect()} == {
        "a.pdf": ("NEW", "Housing", 5), "b.PDF": ("NEW", "Housing", 5)
    }
    (target / "d.pdf").write_bytes(b"y")
    assert {r.path[-5:] for r in run().collect()} == {"a.pdf", "b.PDF", "d.pdf"}
    assert run().count() == 3


def test_indexing_a_file_stream(spark, corpus, tmp_path):
    target = tmp_path / "in" / "Housing" / "2024" / "May"
    target.mkdir(parents=True)
    run = lambda: index_stream(
        stream_new_files(spark, str(tmp_path / "in"), "*.txt", content=True), corpus, f"file:{tmp_path}/in/", T0
    )
    (target / "a.txt").write_text("first file")
    run()
    (target / "b.txt").write_text("second file")
    run()
    assert {(r.path[-5:], r.chunk_text, r.year) for r in corpus.chunks().collect()} == {
        ("a.txt", "first file", 2024), ("b.txt", "second file", 2024)
    }
    assert {r.status for r in corpus.tracking().collect()} == {"INDEXED"}


def test_folders_by_category_are_pruned(spark, tmp_path, rows):
    split = Corpus(spark, str(tmp_path / "split"), partition_by=("category", "year"))
    plain = Corpus(spark, str(tmp_path / "plain"))
    for corpus in (split, plain):
        corpus.sync(listing(spark, ONE), texts(spark, ONE), T0)
        corpus.sync(listing(spark, TWO), texts(spark, TWO), T0)
    columns = plain.chunks().columns
    assert rows(split.chunks().select(columns)) == rows(plain.chunks())
    plan = split.index().where("category = 'Housing' and year >= 2024")._jdf.queryExecution().executedPlan().toString()
    assert "(year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    queries = spark.createDataFrame([(1, "alpha omega")], "query_id long, text string")
    assert rows(split.answer(queries)) == rows(plain.answer(queries))


def state(corpus):
    return {r.path[-1]: (r.status, r.version) for r in corpus.tracking().collect()}


def test_a_file_without_text_is_tried_again(spark, corpus):
    metrics = corpus.sync(listing(spark, ONE), texts(spark, ONE[:1]), T0).first()
    assert (metrics.rows_to_index, metrics.rows_unread) == (3, 2)
    assert state(corpus) == {"a": ("INDEXED", 1), "b": ("NEW", 1), "c": ("NEW", 1)}
    nothing = texts(spark, ONE).withColumn("text", F.when(~F.col("path").endswith("/c"), F.col("text")))
    assert corpus.sync(listing(spark, ONE), nothing, T0).first().rows_unread == 1
    assert state(corpus) == {"a": ("INDEXED", 1), "b": ("INDEXED", 1), "c": ("NEW", 1)}
    assert {r.path[-1] for r in corpus.chunks().collect()} == {"a", "b"}


def test_an_empty_text_has_arrived(spark, corpus):
    corpus.sync(listing(spark, [("e", 0, "")]), texts(spark, [("e", 0, "")]), T0)
    assert state(corpus) == {"e": ("INDEXED", 1)} and corpus.chunks().count() == 0


def test_full_refresh_with_a_time_that_went_back(spark, corpus, rows):
    late = [("a", 10, "one"), ("b", 20, "two")]
    back = [("a", 5, "one again"), ("b", 20, "two again")]
    times = lambda given: listing(spark, given).select("path", "modification_ts").join(texts(spark, given), "path")
    corpus.sync(listing(spark, late), times(late), T0)
    corpus.sync(listing(spark, back), times(back), T0, full_refresh=True)
    assert {r.chunk_text for r in corpus.chunks().collect()} == {"one again", "two again"}
    assert corpus.last_run() == (2, 2)


def test_full_refresh_keeps_what_it_cannot_read(spark, corpus):
    corpus.sync(listing(spark, ONE), texts(spark, ONE), T0)
    renewed = [("a", 0, "renewed")]
    metrics = corpus.sync(listing(spark, ONE), texts(spark, renewed), T0, full_refresh=True).first()
    assert metrics.rows_unread == 2 and metrics.base_run == 1
    found = {r.path[-1]: r.chunk_text for r in corpus.chunks().where("ordinal = 0").collect()}
    assert found["a"] == "renewed" and found["b"] == "gamma delta" and set(found) == {"a", "b", "c"}
    assert metrics.vector_rows == corpus.chunks().count() == corpus.index().count()


def test_many_pending_files_move_no_text(spark, corpus, rows, monkeypatch):
    monkeypatch.setattr("paperbrook.plans.corpus.MANY_FILES", 0)
    extra = ONE + [("unlisted", 0, "not in the listing")]
    carried = texts(spark, extra).selectExpr("*", "'Housing' category", "2024 year", "5 month")
    corpus.sync(listing(spark, ONE), carried, T0)
    second = texts(spark, TWO).selectExpr("*", "'Housing' category", "2024 year", "5 month")
    corpus.sync(listing(spark, TWO), second, T0)
    live = corpus.tracking().where("is_current").join(texts(spark, TWO), "path")
    assert rows(corpus.chunks().drop("run")) == rows(make_chunks(live))
    path = corpus.folder + "/texts"
    carried.write.parquet(path)
    pending = spark.read.parquet(f"{corpus.folder}/pending/run=1")
    plan = corpus._with_versions(spark.read.parquet(path), pending, 1)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan


def test_lost_tracking_is_an_error(spark, corpus, monkeypatch):
    corpus.sync(listing(spark, ONE), texts(spark, ONE), T0)
    place = Corpus._path
    monkeypatch.setattr(Corpus, "_path", lambda c, table, run=None: place(c, "gone" if table == "tracking" else table, run))
    with pytest.raises(AnalysisException):
        corpus.tracking()
    with pytest.raises(AnalysisException):
        corpus.sync(listing(spark, TWO), texts(spark, TWO), T0)


def test_a_fresh_checkpoint_goes_on_from_the_last_batch(spark, tmp_path):
    root, folder = tmp_path / "in", str(tmp_path / "state")
    target = root / "Housing" / "2024" / "May"
    target.mkdir(parents=True)
    files = lambda: stream_new_files(spark, str(root), "*.txt")
    names = lambda df: sorted(r.path[-5:] for r in df.collect())
    for name in ("a.txt", "b.txt"):
        (target / name).write_bytes(b"x")
        track_stream(files(), folder, f"file:{root}/", T0)
    (target / "c.txt").write_bytes(b"x")
    again = track_stream(files(), folder, f"file:{root}/", T0)
    assert names(again) == ["a.txt", "b.txt", "c.txt"]
    written = spark.read.parquet(f"{folder}/tracking/batch=2")
    assert names(written) == ["c.txt"]
    folded = fold_stream(spark, folder)
    assert names(folded) == names(again) and last_batch(spark, folder) == 3
    (tmp_path / "state" / "checkpoint").rename(tmp_path / "old-checkpoint")
    (target / "d.txt").write_bytes(b"x")
    after = track_stream(files(), folder, f"file:{root}/", T0)
    assert names(after) == ["a.txt", "b.txt", "c.txt", "d.txt"]
    assert {r.version for r in after.collect()} == {1}


def test_a_lost_batch_is_an_error(spark, tmp_path):
    folder = str(tmp_path / "state")
    spark.range(1).write.parquet(f"{folder}/done/batch=4")
    with pytest.raises(AnalysisException):
        latest_batch(spark, folder)


def test_statistics_need_no_counts_of_terms(spark):
    index = spark.createDataFrame([(3, ["a", "b"]), (1, ["b"]), (0, [])], "doc_len int, terms array<string>")
    assert {tuple(r) for r in index_statistics(index).collect()} == {("a", 1, 0), ("b", 2, 0), (None, 3, 4)}


def test_many_files_come_in_several_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("paperbrook.streaming.files.MOST_FILES", 2)
    root, folder = tmp_path / "in", str(tmp_path / "state")
    target = root / "Housing" / "2024" / "May"
    target.mkdir(parents=True)
    for name in "abcde":
        (target / f"{name}.txt").write_bytes(b"x")
    found = track_stream(stream_new_files(spark, str(root), "*.txt"), folder, f"file:{root}/", T0)
    assert sorted((r.path[-5:], r.version, r.status) for r in found.collect()) == [(f"{n}.txt", 1, "NEW") for n in "abcde"]
    assert last_batch(spark, folder) == 2
