"""Term statistics and the stored inverted file against the index they come from."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from paperbrook.operators import inverted, search, statistics
from paperbrook.operators.chunk_store import apply_changes, change_feed
from paperbrook.operators.index import build_index, postings
from paperbrook.session import settings

COLUMNS = "chunk_id string, path string, category string, year int, month int, chunk_text string"


def chunk_rows(rng, count, words=40, vocabulary=60):
    weights = [1 / (i + 1) for i in range(vocabulary)]
    names = [f"w{i}" for i in range(vocabulary)]
    for n in range(count):
        text = " ".join(rng.choices(names, weights, k=rng.randint(0, words)))
        yield f"c{rng.randrange(10**9):09d}-{n}", f"p{n % 7}", rng.choice(["A", "B"]), 2020 + n % 4, n % 12 + 1, text


@pytest.fixture(scope="module")
def chunks(spark):
    rows = list(chunk_rows(random.Random(1), 900))
    rows += [(f"same{n}", "p", "A", 2021, 1, "w1 w2 w3 w50") for n in range(90)] + [("blank", "p", "A", 2021, 1, " . ")]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="module")
def queries(spark):
    rng = random.Random(2)
    rows = [(n, " ".join(f"w{rng.randrange(70)}" for _ in range(rng.randint(1, 12)))) for n in range(25)]
    return spark.createDataFrame(rows + [(90, "no such words"), (91, ""), (92, None), (93, "w1 w2 w3 w50")], "query_id int, text string")


@pytest.fixture(params=[(14, 4, 64), (6, 2, 3)])
def sizes(request, monkeypatch):
    """The module's sizes, and small ones that make many segments, windows and blocks of a few rows."""
    for name, value in zip(("SEGMENT_BITS", "WINDOW_BITS", "BLOCK"), request.param, strict=True):
        monkeypatch.setattr(inverted, name, value)


def hits(rows):
    return sorted((r.query_id, r["rank"], r.chunk_id, r.score) for r in rows.collect())


def written(spark, index):
    return inverted.write_inverted(index, tempfile.mkdtemp(prefix="run-") + "/file", buckets=4)


@pytest.mark.parametrize("filters", [None, [{"key": "category", "value": "A"}, {"key": "month <", "value": 3}], [{"key": "year", "value": 1}]])
@pytest.mark.parametrize("k", [3, 40])
def test_pruned_search_equals_the_plain_one(spark, chunks, queries, sizes, filters, k):
    index = build_index(chunks)
    kept = statistics.index_statistics(index)
    file = written(spark, index)
    want = hits(search.keyword_search(queries, index, k, filters))
    assert want == hits(search.keyword_search(queries, index, k, filters, statistics=kept))
    for most in (200_000, 9):
        found, report = inverted.pruned_keyword_search(queries, file, kept, k, filters, max_broadcast=most)
        assert hits(found) == want
        counts = report.first()
        assert 0 <= counts.scored and (want == [] or counts.postings > 0)


def test_postings_come_back_from_the_blocks(spark, chunks, sizes, rows):
    index = build_index(chunks)
    file = written(spark, index)
    got = file.postings().join(file.docs().select("doc", "chunk_id"), "doc").select("term", "chunk_id", "tf", "doc_len")
    assert rows(got) == rows(postings(index, "chunk_id", "doc_len").select("term", "chunk_id", "tf", "doc_len"))
    assert [r.chunk_id for r in file.docs().orderBy("doc").collect()] == sorted(r.chunk_id for r in chunks.collect())


def test_only_folders_of_the_terms_are_read(spark, chunks):
    file = written(spark, build_index(chunks))
    (bucket,) = [r.bucket for r in file.blocks().where("term = 'w1'").select("bucket").distinct().collect()]
    plan = file.blocks(["w1"])._jdf.queryExecution().executedPlan().toString()
    assert str(bucket) in plan.split("PartitionFilters")[1].split("]")[0]
    read = file.blocks(["w1"]).select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f.split("bucket=")[1].split("/")[0] for r in read} == {str(bucket)}


def test_blocks_are_skipped_and_few_postings_scored(spark, queries):
    rng = random.Random(4)
    rows = [(f"c{n:06d}", "p", "A", 2020, 1, " ".join(["w0"] * 3 + rng.choices([f"w{i}" for i in range(2000)], k=30))) for n in range(6000)]
    index = build_index(spark.createDataFrame(rows, COLUMNS))
    asked = spark.createDataFrame([(n, f"w0 w{n} w{n + 1} w{n + 7}") for n in range(20)], "query_id int, text string")
    kept = statistics.index_statistics(index)
    found, report = inverted.pruned_keyword_search(asked, written(spark, index), kept, 10)
    assert hits(found) == hits(search.keyword_search(asked, index, 10))
    counts = report.first()
    assert counts.scored < 0.3 * counts.postings


def test_bounds_hold_when_the_mean_length_has_changed(spark, chunks, queries, sizes):
    index = build_index(chunks)
    file = written(spark, index)
    longer = statistics.sync_statistics(statistics.index_statistics(index), spark.createDataFrame([(None, 0, 9000)], "term string, df bigint, length bigint"))
    found, _ = inverted.pruned_keyword_search(queries, file, longer, 7)
    assert hits(found) == hits(search.keyword_search(queries, index, 7, statistics=longer))


def test_statistics_after_a_feed_equal_a_rebuild(spark, chunks, rows):
    rng = random.Random(3)
    kept = chunks.where("year <> 2022").withColumn("chunk_text", F.when(F.col("month") == 2, "w1 new").otherwise(F.col("chunk_text")))
    new = kept.unionByName(spark.createDataFrame(list(chunk_rows(rng, 50)), COLUMNS))
    feed = change_feed(chunks, new)
    delta = statistics.feed_delta(feed)
    got = statistics.sync_statistics(statistics.index_statistics(build_index(chunks)), delta)
    want = statistics.index_statistics(build_index(apply_changes(chunks, feed)))
    assert rows(got) == rows(want)
    back = statistics.feed_delta(change_feed(new, chunks))
    assert rows(statistics.sync_statistics(got, back)) == rows(statistics.index_statistics(build_index(chunks)))


def test_empty_index(spark, chunks, queries):
    index = build_index(chunks.limit(0))
    kept = statistics.index_statistics(index)
    assert statistics.totals(kept) == (0, 0.0)
    file = written(spark, index)
    assert file.postings().collect() == [] and file.blocks(["w1"]).collect() == []
    found, report = inverted.pruned_keyword_search(queries, file, kept)
    assert found.collect() == [] and report.first().scored == 0
    assert search.keyword_search(queries, index, statistics=kept).collect() == []


def test_a_segment_is_inverted_where_it_stands(spark, rows):
    made = [(f"c{n:04d}", "p", "A", 2020, 1, "w " * (n % 5) + f"x{n % 3}") for n in range(300)]
    index = build_index(spark.createDataFrame(made, COLUMNS))
    file = written(spark, index)
    docs = spark.read.parquet(f"{file.folder}/docs")
    plan = inverted._block_rows(docs, 3.0)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan
    assert "aggregate(" not in file.postings()._jdf.queryExecution().analyzed().toString()
    got = file.postings().join(file.docs().select("doc", "chunk_id"), "doc").select("term", "chunk_id", "tf", "doc_len")
    assert rows(got) == rows(postings(index, "chunk_id", "doc_len").select("term", "chunk_id", "tf", "doc_len"))


def test_decoded_postings_are_not_moved(spark, chunks, sizes, rows):
    index = build_index(chunks)
    file = written(spark, index)
    got = file.postings(["chunk_id", "category"])
    assert rows(got.drop("doc")) == rows(postings(index, "chunk_id", "doc_len", "category").select("term", "tf", "doc_len", "chunk_id", "category"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("MapInArrow")[0] and plan.count("MapInArrow") == 1
    assert written(spark, index.limit(0)).postings(["chunk_id"]).collect() == []


def test_segments_stay_whole_where_a_join_turns_into_a_broadcast(spark, chunks, queries, monkeypatch):
    for name, value in (("SEGMENT_BITS", 5), ("WINDOW_BITS", 2), ("BLOCK", 3)):
        monkeypatch.setattr(inverted, name, value)
    index = build_index(chunks)
    kept, file = statistics.index_statistics(index), written(spark, index)
    items = [{"key": "category", "value": "A"}, {"key": "month <", "value": 3}]
    want = hits(search.keyword_search(queries, index, 5, items))
    late = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": str(10 << 20)}
    with settings(spark, late):
        found, _ = inverted.pruned_keyword_search(queries, file, kept, 5, items)
        assert hits(found) == want
