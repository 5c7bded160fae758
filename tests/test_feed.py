"""The change feed as a data source."""

import tempfile

from pyspark.sql import functions as F

from paperbrook.operators.chunk_store import apply_changes, change_feed
from paperbrook.operators.index import build_index
from paperbrook.sources.feed import append_feed, feed_schema, finished_runs, net_changes, read_feed, stream_feed
from paperbrook.sources.tables import write_snapshot
from paperbrook.streaming.files import index_feed

COLUMNS = "chunk_id string, path string, chunk_text string, category string, year int, month int"


def table(spark, texts):
    return spark.createDataFrame([(k, f"p{k}", t, "A", 2024, 1) for k, t in texts.items()], COLUMNS)


STATES = [
    {"a": "one two", "b": "two", "c": "three"}, {"a": "one two", "b": "two again", "d": "four"},
    {"b": "two again", "d": "four", "e": None}, {"b": "back", "c": "three", "d": "four", "e": "five"},
]


def feeds(spark, folder):
    for run, (before, after) in enumerate(zip(STATES, STATES[1:])):
        append_feed(change_feed(table(spark, before), table(spark, after)), folder, run)


def folder():
    return tempfile.mkdtemp(prefix="run-") + "/feed"


def test_runs_come_back_as_they_were_written(spark, rows):
    at = folder()
    assert finished_runs(at) == []
    feeds(spark, at)
    whole = change_feed(table(spark, STATES[0]), table(spark, STATES[1]))
    assert read_feed(spark, at, whole.schema).schema == feed_schema(whole.schema)
    assert rows(read_feed(spark, at, whole.schema, upto=0).drop("run")) == rows(whole)
    assert rows(read_feed(spark, at, whole.schema, after=0, upto=1).drop("run")) == rows(change_feed(table(spark, STATES[1]), table(spark, STATES[2])))
    assert read_feed(spark, at, whole.schema, after=2).count() == 0
    assert read_feed(spark, at, whole.schema).select("run", "chunk_id").where("run = 2").count() == 5  # two updates and an insert


def test_a_run_without_its_mark_does_not_count(spark):
    at = folder()
    feeds(spark, at)
    write_snapshot(table(spark, STATES[0]).withColumn("_change_type", F.lit("insert")), f"{at}/feed/run=3")
    assert finished_runs(at) == [0, 1, 2]
    schema = change_feed(table(spark, STATES[0]), table(spark, STATES[1])).schema
    assert read_feed(spark, at, schema).agg(F.max("run")).first()[0] == 2


def test_several_runs_as_one(spark, rows):
    at = folder()
    feeds(spark, at)
    schema = change_feed(table(spark, STATES[0]), table(spark, STATES[1])).schema
    for after in range(3):
        net = net_changes(read_feed(spark, at, schema, after=after - 1))
        assert rows(apply_changes(table(spark, STATES[after]), net)) == rows(table(spark, STATES[3]))


def test_index_follows_the_stream(spark, rows):
    at = folder()
    first = write_snapshot(build_index(table(spark, STATES[0])), folder())
    schema = change_feed(table(spark, STATES[0]), table(spark, STATES[1])).schema
    append_feed(change_feed(table(spark, STATES[0]), table(spark, STATES[1])), at, 0)
    columns = ["chunk_id", "doc_len", "terms", "tfs"]
    got = index_feed(stream_feed(spark, at, schema), f"{at}/stream", first)
    assert rows(got.select(columns)) == rows(build_index(table(spark, STATES[1])).select(columns))
    feeds(spark, at)  # the first run again, and two more
    for _ in range(2):
        got = index_feed(stream_feed(spark, at, schema), f"{at}/stream", first)
        assert rows(got.select(columns)) == rows(build_index(table(spark, STATES[3])).select(columns))


def test_a_batch_writes_its_own_rows_only(spark, rows):
    at, columns = folder(), ["chunk_id", "doc_len", "terms", "tfs"]
    before = STATES[0] | {f"x{n}": "same" for n in range(20)}
    first = write_snapshot(build_index(table(spark, before)), folder())
    schema = change_feed(table(spark, STATES[0]), table(spark, STATES[1])).schema
    for run, (old, new) in enumerate(zip(STATES, STATES[1:])):
        append_feed(change_feed(table(spark, old), table(spark, new)), at, run)
        got = index_feed(stream_feed(spark, at, schema), f"{at}/stream", first)
        assert rows(got.select(columns)) == rows(build_index(table(spark, STATES[run + 1] | {f"x{n}": "same" for n in range(20)})).select(columns))
    folders = {f for f in __import__("os").listdir(f"{at}/stream") if f != "checkpoint"}
    assert sum(spark.read.parquet(f"{at}/stream/{f}").where("chunk_id like 'x%'").count() for f in folders - {"done"}) == 0
