import tempfile
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from paperbrook.operators import reports, tracking
from paperbrook.sources.schemas import TRACKING
from paperbrook.sources.tables import bucketed_table, empty_tracking, table_or_empty, write_bucketed, write_snapshot

T0 = datetime(2024, 1, 1)
LISTING = "path string, length long, modification_ts timestamp, ingest_ts timestamp, category string, year int, month int"


def listing(spark, files):
    rows = [(p, 10 + m, T0 + timedelta(minutes=m), T0, "Housing", 2024, 5) for p, m in files]
    return spark.createDataFrame(rows, LISTING)


def state(track):
    return {r.path: (r.status, r.version, r.is_current) for r in track.collect()}


@pytest.fixture
def indexed(spark, tmp_path):
    track = tracking.track_sync(empty_tracking(spark), listing(spark, [("a", 0), ("b", 0), ("c'\"%20", 0)]))
    track = write_snapshot(track, f"{tmp_path}/new")
    return write_snapshot(tracking.track_mark_indexed(track, tracking.to_index(track), T0), f"{tmp_path}/indexed")


def test_new_then_indexed(indexed):
    assert state(indexed) == {p: ("INDEXED", 1, True) for p in ["a", "b", "c'\"%20"]}
    assert indexed.schema.simpleString() == TRACKING.simpleString()
    assert {r.indexed_at for r in indexed.collect()} == {T0}


def test_update_needs_a_newer_time_and_keeps_indexed_at(spark, indexed):
    after = tracking.track_upsert(indexed, listing(spark, [("a", 1), ("b", 0), ("d", 0)]))
    assert state(after) == {
        "a": ("UPDATED", 2, True), "b": ("INDEXED", 1, True), "c'\"%20": ("INDEXED", 1, True), "d": ("NEW", 1, True)
    }
    row = after.where("path = 'a'").first()
    assert (row.length, row.modification_ts, row.indexed_at) == (11, T0 + timedelta(minutes=1), T0)


def test_older_time_changes_nothing(spark, indexed):
    assert state(tracking.track_upsert(indexed, listing(spark, [("a", -1)])))["a"] == ("INDEXED", 1, True)


def test_deleted_and_returning_files(spark, indexed):
    gone = tracking.track_sync(indexed, listing(spark, [("a", 0), ("b", 0)]))
    assert state(gone)["c'\"%20"] == ("DELETED", 1, False)
    same = listing(spark, [("a", 0), ("b", 0), ("c'\"%20", 0)])
    newer = listing(spark, [("a", 0), ("b", 0), ("c'\"%20", 5)])
    assert state(tracking.track_sync(gone, same))["c'\"%20"] == ("DELETED", 1, False)
    assert state(tracking.track_sync(gone, same, revive=True))["c'\"%20"] == ("UPDATED", 2, True)
    assert state(tracking.track_sync(gone, newer))["c'\"%20"] == ("UPDATED", 2, True)


def test_sync_is_upsert_then_delete(spark, indexed, rows):
    files = listing(spark, [("a", 3), ("d", 0)])
    two_steps = tracking.track_mark_deleted(tracking.track_upsert(indexed, files), files)
    assert rows(tracking.track_sync(indexed, files)) == rows(two_steps)
    assert rows(tracking.deleted_paths(indexed, files)) == [("b",), ("c'\"%20",)]


def test_sync_twice_is_a_no_op(spark, indexed, rows):
    files = listing(spark, [("a", 3), ("d", 0)])
    once = tracking.track_sync(indexed, files)
    assert rows(tracking.track_sync(once, files)) == rows(once)


def test_empty_listing_deletes_all(spark, indexed):
    assert set(state(tracking.track_sync(indexed, listing(spark, []))).values()) == {("DELETED", 1, False)}


def test_duplicate_source_key_fails(spark, indexed):
    with pytest.raises(PySparkException, match="duplicate merge key in path: a"):
        tracking.track_upsert(indexed, listing(spark, [("a", 1), ("a", 2)])).count()


def test_full_refresh_takes_indexed_files_too(spark, indexed):
    assert tracking.to_index(indexed).count() == 0
    assert tracking.to_index(indexed, full_refresh=True).count() == 3


def test_reports(spark, indexed, rows):
    track = tracking.track_sync(indexed, listing(spark, [("a", 1)]))
    assert rows(reports.status_counts(track)) == [("DELETED", 2), ("UPDATED", 1)]
    assert rows(reports.category_status_counts(track)) == [("Housing", "DELETED", 2), ("Housing", "UPDATED", 1)]
    assert rows(reports.run_metrics(track, track.agg(F.count("*")).scalar(), 1024, 256)) == [(1, 2, 3, 1024, 256)]


def test_missing_table_reads_as_empty(spark, tmp_path):
    assert table_or_empty(spark, f"{tmp_path}/none", TRACKING).count() == 0
    assert table_or_empty(spark, "no_such_table", TRACKING).count() == 0


def test_one_shuffle_per_side(spark, indexed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = tracking.track_sync(indexed, listing(spark, [("a", 1)]))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 2


def test_merge_into_a_bucketed_table_moves_only_the_listing(spark, rows):
    first = [("a", 0), ("b", 0), ("c", 5), ("d", 1)]
    second = [("a", 1), ("b", 0), ("e", 3), ("d", 0)]
    track = tracking.track_sync(empty_tracking(spark), listing(spark, first))
    folder = tempfile.mkdtemp(prefix="run-") + "/one"
    old = write_bucketed(track, folder, "path", 5)
    assert rows(old) == rows(track)
    again = bucketed_table(spark, folder, track.schema, "path", 5)
    for kept in (old, again):
        new = tracking.track_sync_bucketed(kept, listing(spark, second), 5)
        plan = new._jdf.queryExecution().executedPlan().toString()
        assert rows(new) == rows(tracking.track_sync(track, listing(spark, second)))
        assert plan.count("Exchange") == 1 and plan.count("Bucketed: true") == 1
    target = tempfile.mkdtemp(prefix="run-") + "/two"
    written = write_bucketed(new, target, "path", 5, dealt=True)
    assert rows(written) == rows(new)
    third = tracking.track_sync_bucketed(written, listing(spark, first), 5)
    assert third._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert rows(third) == rows(tracking.track_sync(tracking.track_sync(track, listing(spark, second)), listing(spark, first)))
    assert len(list(Path(target).glob("part-*"))) <= 5  # every task has one bucket
