import random

import pytest

from paperbrook.operators import chunk_store

SCHEMA = "path string, chunk_id string, chunk_text string, year int"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def old(spark):
    return table(spark, [("p", "1", "a", 1), ("p", "2", "b", 1), ("q", "3", None, None)])


def test_upsert_replace_delete(spark, old, rows):
    new = table(spark, [("p", "2", "B", 2), ("r", "4", "c", 2)])
    assert [r[1:3] for r in rows(chunk_store.chunk_upsert(old, new))] == [("1", "a"), ("2", "B"), ("3", None), ("4", "c")]
    assert [r[1] for r in rows(chunk_store.chunk_replace(old, new, new.select("path")))] == ["2", "3", "4"]
    assert [r[1] for r in rows(chunk_store.chunk_delete(old, table(spark, [("p", "9", "", 0)])))] == ["3"]


def test_feed_kinds_and_nulls(spark, old, rows):
    new = table(spark, [("p", "1", "a", 1), ("p", "2", "b", None), ("s", "5", "n", 1)])
    feed = chunk_store.change_feed(old, new)
    assert rows(feed.select("_change_type", "chunk_id", "year")) == [
        ("delete", "3", None), ("insert", "5", 1), ("update_postimage", "2", None), ("update_preimage", "2", 1)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_applying_the_feed_gives_the_new_table(spark, rows, seed):
    pick = random.Random(seed)

    def some():
        return [(f"p{i % 3}", str(i), pick.choice(["a", "b", None]), pick.choice([1, None])) for i in range(20) if pick.random() < 0.6]

    old, new = table(spark, some()), table(spark, some())
    feed = chunk_store.change_feed(old, new)
    assert rows(chunk_store.apply_changes(old, feed)) == rows(new)
    assert chunk_store.change_feed(new, new).count() == 0


def test_scope_limits_the_work_not_the_result(spark, old, rows):
    new = table(spark, [("p", "1", "x", 1), ("q", "3", None, None)])
    scope = spark.createDataFrame([("p",)], "path string")
    assert rows(chunk_store.change_feed(old, new, scope=scope)) == rows(chunk_store.change_feed(old, new))
