"""Digest trees and the feed they narrow down."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from paperbrook.operators import digests
from paperbrook.operators.chunk_store import change_feed

COLUMNS = "chunk_id string, path string, chunk_text string, year int"


def chunk_rows(count, text="t"):
    return [(f"c{n}", f"p{n // 3}", f"{text}{n}", n % 5 or None) for n in range(count)]


def written(spark, rows, buckets=64, **more):
    df = rows if hasattr(rows, "columns") else spark.createDataFrame(rows, COLUMNS)
    return digests.write_digested(df, tempfile.mkdtemp(prefix="run-") + "/s", buckets=buckets, **more)


@pytest.mark.parametrize(("buckets", "fanout"), [(1, 4), (64, 2), (64, 4), (32, 1)])
def test_feed_equals_that_of_whole_tables(spark, rows, buckets, fanout):
    rng = random.Random(buckets + fanout)
    before = chunk_rows(200)
    after = [r for r in before if rng.random() > 0.02] + [("new", "p900", None, 1)]
    after = [(r[0], r[1], "changed", r[3]) if rng.random() < 0.02 else r for r in after]
    rng.shuffle(after)
    old, new = written(spark, before, buckets, fanout_bits=fanout), written(spark, after, buckets, fanout_bits=fanout)
    want = change_feed(spark.createDataFrame(before, COLUMNS), spark.createDataFrame(after, COLUMNS))
    assert rows(digests.change_feed_by_digests(old, new, fanout_bits=fanout)) == rows(want)
    differ = {r["path"] for r in want.select("path").collect()}
    where = {r["b"] for r in spark.createDataFrame([(p,) for p in differ], "p string").select(digests.salt(F.col("p"), buckets).alias("b")).collect()}
    assert set(digests.unequal_buckets(old, new, fanout)) == where


def test_equal_tables_in_any_order_are_equal(spark, rows):
    given = chunk_rows(100)
    old, new = written(spark, given), written(spark, spark.createDataFrame(given[::-1], COLUMNS).repartition(5))
    assert digests.unequal_buckets(old, new) == []
    assert digests.change_feed_by_digests(old, new).collect() == []


def test_only_unequal_folders_are_read(spark):
    before = chunk_rows(300)
    after = [(c, p, "x" if c == "c77" else t, y) for c, p, t, y in before]
    old, new = written(spark, before), written(spark, after)
    (bucket,) = digests.unequal_buckets(old, new)
    plan = digests.change_feed_by_digests(old, new)._jdf.queryExecution().executedPlan().toString()
    filters = [part.split("]")[0] for part in plan.split("PartitionFilters")[1:]]
    assert len(filters) == 2 and all(str(bucket) in f for f in filters)
    read = old.rows([bucket]).select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f.split("_bucket=")[1].split("/")[0] for r in read} == {str(bucket)}


def test_rows_that_come_and_go_and_repeat(spark, rows):
    one, two = [("a", "p", "x", 1)], [("a", "p", "x", 1), ("a2", "p", "x", 1)]
    for before, after in ((one, two), (two, one), ([], one), (one, []), ([("a", "p", None, 1)], one)):
        got = digests.change_feed_by_digests(written(spark, before), written(spark, after))
        assert rows(got) == rows(change_feed(spark.createDataFrame(before, COLUMNS), spark.createDataFrame(after, COLUMNS)))
    # values that move between columns, and nulls, change the hash
    assert digests.unequal_buckets(written(spark, [("a", "p", "x", None)]), written(spark, [("a", "p", "x", 0)]))
    with pytest.raises(ValueError, match="cut differently"):
        digests.unequal_buckets(written(spark, one, 8), written(spark, one, 16))
    with pytest.raises(ValueError, match="power of two"):
        written(spark, one, 12)
