"""Files that filters rule out."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from paperbrook.operators import skipping
from paperbrook.operators.filters import apply_filters

COLUMNS = "id int, category string, year int, month int, text string, more map<string,int>"


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(1)
    rows = [
        (n, rng.choice("ABC"), 2020 + rng.randrange(4), rng.randrange(1, 13), " ".join(f"{'xyz'[n % 3]}{rng.randrange(30)}" for _ in range(8)), None)
        for n in range(2000)
    ]
    rows += [(2000, None, None, None, None, None), (2001, "A", None, 3, "", None), (2002, "A", 2020, 1, "Ünï x1-ONLY", None)]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="module")
def clustered(table):
    return skipping.write_clustered(table, tempfile.mkdtemp(prefix="run-") + "/c", ["category", "year", "month"], "text", files=24)


FILTERS = [
    [], [{"key": "category", "value": "B"}], [{"key": "year", "value": [2021, 2023]}, {"key": "month <", "value": 4}],
    [{"key": "year >=", "value": 2023}, {"key": "category NOT", "value": "C"}], [{"key": "year <=", "value": 2019}],
    [{"key": "category OR text", "value": "A"}], [{"key": "text LIKE", "value": "x1 X2"}], [{"key": "text LIKE", "value": "only"}],
    [{"key": "text LIKE", "value": "ünï"}, {"key": "category", "value": "A"}], [{"key": "text LIKE", "value": "nowhere"}],
    [{"key": "id >", "value": 1990}], [{"key": "category", "value": "A"}, {"key": "year", "value": 2022}, {"key": "month", "value": 5}],
]


@pytest.mark.parametrize("number", range(len(FILTERS)))
def test_rows_are_those_of_a_full_scan(table, clustered, rows, number):
    items = FILTERS[number]
    got = clustered.read(items).drop("more")
    assert rows(got) == rows(apply_filters(table, items).drop("more"))


def test_few_files_are_opened(spark, clustered):
    all_files = clustered.files().count()
    assert clustered.files().agg(F.sum("n")).first()[0] == 2003 and all_files > 12
    assert len(clustered.needed(FILTERS[-1])) <= 3
    assert len(clustered.needed(FILTERS[1])) < all_files / 2
    assert len(clustered.needed(FILTERS[7])) == 1 and len(clustered.needed(FILTERS[9])) == 0
    assert len(clustered.needed([])) == all_files
    read = clustered.read(FILTERS[-1]).select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f for r in read} <= set(clustered.needed(FILTERS[-1]))


def test_a_frequent_value_fills_several_files(spark):
    rows = spark.range(3000).select("id", F.lit("same").alias("k"))
    written = skipping.write_clustered(rows, tempfile.mkdtemp(prefix="run-") + "/c", ["k"], files=6)
    assert written.files().agg(F.max("n")).first()[0] < 1500
    empty = skipping.write_clustered(rows.limit(0), tempfile.mkdtemp(prefix="run-") + "/c", ["k"], files=6)
    assert empty.read([{"key": "k", "value": "same"}]).collect() == []


def test_a_table_of_many_splits_gets_as_many_files(spark):
    rows = spark.range(0, 4000, 1, 40).select("id", (F.col("id") % 3).alias("k"), F.lit("a b").alias("text"))
    written = skipping.write_clustered(rows, tempfile.mkdtemp(prefix="run-") + "/c", ["k"], "text", files=4)
    assert written.files().agg(F.max("n")).first()[0] < 400  # four files hold 1,000 each
    assert written.read([{"key": "text LIKE", "value": "a"}]).count() == 4000
