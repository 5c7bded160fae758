"""Every registered query against its SQL, on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as registered  # noqa: E402
from check_oracles import TABLES, normal, repr_value  # noqa: E402

from paperbrook.plans.oracles import ORACLES  # noqa: E402
from paperbrook.plans.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(registered.queries()) and set(registered.oracle_sql()) <= set(registered.queries())


def test_entry(spark):
    assert registered.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, name):
    got = normal(QUERIES[name](spark, SF).toPandas())
    want = normal(db.execute(ORACLES[name]).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want)
    assert got.map(repr_value).equals(want.map(repr_value))
