import pytest
from pyspark.sql import functions as F

from paperbrook.functions import paths
from paperbrook.sources.files import list_files, read_contents


def metadata(spark, path, root="/r.x/"):
    return paths.path_metadata(spark.createDataFrame([(path,)], "path string"), root).first()


@pytest.mark.parametrize("name,number", [
    ("January", 1), ("feb", 2), ("MARCH", 3), ("may", 5), ("Sept", 9), ("SEP", 9), ("september", 9), ("dec", 12),
    ("foo", None), (" may", None), ("", None), (None, None),
])
def test_month_number(spark, name, number):
    df = spark.createDataFrame([(name,)], "m string").select(paths.month_number(F.col("m")))
    assert df.first()[0] == number


def test_every_month_has_its_names():
    assert len(paths.month_numbers()) == 24
    assert sorted(set(paths.month_numbers().values())) == list(range(1, 13))


def test_metadata_of_a_full_path(spark):
    row = metadata(spark, "/r.x/Housing/2024/Sept/a b+c%20'd'.pdf")
    assert (row.category, row.year, row.month) == ("Housing", 2024, 9)
    assert row.levels == ["Housing", "2024", "Sept", "a b+c%20'd'.pdf"]


@pytest.mark.parametrize("path,expected", [
    ("/r.x/only.pdf", ("only.pdf", None, None)),
    ("/r.x/Housing/20x4/May/a.pdf", ("Housing", None, 5)),
    ("/r.x/Housing/2024/a.pdf", ("Housing", 2024, None)),
    (None, (None, None, None)),
])
def test_shallow_and_odd_paths_give_nulls(spark, path, expected):
    row = metadata(spark, path)
    assert (row.category, row.year, row.month) == expected


def test_root_is_literal_and_only_a_prefix(spark):
    assert metadata(spark, "/r.x/a/r.x/b").rel_path == "a/r.x/b"
    assert metadata(spark, "/rzx/a").rel_path == "/rzx/a"


@pytest.mark.parametrize("uri,decode,expected", [
    ("store:/files/a%20b", False, "/files/a%20b"),
    ("store:/files/a%20b+c", True, "/files/a b+c"),
    ("file:///x/y", False, "/x/y"),
    ("/x/100%", True, "/x/100%"),
])
def test_normalise_uri(spark, uri, decode, expected):
    df = spark.createDataFrame([(uri,)], "u string").select(paths.normalise_uri(F.col("u"), decode))
    assert df.first()[0] == expected


def test_listing_walks_folders_and_matches_any_case(spark, tmp_path):
    names = ["Housing/2024/May/a.pdf", "Housing/Sub Dir/b+c.PDF", "c.txt"]
    for name in names:
        target = tmp_path / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(b"12345")
    listed = list_files(spark, str(tmp_path))
    found = {r.path.removeprefix(f"file:{tmp_path}/"): r.length for r in listed.collect()}
    assert found == {names[0]: 5, names[1]: 5}
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1].split(">")[0]
    assert [bytes(r.content) for r in read_contents(spark, str(tmp_path), "*.txt").collect()] == [b"12345"]


@pytest.mark.parametrize(("glob", "names"), [
    ("*.[pP][dD][fF]", ["/x/a.PDF", "c.pdf"]),
    ("*.tar.gz", ["a.tar.gz"]),
    ("?.{pdf,txt}", ["c.pdf", "/y/d.txt"]),
    ("[!ac]*", ["b.pdfx", "/y/d.txt"]),
    ("a.*", ["/x/a.PDF", "a.tar.gz", "a.tarXgz"]),
])
def test_glob_on_rows(spark, glob, names):
    rows = [("/x/a.PDF",), ("b.pdfx",), ("c.pdf",), ("a.tar.gz",), ("a.tarXgz",), ("/y/d.txt",), (None,)]
    df = spark.createDataFrame(rows, "p string")
    assert sorted(r.p for r in df.where(paths.glob_match(F.col("p"), glob)).collect()) == sorted(names)
