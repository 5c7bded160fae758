import pytest

from paperbrook.operators.filters import apply_filters, parse_key

ROWS = [
    (1, "amber", "teal", 5, "River wide Bridge"),
    (2, "teal", "olive", 9, "driver"),
    (3, "olive", "amber", 12, "old river_bridge"),
    (4, None, None, None, None),
]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "id int, shade string, trim string, weight int, note string")


@pytest.mark.parametrize("key,value,ids", [
    ("shade", "amber", [1]),
    ("id", [1, 3], [1, 3]),
    ("id", [3], [3]),
    ("shade NOT", "amber", [2, 3]),
    ("shade NOT", ["amber", "teal"], [3]),
    ("weight <", 9, [1]),
    ("weight <=", 9, [1, 2]),
    ("weight >", 9, [3]),
    ("weight>=", 9, [2, 3]),
    ("shade OR trim", ["amber", "white"], [1, 3]),
    ("note LIKE", "river", [1, 3]),
    ("note LIKE", "BRIDGE river", [1, 3]),
    ("note LIKE", "wide", [1]),
])
def test_operators(df, key, value, ids):
    assert sorted(r.id for r in apply_filters(df, [{"key": key, "value": value}]).collect()) == ids


def test_items_are_joined_by_and(df):
    items = [{"key": "weight >", "value": 5}, {"key": "trim", "value": ["amber", "teal"]}]
    assert [r.id for r in apply_filters(df, items).collect()] == [3]
    assert apply_filters(df, []).count() == apply_filters(df, None).count() == 4


@pytest.mark.parametrize("item", [
    {"key": "tone", "value": "amber"},
    {"key": "shade OR nothing", "value": "amber"},
    {"key": "weight", "value": "nine"},
    {"key": "weight", "value": True},
    {"key": "shade", "value": 5},
    {"key": "weight LIKE", "value": "5"},
    {"key": "note LIKE", "value": "..."},
    {"key": "weight <", "value": [1, 2]},
    {"key": "id", "value": []},
    {"key": "", "value": 1},
    {"key": "id"},
    {"key": "id", "value": 1, "more": 2},
])
def test_bad_filters_are_refused_before_any_job(df, item):
    with pytest.raises(ValueError):
        apply_filters(df, [item])


def test_domains_and_allowed_columns(df):
    ok = {"allowed": ["weight", "shade"], "domains": {"weight": (1, 12), "shade": ["amber", "teal"]}}
    assert apply_filters(df, [{"key": "weight", "value": 12}], **ok).count() == 1
    for item in [{"key": "weight", "value": 13}, {"key": "shade", "value": "olive"}, {"key": "id", "value": 1}]:
        with pytest.raises(ValueError):
            apply_filters(df, [item], **ok)


def test_parse_key():
    assert parse_key("month <") == (["month"], "<")
    assert parse_key(" month<= ") == (["month"], "<=")
    assert parse_key("a OR b OR c") == (["a", "b", "c"], "OR")
    assert parse_key("NOTE") == (["NOTE"], "=")


def test_comparisons_reach_the_scan(spark, df, tmp_path):
    df.write.parquet(f"{tmp_path}/t")
    plan = apply_filters(spark.read.parquet(f"{tmp_path}/t"), [{"key": "weight >=", "value": 9}, {"key": "shade", "value": "teal"}])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(weight,9)" in text and "EqualTo(shade,teal)" in text
