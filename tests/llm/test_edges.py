"""Every operator on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from paperbrook.llm import (
    chaining,
    decontaminate,
    mixing,
    packing,
    permutation,
    quality,
    secret_scan,
    simhash,
    toxicity,
    warc,
)

LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(60_000))
ROWS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda", "a"),
    (2, None, "a"), (3, "", None), (4, " \t\n", "b"), (5, LONG, "b"), (6, LONG, "b"),
    (7, "same words here for all of us", "a"), (7, "same words here for all of us", "a"), (7, "another text of the id", "b"),
    (None, "a text without an id", "b"), (None, None, None), (8, "ñandú " * 70, "é"), (-100, "one", "a"),
]
CLASHES = [
    "row", "words", "n_words", "pos", "shingle", "item", "node", "seed", "bucket", "n", "f0", "root", "component_id",
    "score", "x", "hits", "y", "u", "block", "size", "target", "copies", "span", "kind", "start", "end", "payload",
    "digest", "first", "v", "ranks", "query_id", "gone_id", "taken_id", "_score", "partner", "tokens", "piece", "shard",
]


def with_clashes(frame):
    return frame.select("*", *[F.lit("other").alias(c) for c in CLASHES if c not in frame.columns])


@pytest.fixture
def labels(spark):
    return spark.createDataFrame(
        [(i, int(i > 3), int(i % 3 == 0)) for i in range(1, 9)] + [(None, 1, 1), (5, None, None)],
        "doc_id bigint, quality int, toxic int",
    )


@pytest.fixture
def operators(spark, labels, tmp_path):
    items = spark.createDataFrame(
        [(1, "alpha beta gamma delta"), (2, None), (3, ""), (None, "one two"), (1, "alpha beta gamma delta")],
        "item_id bigint, text string",
    )
    return {
        "find_items": lambda d: decontaminate.find_items(d, items),
        "near_duplicates": lambda d: simhash.near_duplicates(d),
        "score_toxicity": lambda d: toxicity.score_all(d, labels),
        "mix": lambda d: mixing.mix(d),
        "token_output": lambda d: packing.token_output(d).where("piece = 0"),
        "scan": lambda d: secret_scan.scan(d),
        "score_quality": lambda d: quality.score_all(d, labels),
        "passages": lambda d: chaining.repeated_passages(d),
    }


NAMES = ["find_items", "near_duplicates", "score_toxicity", "mix", "token_output", "scan", "score_quality"]


@pytest.mark.parametrize("name", NAMES)
def test_a_row_for_every_row(documents, operators, name):
    given = documents(ROWS)
    plain = sorted(map(repr, operators[name](given).drop("shard").collect()))
    assert len(plain) == len(ROWS)
    clashing = sorted(map(repr, operators[name](with_clashes(given)).drop("shard").collect()))
    assert clashing == plain


@pytest.mark.parametrize("name", [*NAMES, "passages"])
def test_empty_table(documents, operators, name):
    assert operators[name](documents([])).count() == 0


def test_defined_results(documents, operators):
    given = documents(ROWS)
    items = {(r.doc_id, r.n_words): r for r in operators["find_items"](given).collect()}
    assert items[1, 11].items == ["1"] and items[1, 11].n_hit == 4
    assert items[2, 0].n_hit == 0 and items[5, 60_000].n_items == 0
    scores = {r.doc_id: r.score for r in operators["score_toxicity"](given).collect() if r.doc_id in (2, 3, 4)}
    assert len(set(scores.values())) == 1
    groups = {}
    for r in operators["near_duplicates"](given).collect():
        groups.setdefault(r.component_id, []).append(r.doc_id)
    assert sorted(groups[2], key=str) == [2, 3, 4, None] and groups[5] == [5, 6]


def test_passages_of_edges(documents):
    found = chaining.repeated_passages(with_clashes(documents(ROWS))).collect()
    assert [(r.doc_id, r.other_id, r.kind, r.end) for r in found] == [(6, 5, "copy", 60_000)]


@pytest.mark.parametrize("drop", [
    lambda d, s: toxicity.drop_toxic(d, s), lambda d, s: simhash.keep_firsts(d),
    lambda d, s: decontaminate.drop_contaminated(d, s.selectExpr("doc_id as item_id", "'one' as text")),
    lambda d, s: mixing.mixed(d),
])
def test_stages_keep_the_columns(documents, labels, drop):
    given = with_clashes(documents(ROWS))
    kept = drop(given, labels)
    assert kept.columns == given.columns and kept.schema["doc_id"] == given.schema["doc_id"]
    assert {r.doc_id for r in kept.select("doc_id").collect()} <= {r[0] for r in ROWS}
    assert drop(documents([]), labels).count() == 0


def test_vectors(spark):
    rows = [(i, [float(i % 7), 1.0, float(i)]) for i in range(1, 60)]
    odd = [(100, None), (101, [0.0, 0.0, 0.0]), (102, [1.0, None, 2.0]), (103, [float("nan"), 1.0, 1.0]),
           (104, [float("inf"), 1.0, 1.0]), (105, [1.0, 2.0]), (None, [1.0, 1.0, 1.0]), (59, [3.0, 1.0, 59.0])]
    given = spark.createDataFrame(rows + odd, "vec_id bigint, embedding array<float>")
    is_query = F.col("vec_id") % 20 == 0
    found = permutation.nearest(with_clashes(given), is_query).collect()
    assert {r.query_id for r in found} == {20, 40} and {r.vec_id for r in found} <= set(range(1, 60))
    assert all(r.query_id != r.vec_id for r in found)
    assert permutation.nearest(given.limit(0), is_query).count() == 0
    assert permutation.nearest(given.where("vec_id = 101"), is_query).count() == 0


def test_pages(spark):
    rows = [(1, "http://a", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://b\r\nEvil: 1", None), (4, "u", ""), (5, "u", LONG),
            (None, "u", "<p>x</p>"), (6, "u", "ñ"), (6, "u", "ñ")]
    given = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = sorted(warc.archive_and_read(with_clashes(given)).collect(), key=str)
    assert len(found) == len(rows)
    kinds = sorted(((r.page_id or 0), r.record_type, r.refers_to, r.payload_bytes) for r in found)
    assert kinds == [
        (0, "revisit", 2, 8), (1, "revisit", 2, 8), (2, "response", None, 8), (3, "revisit", 4, 0), (4, "response", None, 0),
        (5, "response", None, len(LONG)), (6, "response", None, 2), (6, "response", None, 2),
    ]
    assert warc.archive_and_read(given.limit(0)).count() == 0
