import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from paperbrook.functions.splitting import chunk_spans
from paperbrook.operators import chunking


def plain_split(text, size, overlap, separators=("\n\n", "\n", " ", "")):
    """The same rules on lists of strings, for comparison."""
    at = next(i for i, s in enumerate(separators) if s == "" or s in text)
    sep = separators[at]
    pieces = list(text) if sep == "" else [p for p in re.split(f"(?={sep})" if len(sep) == 1 else sep, text)]
    if sep == "\n\n":
        pieces = [pieces[0]] + [sep + p for p in pieces[1:]]
    chunks, run = [], []

    def pack():
        held = []
        for piece in run:
            if held and len("".join(held)) + len(piece) > size:
                chunks.append("".join(held))
                while held and (len("".join(held)) > overlap or len("".join(held)) + len(piece) > size):
                    held.pop(0)
            held.append(piece)
        if held:
            chunks.append("".join(held))
        run.clear()

    for piece in filter(None, pieces):
        if len(piece) < size or sep == "":
            run.append(piece)
        else:
            pack()
            chunks.extend(plain_split(piece, size, overlap, separators[at + 1 :]))
    pack()
    return [c.strip() for c in chunks if c.strip()]


def split(text, size, overlap):
    return [text[a:b] for a, b in chunk_spans(text, size, overlap)]


texts = st.lists(st.sampled_from(["a", "bb", "ccccc", " ", "\n", "\n\n", "é", "日本", "dddddddddddd"]), max_size=60).map("".join)


@settings(max_examples=400, deadline=None)
@given(texts, st.integers(2, 20), st.integers(0, 19))
def test_splitter_follows_the_plain_rules(text, size, overlap):
    overlap %= size
    assert split(text, size, overlap) == plain_split(text, size, overlap)


@settings(max_examples=200, deadline=None)
@given(texts, st.integers(2, 20), st.integers(0, 19))
def test_splitter_invariants(text, size, overlap):
    overlap %= size
    spans = list(chunk_spans(text, size, overlap))
    assert all(0 < b - a <= size for a, b in spans)
    covered = {i for a, b in spans for i in range(a, b)}
    assert all(text[i].isspace() for i in range(len(text)) if i not in covered)
    assert all(b - a2 <= overlap for (_, b), (a2, _) in zip(spans, spans[1:]))


@pytest.mark.parametrize("text,expected", [
    ("", []), ("a", ["a"]), (" \n ", []), ("x" * 1024, ["x" * 1024]),
    ("x" * 1025, ["x" * 1024, "x" * 257]),
])
def test_edge_texts(text, expected):
    assert split(text, 1024, 256) == expected


def test_paragraphs_stay_whole():
    first, second = "a " * 300, "b " * 300
    assert split(first + "\n\n" + second, 1024, 256) == [first.strip(), second.strip()]


def test_chunk_recursive_on_spark(spark):
    long_text = "word " * 1000
    df = spark.createDataFrame([("p", long_text), ("q", None), ("r", ""), ("s", "日本")], "path string, text string")
    rows = chunking.chunk_recursive(df, 100, 20).orderBy("path", "ordinal").collect()
    assert [r.chunk_text for r in rows if r.path == "p"] == split(long_text, 100, 20)
    assert [(r.path, r.chunk_text) for r in rows if r.path != "p"] == [("s", "日本")]
    assert all(long_text[r.start : r.end] == r.chunk_text for r in rows if r.path == "p")


@pytest.mark.parametrize("size,overlap", [(10, 3), (10, 7), (5, 0), (7, 6)])
def test_chunk_fixed_windows(spark, size, overlap):
    texts = ["", "a", "abcdefghij", "abcdefghijk", "né\nxt" * 9]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    step = size - overlap
    expected = sorted(
        (i, n, s, min(s + size, len(t)), t[s : s + size])
        for i, t in enumerate(texts) if t
        for n, s in enumerate(range(0, max(len(t) - overlap, 1), step))
    )
    assert sorted(tuple(r) for r in chunking.chunk_fixed(df, size, overlap).collect()) == expected


def test_every_file_is_split_and_ids_are_stable(spark, rows):
    files = spark.createDataFrame(
        [(f"f{i}", 1, "Housing", 2024, None, f"text {i} " * 300) for i in range(5)],
        "path string, version long, category string, year int, month int, text string",
    )
    chunks = chunking.make_chunks(files)
    assert {r.path for r in chunks.collect()} == {f"f{i}" for i in range(5)}
    assert chunks.select("chunk_id").distinct().count() == chunks.count()
    assert rows(chunks) == rows(chunking.make_chunks(files.repartition(3)))


def test_bad_sizes_are_refused(spark):
    df = spark.createDataFrame([("a",)], "text string")
    for size, overlap in [(0, 0), (10, 10), (10, -1)]:
        with pytest.raises(ValueError):
            chunking.chunk_recursive(df, size, overlap)


def test_few_texts_of_a_batch_are_split_at_a_time(monkeypatch):
    seen = []
    spans = chunking.chunk_spans
    kept = {}
    monkeypatch.setattr(chunking.F, "arrow_udf", lambda f, t: kept.setdefault("split", f) and (lambda c: c))
    chunking.recursive_chunks(None)
    texts = [("word " * (n % 400)).strip() or None for n in range(1000)]

    monkeypatch.setattr(chunking, "FEW_TEXTS", 1000)
    whole = kept["split"](chunking.pa.array(texts))
    monkeypatch.setattr(chunking, "FEW_TEXTS", 7)
    monkeypatch.setattr(chunking, "chunk_spans", lambda *a: seen.append(1) or spans(*a))
    assert kept["split"](chunking.pa.array(texts)).equals(whole) and seen
    assert len(kept["split"](chunking.pa.array([], chunking.pa.string()))) == 0
