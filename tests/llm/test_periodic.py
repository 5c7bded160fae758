"""Periodic runs against brute force over all lags."""

import hashlib
import random
import zlib

import duckdb
from pyspark.sql import functions as F

from paperbrook.llm import periodic
from paperbrook.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def runs_by_all_lags(words):
    """(start, length, period) by start, then period; smaller lags first, so that each stretch keeps its smallest."""
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        at = 0
        while at + q < n:
            start = at
            while at + q < n and words[at] == words[at + q]:
                at += 1
            length = at - start + q
            if at > start and length >= max(12, 2 * q):
                found.setdefault((start, length), q)
            at += at == start
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def rebuilt(doc_id, words):
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is None or h % 10 or not n:
        return list(words)
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, text, rewritten=True):
    words = (text or "").encode().split()
    words = rebuilt(doc_id, words) if rewritten else words
    runs = runs_by_all_lags(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (
        len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
    )


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def random_text(rng):
    words = []
    for _ in range(rng.randint(0, 6)):
        kind = rng.random()
        if kind < 0.3:
            words += [str(rng.randint(0, rng.choice([1, 2, 5]))) for _ in range(rng.randint(0, 40))]
        elif kind < 0.8:
            part = [str(rng.randint(0, rng.choice([1, 3, 50]))) for _ in range(rng.randint(1, 60))]
            words += (part * rng.randint(1, 6))[: rng.randint(1, 300)]
        elif words:
            at = rng.randrange(len(words))
            words += words[at : at + rng.randint(1, 120)]
    return [w.encode() for w in words]


def test_runs_by_all_lags():
    rng = random.Random(5)
    for _ in range(400):
        texts = [random_text(rng) for _ in range(rng.randint(1, 4))]
        for words, found in zip(texts, periodic.runs_in(texts), strict=True):
            got = [tuple(row) for row in zip(*(c.tolist() for c in found), strict=True)]
            assert got == runs_by_all_lags(words)


def test_small_groups_and_few_pairs_at_once(monkeypatch):
    monkeypatch.setattr(periodic, "PAIRS", 3)
    monkeypatch.setattr(periodic, "STEP", 2)
    test_runs_by_all_lags()


def test_one_word_over_and_over_is_one_run():
    (found,) = periodic.runs_in([[b"a"] * 30_000])
    assert [c.tolist() for c in found] == [[0], [30_000], [1]]


def test_lines_with_one_word_changed_are_no_run():
    line = [b"w%d" % i for i in range(30)]
    (found,) = periodic.runs_in([line + [b"x"] + line[1:]])
    assert not len(found.start)
    (found,) = periodic.runs_in([[b"x"] + line + line + [b"y"]])
    assert [c.tolist() for c in found] == [[1], [60], [30]]


def test_registered_query_by_brute_force(spark):
    given = dict(duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall())
    rows = QUERIES["op13_periodic_runs"](spark, SF).collect()
    assert len(rows) == len(given) and sum(r.n_runs > 0 for r in rows) > 5
    for r in rows:
        assert tuple(r[c] for c in COLUMNS) == expected(r.doc_id, given[r.doc_id])


def test_odd_rows(spark):
    tail = " ".join(["a b c"] * 9)
    rows = [(1, None, 7), (1, "", 7), (None, tail, 7), (2, tail, 7), (2, tail, 7), (3, " \n", 7), (4, "é é " * 20, 7)]
    docs = spark.createDataFrame([(*r, 5, "s") for r in rows], "doc_id int, text string, n_runs int, start int, of string")
    hashed = F.crc32(docs["doc_id"].cast("string").cast("binary"))
    for rewrite in (hashed, None):
        got = periodic.periodic_runs(docs, rewrite).collect()
        want = [(i, *expected(i, t, rewrite is not None)) for i, t, _ in rows]
        assert sorted(map(repr, want)) == sorted(repr((r.doc_id, *(r[c] for c in COLUMNS))) for r in got)
    empty = periodic.periodic_runs(docs.limit(0), hashed)
    assert empty.collect() == [] and empty.columns[:3] == ["doc_id", "n_runs", "start"]
