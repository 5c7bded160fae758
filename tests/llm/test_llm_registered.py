"""The registered queries of this subpackage against their SQL, or against plain Python, on the small tables."""

import re
import sys
from collections import defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
import xxhash

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))

from check_oracles import TABLES, normal, repr_value  # noqa: E402

from paperbrook.llm import packing  # noqa: E402
from paperbrook.llm.oracles import ORACLES  # noqa: E402
from paperbrook.llm.queries import QUERIES  # noqa: E402

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return connection


def texts(sf_dir):
    return dict(duckdb.sql(f"select doc_id, coalesce(text, '') from '{sf_dir}/documents.parquet'").fetchall())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, db, name):
    got, want = normal(QUERIES[name](spark, SF).toPandas()), normal(db.execute(ORACLES[name]).df())
    assert list(got.columns) == list(want.columns) and len(got) == len(want)
    assert got.map(repr_value).equals(want.map(repr_value))


def roots(ids, linked):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


def test_simhash_by_all_pairs(spark):
    prints = {}
    for doc_id, text in texts(LARGER).items():
        words = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
        grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        prints[doc_id] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    ids = sorted(prints)
    linked = [(a, b) for at, a in enumerate(ids) for b in ids[:at] if (prints[a] ^ prints[b]).bit_count() <= 4]
    want = roots(ids, linked)
    got = QUERIES["op3_simhash"](spark, LARGER).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{prints[i]:016x}", want[i]) for i in ids}


def holders_of_runs(given, length):
    """Documents that hold a run of words another document has too."""
    held = defaultdict(set)
    for doc_id, text in given.items():
        words = text.encode().lower().split()
        for at in range(len(words) - length + 1):
            held[hash(tuple(words[at : at + length]))].add(doc_id)
    return set().union(*(ids for ids in held.values() if len(ids) > 1))


def test_passages_are_found_and_agree(spark):
    given = texts(LARGER)
    found = QUERIES["op2_substring_dedup"](spark, LARGER).collect()
    named = {r.doc_id for r in found} | {r.other_id for r in found}
    assert holders_of_runs(given, 50) <= named
    assert not {i for r in found if r.kind == "passage" for i in (r.doc_id, r.other_id)} - holders_of_runs(given, 12)
    words = {i: t.encode().lower().split() for i, t in given.items()}
    for r in found:
        a, b = words[r.doc_id][r.start : r.end], words[r.other_id][r.other_start : r.other_end]
        assert len(a) == r.end - r.start and len(b) == r.other_end - r.other_start
        assert a == b if r.kind == "copy" else min(len(a), len(b)) >= 50 and r.matched >= 0.8 * max(len(a), len(b))
        assert len(set(a) & set(b)) * 2 > len(set(a))


@pytest.mark.parametrize(("sf_dir", "least"), [(LARGER, 0.9), ("/root/testdata/sf0.1", 0.95)])
def test_recall_of_the_permutation_index(spark, sf_dir, least):
    rows = duckdb.sql(f"select vec_id, embedding from '{sf_dir}/embeddings.parquet' order by vec_id").fetchall()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=float)
    got = defaultdict(list)
    for r in sorted(QUERIES["op5_nearest_vectors"](spark, sf_dir).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == {i for i in ids.tolist() if i % 20 == 0}
    hits = 0
    for query, answers in got.items():
        scores = vectors @ vectors[ids == query][0]
        scores[ids == query] = -np.inf
        hits += len({i for i, _ in answers} & set(ids[np.lexsort((ids, -scores))[:20]].tolist()))
        assert len(answers) == 20 and answers == sorted(answers, key=lambda a: (-a[1], a[0]))
        assert all(abs(score - scores[ids == i][0]) < 1e-12 for i, score in answers)
    assert hits >= least * 20 * len(got)


@pytest.mark.parametrize(("name", "label", "threshold", "modulus", "held"), [
    ("op4_toxicity", "toxic", 0.5, 5, 0), ("op10_quality", "quality", 0.7, 4, 2),
])
def test_held_out_labels(spark, name, label, threshold, modulus, held):
    import zlib

    sf_dir = "/root/testdata/sf0.1"
    labels = dict(duckdb.sql(f"select doc_id, {label} from '{sf_dir}/labels.parquet'").fetchall())
    rows = QUERIES[name](spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == set(texts(sf_dir))
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= threshold)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == held)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(p == y for p, y in judged) >= 0.97 * len(judged)
    ones = [p for p, y in judged if y == 1]
    assert sum(ones) >= 0.9 * len(ones)


def test_mixing_by_hand(spark):
    rows = duckdb.sql(f"select doc_id, coalesce(text, ''), source from '{LARGER}/documents.parquet'").fetchall()
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t, _ in rows}
    of = {i: s for i, _, s in rows}
    total = defaultdict(int)
    for i, source in of.items():
        total[source] += size[i]
    weight = {s: (5, 2, 1)[at % 3] for at, s in enumerate(sorted(total))}
    target, budget, open_sources = {}, sum(total.values()), set(total)
    while True:
        share = budget / sum(weight[s] for s in open_sources)
        full = {s for s in open_sources if share * weight[s] > 3 * total[s]}
        if not full:
            break
        target |= {s: 3.0 * total[s] for s in full}
        budget -= sum(target[s] for s in full)
        open_sources -= full
    target |= {s: share * weight[s] for s in open_sources}
    got = QUERIES["op7_mixing"](spark, LARGER).collect()
    again = QUERIES["op7_mixing"](spark, LARGER).collect()
    assert sorted(got) == sorted(again) and {r.doc_id: r.size for r in got} == size
    taken = defaultdict(int)
    for r in got:
        assert r.source_size == total[of[r.doc_id]] and abs(r.target - target[of[r.doc_id]]) < 1e-6
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[of[r.doc_id]] += r.taken
    for source in total:
        assert abs(taken[source] - target[source]) <= max(size[i] for i in size if of[i] == source) / 2 + 1e-6


def test_tokens_round_trip(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    placed = packing.write_packed(docs, str(tmp_path / "tokens"), row_tokens=256)
    assert packing.verify(placed).where("not intact").count() == 0
    coder, shards, pieces = packing.Tokenizer(packing.VOCABULARY), {}, defaultdict(dict)
    for r in placed.collect():
        shard = shards.setdefault(r.shard, packing.read_shard(r.shard))
        pieces[r.doc_id][r.piece] = shard["ids"][r.row, r.start : r.start + r.length].tolist()
        assert packing.positions(shard)[r.row, r.start] == 0 and r.length <= 256
    for doc_id, text in texts(SF).items():
        ids = [i for _, piece in sorted(pieces[doc_id].items()) for i in piece]
        assert ids[-1] == coder.end and coder.decode(ids) == text
    for shard in shards.values():
        ends = shard["cu_seqlens"]
        assert ends[-1] == shard["ids"].size and (np.diff(ends) > 0).all() and (np.diff(ends) <= 256).all()
        assert (shard["ids"].shape[1] * np.arange(len(shard["ids"]) + 1) == ends[shard["rows"]]).all()
