"""The pipeline stage by stage, each against plain Python on what its predecessor kept."""

import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import pytest
import xxhash

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline as pipeline  # noqa: E402

from paperbrook.llm import decontaminate, mixing, packing, simhash  # noqa: E402
from paperbrook.llm.common import written  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def outputs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for name, stage in pipeline.STAGES:
        found.append(written(stage(spark, found[-1], SF), f"test-{name[:4]}"))
    return found


def rows(frame):
    return {r.doc_id: r for r in frame.collect()}


def word_of(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_columns(outputs):
    assert all(o.columns == outputs[0].columns for o in outputs[1:5])


def test_toxic_documents_go_and_others_stay(outputs):
    labels = dict(duckdb.sql(f"select doc_id, toxic from '{SF}/labels.parquet'").fetchall())
    given, kept = rows(outputs[0]), rows(outputs[1])
    toxic, clean = ([i for i in given if labels.get(i) == y] for y in (1, 0))
    assert sum(i in kept for i in clean) >= 0.99 * len(clean)
    assert sum(i not in kept for i in toxic) >= 0.6 * len(toxic)  # some fifty texts to learn from


def test_one_document_of_each_group_stays(outputs):
    given, kept = rows(outputs[1]), rows(outputs[2])
    words = {i: word_of(r.text) for i, r in given.items()}
    root = {i: i for i in given}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(given)
    for at, i in enumerate(ids):
        for j in ids[:at]:
            if (words[i] ^ words[j]).bit_count() <= 4:
                low, high = sorted((find(i), find(j)))
                root[high] = low
    assert set(kept) == {i for i in ids if find(i) == i} and len(kept) < len(given)


def test_contaminated_documents_go(outputs):
    split = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    windows = set()
    for (text,) in duckdb.sql(f"select text from '{SF}/benchmark.parquet'").fetchall():
        words = re.findall(split, text.translate(str.maketrans(pipeline_upper(), pipeline_upper().lower())))
        windows |= {tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9))}
    assert {len(w) for w in windows} == {10}
    given, kept = rows(outputs[2]), rows(outputs[3])
    for i, r in given.items():
        words = re.findall(split, r.text.translate(str.maketrans(pipeline_upper(), pipeline_upper().lower())))
        dirty = any(tuple(words[at : at + 10]) in windows for at in range(len(words) - 9))
        assert (i not in kept) == dirty


def pipeline_upper():
    return "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def test_sources_come_near_their_targets(outputs):
    copies = Counter(r.doc_id for r in outputs[4].collect())
    decided = mixing.mix(outputs[3]).collect()
    assert copies == Counter({r.doc_id: r.copies for r in decided if r.copies})
    assert max(copies.values()) <= 3


def test_every_copy_is_tokenised_without_loss(outputs):
    given = Counter((r.doc_id, r.text) for r in outputs[4].collect())
    coder, shards, found = packing.Tokenizer(packing.VOCABULARY), {}, Counter()
    pieces = outputs[5].orderBy("shard", "doc_id", "piece").collect()
    assert all(r.intact for r in pieces)
    held = defaultdict(list)
    for r in pieces:
        shard = shards.setdefault(r.shard, packing.read_shard(r.shard))
        held[r.doc_id, r.piece].append(shard["ids"][r.row, r.start : r.start + r.length].tolist())
        found[r.doc_id] += r.piece == 0
    for (doc_id, text), times in given.items():
        whole = [i for at in range(len(held)) if (doc_id, at) in held for i in held[doc_id, at][0]]
        assert coder.decode(whole) == text and found[doc_id] == times


def test_rows_that_share_an_id_or_have_none_are_decided_each(spark):
    def text(name):
        return " ".join(f"{name}{at}" for at in range(60))

    rows = [(None, text("a"), "s"), (None, text("a"), "t"), (None, text("b"), "s"), (None, "x " + text("c"), "s"),
            (1, text("a"), "s"), (1, text("d"), "s"), (1, text("d"), "s"), (2, text("e"), "s"), (None, text("f"), "s"),
            (None, text("f"), "t"), (3, None, "s")]
    given = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    clean = decontaminate.drop_contaminated(given, spark.createDataFrame([(1, text("c")), (2, text("d"))], "item_id int, text string"))
    want = [r for r in rows if r[1] not in ("x " + text("c"), text("d"))]
    assert sorted(map(tuple, clean.collect()), key=repr) == sorted(want, key=repr)
    want = [rows[at] for at in (2, 3, 4, 5, 7, 8, 10)]
    assert sorted(map(tuple, simhash.keep_firsts(given).collect()), key=repr) == sorted(want, key=repr)


def test_every_row_is_mixed_by_its_own_copies(spark):
    rows = [(None if n % 3 == 0 else n % 7, " ".join(["w"] * (1 + n % 11)), f"s{n % 4}", n) for n in range(900)]
    given = spark.createDataFrame(rows, "doc_id bigint, text string, source string, copies int")
    taken = Counter()
    for r in mixing.mixed(given).collect():
        taken[r.source] += len(r.text.split())
    sizes = Counter()
    for _, text, source, _ in rows:
        sizes[source] += len(text.split())
    for r in mixing.mix(given).select("source", "source_size", "target").distinct().collect():
        assert r.source_size == sizes[r.source] and abs(taken[r.source] - r.target) <= 11


def test_decisions_by_merge_equal_those_sent_to_every_task(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    few = sorted(r.doc_id for r in simhash.keep_firsts(docs).collect())
    monkeypatch.setattr("paperbrook.llm.common.BROADCAST_BYTES", 0)
    assert sorted(r.doc_id for r in simhash.keep_firsts(docs).collect()) == few
