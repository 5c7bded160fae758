"""The prefix trie against plain dictionaries of all beginnings."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from paperbrook.llm import prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id bigint, turn int, role string, text string"


def order_of(row):
    whole = f"{len((row[2] or '').encode())}:{row[2] or ''}{row[3] or ''}".encode()
    return row[1] is not None, row[1] or 0, hashlib.sha256(whole).digest()[:16]


def expected(rows, heads, family=20):
    own = defaultdict(list)
    for row in sorted((r for r in rows if r[0] is not None), key=order_of):
        own[row[0]].append((row[2] or "", row[3] or ""))
    whole = {}
    for c, turns in own.items():
        h = heads(c)
        whole[c] = tuple(own.get(c - c % family, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(set)
    for node in members:
        if node:
            children[node[:-1]].add(node)

    def below(node):
        kids = [below(k) for k in children[node]]
        saved = (len(members[node]) - 1) * (len(node[-1][1].encode().split()) if node else 0)
        return sum(k[0] for k in kids) or 1, saved + sum(k[1] for k in kids)

    found = []
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(whole[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        found.append((min(convs), len(node), parent, len(convs), len(children[node]), *below(node), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=repr)


def got(found):
    assert found.columns == COLUMNS
    return sorted(map(tuple, found.collect()), key=repr)


def random_rows(rng, convs, turns):
    rows = []
    for c in rng.sample(range(60), convs):
        for turn in range(rng.choice([0, 1, turns, rng.randint(0, turns)])):
            rows.append((c, turn, rng.choice("ab"), rng.choice(["x", "x", "y  z", "", "é w v"])))
    return rows


@pytest.mark.parametrize(("seed", "batches", "growth"), [(1, 1, 8), (2, 2, 2), (3, 4, 2), (4, 3, 3)])
def test_trie_by_dictionaries(spark, seed, batches, growth):
    rng = random.Random(seed)
    rows = random_rows(rng, 40, 9)
    given = spark.createDataFrame(rows, SCHEMA)
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    found = prefix_trie.prefix_trie(given, heads, batches=batches, growth=growth)
    assert got(found) == expected(rows, lambda c: zlib.crc32(str(c).encode()) % 4)


def test_one_long_conversation_and_its_beginnings(spark):
    whole = [(0, t, "u", f"t{t % 3} w") for t in range(70)]
    rows = whole + [(c, t, r, x) for c in (1, 2, 3) for _, t, r, x in whole[: 20 * c + 3]] + [(9, 0, "u", "other")]
    found = prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), batches=3, growth=2)
    assert got(found) == expected(rows, lambda c: 0)


def test_odd_rows(spark):
    rows = [
        (5, None, None, None), (5, 1, "u", None), (5, 1, "u", None), (6, None, "", ""), (6, 1, "u", ""), (None, 1, "u", "lost"),
        (-3, 2, "u", "a b"), (41, 0, "u", "only"), (2**40, 0, "u", "only"),
    ]
    given = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", depth int, path string")
    for h in (0, 2):
        assert got(prefix_trie.prefix_trie(given, F.lit(h))) == expected(rows, lambda c, h=h: h)
    assert got(prefix_trie.prefix_trie(given.limit(0))) == []
    # conversations without any turn: all end at the root
    rows = [(1, 0, "u", "x"), (2, 0, "u", "y")]
    assert got(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), F.lit(1))) == expected(rows, lambda c: 1)


def test_many_copies_of_one_conversation(spark):
    rows = [(c, t, "u", "same words") for c in range(5000) for t in range(2)]
    found = got(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)))
    assert found == expected(rows, lambda c: 0)


def test_fattest_numbers(spark):
    rows = [(a, b) for a in range(40) for b in range(a + 1, 41)]
    got = spark.createDataFrame(rows, "a int, b int").select("a", "b", F.expr(prefix_trie.fattest("a", "b")).alias("f")).collect()
    assert all(r.f == max(range(r.a + 1, r.b + 1), key=lambda x: x & -x) for r in got)


def test_search_meets_the_deepest_node_that_is_passed(spark):
    rng = random.Random(6)
    rows = random_rows(rng, 50, 12)
    paths = prefix_trie.path_table(prefix_trie.rebuilt(prefix_trie.turn_table(spark.createDataFrame(rows, SCHEMA)), F.lit(0), 20))
    seqs = {tuple(s.h for s in r.path): r.path for r in paths.collect() if r.len}
    table = spark.createDataFrame([(bytes(k[-1]), len(k), v) for k, v in seqs.items()], f"seq binary, len int, path array<{prefix_trie.STEP}>")
    half = F.pmod(F.xxhash64("seq"), F.lit(2)) == 0
    trie = prefix_trie.build(table.where(half), 1)
    nodes = {bytes(r.node): r.ext for r in trie.collect()}
    asked = table.where(~half)
    found = {bytes(r.seq): r.a for r in prefix_trie.locate(trie, asked, 12).collect()}
    assert len(found) > 5
    for k in seqs:
        if bytes(k[-1]) in found:
            assert found[bytes(k[-1])] == max([0, *(d + 1 for d, h in enumerate(k) if bytes(h) in nodes)])
