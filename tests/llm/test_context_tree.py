"""Context-tree weighting against a plain recursion over dictionaries."""

import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from paperbrook.llm import context_tree
from paperbrook.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def lg(x):
    return math.lgamma(x)


def kt(a, b):
    return lg(a + 0.5) + lg(b + 0.5) - lg(a + b + 1) - math.log(math.pi)


class PlainTree:
    """Counts by (bits before, context); weights and chances by recursion on the context."""

    def __init__(self, texts, depth):
        self.depth, self.counts, self.memo = depth, Counter(), {}
        self.longer = {}
        for text in texts:
            for bits, context, bit in self.steps(text):
                for d in range(depth + 1):
                    self.counts[bits, context[:d], bit] += 1
                    if d:
                        self.longer.setdefault((bits, context[: d - 1]), set()).add(context[:d])

    def steps(self, text):
        whole = [0xFF] * self.depth + list(text) + [0xFF]
        for at in range(self.depth, len(whole)):
            context = tuple(whole[at - 1 - back] for back in range(self.depth))
            byte = f"{whole[at]:08b}"
            for j in range(8):
                yield byte[:j], context, byte[j]

    def pair(self, bits, context):
        return self.counts[bits, context, "0"], self.counts[bits, context, "1"]

    def weighted(self, bits, context):
        if (bits, context) not in self.memo:
            own = kt(*self.pair(bits, context))
            if len(context) < self.depth:
                product = sum(self.weighted(bits, c) for c in self.longer.get((bits, context), ()))
                own = np.logaddexp(math.log(0.5) + own, math.log(0.5) + product)
            self.memo[bits, context] = own
        return self.memo[bits, context]

    def chance(self, bits, context, bit, d=0):
        a, b = self.pair(bits, context[:d])
        own = ((a, b)[int(bit)] + 0.5) / (a + b + 1)
        if d == self.depth:
            return own
        share = math.exp(math.log(0.5) + kt(a, b) - self.weighted(bits, context[:d]))
        return share * own + (1 - share) * self.chance(bits, context, bit, d + 1)

    def score(self, text):
        return sum(math.log10(self.chance(*step)) for step in self.steps(text))


def words_of(text):
    return [*text.lower().split(), None]


def base_scores(texts, learnt):
    counts = Counter(w for t in learnt for w in words_of(t))
    total, kinds = sum(counts.values()), len(counts)
    for text in texts:
        words = words_of(text)
        yield len(words), sum(counts[w] > 0 for w in words), total, sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in words)


@pytest.mark.parametrize(("depth", "block_bytes"), [(2, 1 << 20), (3, 40), (5, 200)])
def test_scores_by_recursion(spark, depth, block_bytes):
    rng = random.Random(depth)
    syllables = ["an", "the ", "on\n", "é", "Ti", " ", "x", "ß "]
    texts = ["".join(rng.choices(syllables, k=rng.randint(0, 40))) for _ in range(24)] + ["", "never\x7f seen 中"]
    rows = [(i, t, i % 3 > 0) for i, t in enumerate(texts)] + [(None, None, True), (3, texts[3], True), (5, texts[5], None)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id int, text string, learn boolean, score int").repartition(3)
    raw = [(t or "").encode() for _, t, _ in rows]
    learnt = [b for b, (_, _, l) in zip(raw, rows, strict=True) if l]
    tree = PlainTree(learnt, depth)
    want = Counter()
    for (i, _, _), b, base in zip(rows, raw, base_scores(raw, learnt), strict=True):
        want[(i, *base[:3], round(base[3], 7), round(tree.score(b), 7))] += 1
    got = Counter()
    for r in context_tree.scores(docs, docs["learn"], depth, block_bytes).collect():
        got[(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 7), round(r.score, 7))] += 1
        assert abs(r.bits_per_byte + r.score * math.log2(10) / (r.n_bytes + 1)) < 1e-9
    assert got == want


def test_nothing_to_learn_from_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "ab c"), (2, None)], "doc_id int, text string")
    rows = {r.doc_id: r for r in context_tree.scores(docs, docs["doc_id"] > 5).collect()}
    assert rows[1].n_tokens == 3 and rows[1].n_known == rows[1].train_tokens == 0 and rows[1].base_score == 0
    assert abs(rows[1].score - 40 * math.log10(0.5)) < 1e-9 and abs(rows[2].bits_per_byte - 8) < 1e-9
    assert context_tree.scores(docs.limit(0), docs["doc_id"] > 5).collect() == []


def test_chances_of_all_bytes_sum_to_one():
    rng = random.Random(4)
    texts = ["".join(rng.choices("ab c", k=50)).encode() for _ in range(5)]
    grams = np.unique(context_tree.gram_array(texts, 3)[0])
    context = int(grams[7]) >> 8 << 8
    asked = np.unique(np.append(grams, context + np.arange(256)))
    counts = np.isin(asked, grams).astype(np.int64)
    levels, node = context_tree.levels_of(asked, counts, 3, 0)
    chances = np.exp(context_tree.log_chance(node, asked & 0xFF, context_tree.ones_below(levels)))
    assert abs(chances[(asked >> 8 << 8) == context].sum() - 1) < 1e-9


def test_gram_table_finds_what_it_holds():
    rng = np.random.default_rng(3)
    grams = np.unique(rng.integers(0, 1 << 48, 5000))
    table = context_tree.GramTable(grams, grams * 0.5)
    asked = rng.choice(grams, 20_000)
    assert (table.find(asked) == asked * 0.5).all()


def test_log_gamma():
    x = np.concatenate([np.arange(1, 200) / 2, [1e4, 1e9]])
    assert np.allclose(context_tree.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-12, atol=1e-11)


def test_registered_query(spark):
    given = {i: (t or "").encode() for i, t in duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in given}
    learnt = [t for i, t in given.items() if not held[i]]
    want = dict(zip(given, base_scores(given.values(), learnt), strict=True))
    rows = QUERIES["op12_context_tree"](spark, SF).collect()
    assert len(rows) == len(given)
    for r in rows:
        assert r.held_out == held[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:3]
        assert abs(r.base_score - want[r.doc_id][3]) < 1e-6
    size = sum(len(given[r.doc_id]) + 1 for r in rows if r.held_out)
    bits = -sum(r.score for r in rows if r.held_out) * math.log2(10) / size
    assert bits < 2.5  # counts of single bytes give 4.2
