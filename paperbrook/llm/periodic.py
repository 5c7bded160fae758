"""Periodic runs of words within documents, by seeds on diagonals that are extended once."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Least words of a run; it holds its period twice as well.
LEAST_WORDS = 12
# A run of period q matches itself q words on over max(LEAST_WORDS, 2q) - q words, at least six whatever q is.
SEED_WORDS = LEAST_WORDS // 2
# Words of texts that are searched together, and pairs extended together.
GROUP_WORDS, PAIRS, STEP = 200_000, 1 << 16, 32
RESULT = (
    "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string, n_words bigint, n_kept bigint"
)


class Runs(NamedTuple):
    """Word numbers, lengths and periods of runs, by start, then period."""

    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


class Grams(NamedTuple):
    """Places, in order, of the grams that stand at least twice in their document, and equal numbers for equal ones."""

    place: np.ndarray
    number: np.ndarray


def repeated(place: np.ndarray, key: np.ndarray) -> Grams:
    """The places whose key stands at another place too."""
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = np.append(False, ranked[1:] == ranked[:-1])[: len(key)]
    again = same | np.append(same[1:], False)[: len(key)]
    number = np.zeros(len(key), np.int64)
    number[order] = np.cumsum(~same) - 1
    chosen = np.zeros(len(key), bool)
    chosen[order] = again
    return Grams(place[chosen], number[chosen])


def first_grams(ids: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> Grams:
    """The grams of ``SEED_WORDS`` words. Hashes sort out most places; what they leave is numbered by its words."""
    place = np.arange(max(len(ids) - SEED_WORDS + 1, 0))
    place = place[place + SEED_WORDS <= ends[place]]
    mixed = begins.astype(np.uint64)[place]
    for at in range(SEED_WORDS):
        mixed = (mixed ^ ids[place + at].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    place = repeated(place, mixed).place
    words = np.concatenate([begins[place][None], *(ids[place + at][None] for at in range(SEED_WORDS))])
    return repeated(place, np.unique(words, axis=1, return_inverse=True)[1].reshape(-1))


def widened(grams: Grams, size: int) -> Grams:
    """The grams of twice the size, which begin with one of these and end with another."""
    at = np.minimum(np.searchsorted(grams.place, grams.place + size), max(len(grams.place) - 1, 0))
    whole = np.flatnonzero(grams.place[at] == grams.place + size)
    return repeated(grams.place[whole], grams.number[whole] * (int(grams.number.max(initial=0)) + 1) + grams.number[at[whole]])


def matching(ids: np.ndarray, at: np.ndarray, lag: np.ndarray, low: np.ndarray, high: np.ndarray, step: int) -> np.ndarray:
    """How many words in a row equal those ``lag`` on, from ``at`` in steps of 1 or -1, within ``low`` to ``high``."""
    count = np.zeros(len(at), np.int64)
    open_ = np.arange(len(at))
    ahead = np.arange(STEP) * step
    while len(open_):
        here = (at[open_] + count[open_] * step)[:, None] + ahead
        there = here + lag[open_][:, None]
        inside = (here >= low[open_][:, None]) & (there < high[open_][:, None])
        same = inside & (ids[np.where(inside, here, 0)] == ids[np.where(inside, there, 0)])
        run = np.where(same.all(1), STEP, same.argmin(1))
        count[open_] += run
        open_ = open_[run == STEP]
    return count


class Covered:
    """For each lag the stretches whose words are known to equal those a lag on; they never overlap."""

    def __init__(self, size: int):
        self.size = size
        self.start, self.end = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, lag: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        """Stretches from ``start`` to ``end``, exclusive."""
        key = np.append(self.start, lag * self.size + start)
        order = np.argsort(key, kind="stable")
        self.start, self.end = key[order], np.append(self.end, lag * self.size + end)[order]

    def holds(self, lag: np.ndarray, start: np.ndarray, words: int) -> np.ndarray:
        """Whether the ``words`` from ``start`` on lie in a stretch of their lag."""
        key = lag * self.size + start
        at = np.searchsorted(self.start, key, "right") - 1
        return (at >= 0) & (key + words <= self.end[at]) if len(self.end) else np.zeros(len(key), bool)


def seed_pairs(
    grams: Grams, step: int, lags: tuple[int, int], begins: np.ndarray, ends: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, lags): grams at every ``step``-th place that stand again within the range of lags of one document.

    Lags beyond half a document belong to no run of it. Places come in order. A range of lags of twice the grams' size holds at most about twice as many places as one step
    has, so pairs grow with the words and not with their square.
    """
    order = np.argsort(grams.number, kind="stable")
    stride = int(ends[-1]) + 1
    key = grams.number[order] * stride + grams.place[order]
    chosen = np.flatnonzero(grams.place % step == 0)
    places, own = grams.place[chosen], grams.number[chosen] * stride
    low = np.searchsorted(key, own + places + lags[0])
    widest = np.minimum((ends[places] - begins[places]) // 2, lags[1])
    high = np.searchsorted(key, own + np.minimum(places + widest, ends[places]), "right")
    counts = np.maximum(high - low, 0)
    places, low, counts = places[counts > 0], low[counts > 0], counts[counts > 0]
    sums, at = np.cumsum(counts), 0
    while at < len(places):
        end = max(at + 1, int(np.searchsorted(sums, (sums[at - 1] if at else 0) + PAIRS)))
        n = counts[at:end]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        first = np.repeat(places[at:end], n)
        yield first, key[np.repeat(low[at:end], n) + inner] % stride - first
        at = end


def runs_of(ids: np.ndarray, bounds: np.ndarray) -> Runs:
    """All runs of the documents whose words, as numbers, stand from ``bounds[i]`` to ``bounds[i + 1]``.

    A run is a stretch of at least ``LEAST_WORDS`` words and twice its smallest period that no neighbour extends.
    Words q apart agree over ``max(LEAST_WORDS, 2q) - q`` words of it at least. Lags up to 11 are seeded by all
    grams of six words; beyond, lags from 2k to 4k - 1 by grams of k words at every (k+1)-th place, for a stretch of
    2k words holds one of these whole. Each pair of equal grams is a point of the diagonal of its lag. Points in a
    stretch that is covered already are left out; of points that follow each other on a diagonal without a break
    only the outer ends are extended. A run covers its stretch for all multiples of its period at once, since on those
    diagonals the stretch is the same and no smaller period can come of it.
    """
    total = len(ids)
    ends = np.repeat(bounds[1:], np.diff(bounds))
    begins = np.repeat(bounds[:-1], np.diff(bounds))
    covered = Covered(total + 1)
    found: dict[tuple[int, int], int] = {}
    longest = int(np.diff(bounds).max(initial=0))
    size, step, lags = SEED_WORDS, 1, (1, LEAST_WORDS - 1)
    grams = first_grams(ids, begins, ends)
    while lags[0] * 2 <= longest and len(grams.place):
        fresh: list[tuple[int, int, int]] = []
        for place, lag in seed_pairs(grams, step, lags, begins, ends):
            keep = ~covered.holds(lag, place, size)
            order = np.lexsort((place[keep], lag[keep]))
            place, lag = place[keep][order], lag[keep][order]
            if not len(place):
                continue
            # One chain of points of a diagonal: neighbours a step apart whose words in between agree too.
            joined = np.zeros(len(place), bool)
            joined[1:] = (lag[1:] == lag[:-1]) & (place[1:] - place[:-1] == step)
            joined[1:] &= (ids[place[1:] - 1] == ids[place[1:] - 1 + lag[1:]]) & (begins[place[1:]] == begins[place[:-1]])
            head, tail = np.flatnonzero(~joined), np.flatnonzero(~np.append(joined[1:], False))
            q, low, high = lag[head], begins[place[head]], ends[place[head]]
            start = place[head] - matching(ids, place[head] - 1, q, low, high, -1)
            end = place[tail] + size
            end += matching(ids, end, q, low, high, 1)
            known, first = np.unique(np.stack([q, start, end]), axis=1, return_index=True)
            q, start, end = known
            new = ~covered.holds(q, start, 1)
            covered.add(q[new], start[new], end[new])
            held = new & (end - start >= np.maximum(LEAST_WORDS - q, q))
            fresh += zip(q[held].tolist(), start[held].tolist(), (end + q)[held].tolist(), strict=True)
        for q, start, end in sorted(fresh):
            if (start, end) in found:  # a smaller period has this stretch
                continue
            found[start, end] = q
            more = np.arange(2 * q, (end - start) // 2 + 1, q)
            more = more[more >= 2 * size]  # smaller lags are done
            covered.add(more, np.full(len(more), start), end - more)
        if size > SEED_WORDS or step > 1:
            grams, size = widened(grams, size), 2 * size
        step, lags = size + 1, (2 * size, 4 * size - 1)
    rows = sorted((start, q, end) for (start, end), q in found.items())
    columns = np.array(rows, np.int64).reshape(-1, 3).T
    return Runs(columns[0], columns[2] - columns[0], columns[1])


def repeating_tail(words: list[bytes], h: int | None) -> list[bytes]:
    """Of one id in ten, by the hash ``h``, the words with a tail that repeats its beginning."""
    n = len(words)
    if h is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def described(words: list[bytes], runs: Runs) -> tuple:
    """The result columns from ``n_runs`` on, of one document and its runs."""
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in zip(*(c.tolist() for c in runs), strict=True))
    best: tuple = (None,) * 4
    kept = words
    if len(runs.start):
        at = np.lexsort((runs.period, runs.start, -runs.length))[0]
        start, length, period = (int(c[at]) for c in runs)
        best = (start, length, period, 1000 * length // period)
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, runs.start + runs.period, 1)
        np.add.at(change, runs.start + runs.length, -1)
        kept = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
    digests = hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest()
    return len(runs.start), *best, *digests, len(words), len(kept)


def runs_in(texts: list[list[bytes]]) -> Iterator[Runs]:
    """The runs of each of the word lists, which are searched together."""
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for words in texts for w in words], np.int64)
    bounds = np.append(0, np.cumsum([len(words) for words in texts], dtype=np.int64))
    found = runs_of(ids, bounds)
    cuts = np.searchsorted(found.start, bounds)
    for at, (low, high) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        part = slice(low, high)
        yield Runs(found.start[part] - bounds[at], found.length[part], found.period[part])


def periodic_runs(docs: DataFrame, rewrite: Column | None = None) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): its runs of words that repeat with a period.

    n_runs; start, length, period and exponent_milli of the longest run (ties: smallest start, then period; null where
    there is none); runs_sha256 of all runs; collapsed_sha256 of the words without the repetitions (of each run only
    its first period stays); n_words; n_kept. ``rewrite``, a column of numbers, gives the words of every tenth hash
    a repeating tail before the search; null leaves the words alone.

    Words are stretches without ASCII white space, and case counts. Null and empty texts have no words, no runs and the
    digest of nothing. Repeated rows and rows without an id give a row each. Other columns are not read. Texts never
    move; each is searched whole, in the task that reads it, and must fit there.
    """
    h = F.lit(None).cast("bigint") if rewrite is None else rewrite.cast("bigint")
    names = [c.split()[0] for c in RESULT.split(", ")]
    kinds = [pa.string() if n.endswith("sha256") else pa.int64() for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, list[bytes]]] = []

        def close() -> pa.RecordBatch:
            rows = [(i, *described(w, runs)) for (i, w), runs in zip(held, runs_in([w for _, w in held]), strict=True)]
            held.clear()
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        words_held = 0
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for doc_id, of, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, strict=True):
                words = repeating_tail((text.as_py() or b"").split(), of)
                held.append((doc_id, words))
                words_held += len(words)
                if words_held >= GROUP_WORDS or len(held) >= 10_000:
                    yield close()
                    words_held = 0
        if held:
            yield close()

    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), h.alias("of"), "text")
    return given.mapInArrow(run, RESULT)
