"""Text quality by logistic regression on hashed word n-grams, trained with follow-the-regularised-leader."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperbrook.llm.common import written
from paperbrook.llm.training import SAMPLE_ROWS, id_remainder, labelled_sample

MODULUS, HELD, THRESHOLD = 4, 2, 0.7
BITS, EPOCHS, SHARDS = 18, 4, 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.01
MEMO_WORDS = 200_000
RUNS = [(re.compile(p), c) for p, c in ((r"[^\W\d_a-zà-öø-ÿ]+", "A"), (r"[^\W\d_A]+", "a"), (r"\d+", "0"))]


def word_shape(word: str) -> str:
    """A word with each run of capitals, other letters and digits as one sign, other characters as they are."""
    for pattern, sign in RUNS:
        word = pattern.sub(sign, word)
    return word[:16]


class WordHashes(dict):
    """Two 32-bit hashes of a word packed in one number: its lower-cased form and its shape."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = zlib.crc32(word.lower().encode()) << 32 | zlib.crc32(word_shape(word).encode(), 1)
        self[word] = value
        return value


def spread(values: np.ndarray, kind: int) -> np.ndarray:
    mixed = (values + np.uint64(kind)) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - BITS)).astype(np.int64)


def slots(text: str | None, memo: WordHashes) -> list[np.ndarray]:
    """Hash slots of the n-grams of a text: words, word pairs, shapes, shape pairs, and repeats of the word before."""
    words = (text or "").split()
    packed = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    form, shape = packed >> np.uint64(32), packed & np.uint64(0xFFFFFFFF)
    found = [spread(form, 1), spread(shape, 2)]
    if len(words) > 1:
        found.append(spread(form[:-1] * np.uint64(31) + form[1:] * np.uint64(0x100000001), 3))
        found.append(spread(shape[:-1] * np.uint64(31) + shape[1:] * np.uint64(0x100000001), 4))
        found.append(spread((form[:-1] == form[1:]).astype(np.uint64), 5))
    return found


def dot(text: str | None, weights: np.ndarray, memo: WordHashes) -> float:
    """The mean weight of each kind of n-gram, summed: a sparse dot product whose size does not grow with the text."""
    return float(sum(weights[part].mean() for part in slots(text, memo) if len(part)))


def sparse(text: str | None, memo: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots and their values: shares within their kind of n-gram."""
    parts = [p for p in slots(text, memo) if len(p)]
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0)
    values = np.concatenate([np.full(len(p), 1 / len(p)) for p in parts])
    index, at = np.unique(np.concatenate(parts), return_inverse=True)
    return index, np.bincount(at, weights=values)


def train_shard(rows: list[tuple[str, int]], epochs: int = EPOCHS) -> np.ndarray:
    """Weights (the last is the bias) after FTRL-proximal updates over the rows, one at a time."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    memo = WordHashes()
    given = []
    for text, label in rows:
        index, values = sparse(text, memo)
        given.append((np.append(index, 1 << BITS), np.append(values, 1.0), label))

    def weights(at) -> np.ndarray:
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(epochs):
        for index, values, label in given:
            w = weights(index)
            p = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35)))
            g = (p - label) * values
            sigma = (np.sqrt(n[index] + g * g) - np.sqrt(n[index])) / ALPHA
            z[index] += g - sigma * w
            n[index] += g * g
    return weights(slice(None))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> np.ndarray | None:
    """Weights averaged over ``SHARDS`` models, each trained on its share of at most ``rows`` labelled texts.

    The result has a fixed size. Without labelled texts there is no model.
    """
    sample = labelled_sample(docs, labels, "quality", MODULUS, HELD, rows)
    sample = sample.select(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SHARDS)).alias("shard"), "doc_id", "text", "y")

    def train(group: pa.Table) -> pa.Table:
        # In an order by hash: repeated runs see the same sequence.
        given = sorted(group.to_pylist(), key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"], r["text"]))
        found = train_shard([(r["text"], r["y"]) for r in given])
        at = np.flatnonzero(found)
        return pa.table({"slot": pa.array(at, pa.int64()), "w": pa.array(found[at], pa.float64())})

    models = sample.groupBy("shard").applyInArrow(train, "slot bigint, w double")
    shards = written(models, "weights")
    found = shards.groupBy("slot").agg((F.sum("w") / SHARDS).alias("w")).toPandas()  # at most a row for each slot
    if not len(found):
        return None
    weights = np.zeros((1 << BITS) + 1)
    weights[found.slot.to_numpy()] = found.w.to_numpy()
    return weights


def score(docs: DataFrame, weights: np.ndarray | None) -> DataFrame:
    """(doc_id, score) for every row of ``docs`` (doc_id, text), in one pass without a shuffle.

    Null and empty texts have no n-grams and get the bias alone; without a model every score is 0.5. Repeated rows
    and null ids give a row each.
    """
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, memo = sent.value, WordHashes()
        for batch in batches:
            scores = [
                0.5 if model is None else 1 / (1 + np.exp(-np.clip(model[-1] + dot(t.as_py(), model, memo), -35, 35)))
                for t in batch.column(1)
            ]
            columns = [batch.column(0), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "score"])

    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return given.mapInArrow(run, "doc_id bigint, score double")


def score_all(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``, with a model fitted on ``labels``."""
    return score(docs, fit(docs, labels, rows)).select(
        "doc_id", (id_remainder(MODULUS) == HELD).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
