"""Toxicity by a weighted lexicon, matched with Aho-Corasick after folding disguised letters."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperbrook.llm.common import written
from paperbrook.llm.training import SAMPLE_ROWS, id_remainder, labelled_sample

MODULUS, HELD, THRESHOLD = 5, 0, 0.5
# Letters that look like Latin ones, and digits and signs that stand for letters (fixed values).
LOOKALIKES = dict(zip("авеёкмнорстухіїјѕɡοαειυκρτνɑıо", "abeekmhopctyxiijsgoaeiukptvaio", strict=True))
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}
INVISIBLE = "­​‌‍⁠﻿"
FOLD = str.maketrans({**LOOKALIKES, **SUBSTITUTES, **{chr(0xFF41 + i): chr(97 + i) for i in range(26)}, **dict.fromkeys(INVISIBLE)})
WORD = re.compile(r"[^\W\d_]+")
# Harmless phrases in which an entry of the lexicon does not count (fixed values; a parameter).
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "pathetic fallacy")
STEM, LONGEST, MIN_DOCS, MAX_ENTRIES = 3, 24, 3, 2000
# Lengths of beginnings at which words are first looked over.
PROBES = (3, 4, 7)
# Log-likelihood ratio an entry needs beyond twice the logarithm of the number of beginnings that were tried.
MIN_GAIN = 6.0


def fold(text: str | None) -> str:
    return (text or "").lower().translate(FOLD)


@dataclass(frozen=True)
class ToxicityModel:
    """Weights of word beginnings, exception phrases, and the two numbers of the logistic curve."""

    lexicon: dict[str, float]
    exceptions: tuple[str, ...]
    bias: float
    slope: float


def automaton(lexicon: dict[str, float], exceptions: Iterable[str]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for entry, weight in lexicon.items():
        found.add_word(entry, (len(entry), weight))
    for phrase in exceptions:
        found.add_word(fold(phrase), (len(fold(phrase)), None))
    if len(found):
        found.make_automaton()
    return found


def weighted_hits(found, text: str) -> tuple[float, int]:
    """Sum of the weights of entries that begin a word of the folded text outside exception phrases, and hits."""
    if not len(found):
        return 0.0, 0
    spans, hits = [], []
    for end, (length, weight) in found.iter(text):
        start = end - length + 1
        if start and text[start - 1].isalpha():
            continue
        if weight is None:
            if end + 1 == len(text) or not text[end + 1].isalpha():
                spans.append((start, end))
        else:
            hits.append((start, end, weight))
    if spans:
        hits = [h for h in hits if not any(s <= h[0] and h[1] <= e for s, e in spans)]
    return sum(h[2] for h in hits), len(hits)


def feature(total: float, words: int) -> float:
    """Weight per hundred words on a logarithmic scale."""
    return math.log1p(100.0 * max(total, 0.0) / max(words, 1))


def features(docs: DataFrame, lexicon: dict[str, float], exceptions: tuple[str, ...]) -> DataFrame:
    """The columns of ``docs`` but its text (the last column), with the feature _x and the number of _hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton(lexicon, exceptions)
        for batch in batches:
            xs, counts = [], []
            for text in batch.column(batch.num_columns - 1):
                folded = fold(text.as_py())
                total, hits = weighted_hits(found, folded)
                xs.append(feature(total, len(folded.split())))
                counts.append(hits)
            columns = [*batch.columns[:-1], pa.array(xs, pa.float64()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "_x", "_hits"])

    added = [T.StructField("_x", T.DoubleType()), T.StructField("_hits", T.LongType())]
    schema = T.StructType([*docs.schema.fields[:-1], *added])
    return docs.mapInArrow(run, schema)


def gain(toxic: int, clean: int, all_toxic: int, all_clean: int) -> float:
    """Log-likelihood ratio of a word's presence against the shares of the two classes."""
    both, share = toxic + clean, all_toxic / (all_toxic + all_clean)
    parts = ((toxic, both * share), (clean, both * (1 - share)))
    return 2 * sum(seen * math.log(seen / expected) for seen, expected in parts if seen)


def choose_entries(
    counts: dict[str, tuple[int, int]], all_toxic: int, all_clean: int, tried: int
) -> dict[str, float]:
    """Word beginnings that mark toxic texts: each made as long as most of its texts allow, none inside another.

    The more beginnings were ``tried``, the more an entry must tell, so that none is there by chance.
    """
    least = MIN_GAIN + 2 * math.log(max(tried, 1))
    strong = {}
    for stem, (toxic, clean) in counts.items():
        weight = math.log((toxic + 0.5) / (all_toxic + 1) / ((clean + 0.5) / (all_clean + 1)))
        if toxic >= MIN_DOCS and weight >= 3 and gain(toxic, clean, all_toxic, all_clean) >= least:
            strong[stem] = weight
    grown = set()
    for stem in strong:
        longer = [s for s in strong if s.startswith(stem) and counts[s][0] >= 0.9 * counts[stem][0]]
        grown.add(max(longer, key=lambda s: (len(s), s)))
    kept = [s for s in grown if not any(s != p and s.startswith(p) for p in grown)]
    kept = sorted(kept, key=lambda s: (-strong[s], s))[:MAX_ENTRIES]
    return {s: strong[s] for s in sorted(kept)}


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Bias and slope by Newton steps, the slope and bias held back a little so that parted classes end too."""
    design = np.column_stack([np.ones_like(x), x])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        step = np.linalg.solve((design.T * (p * (1 - p))) @ design + ridge * np.eye(2), design.T @ (y - p) - ridge * beta)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def folded_words(sample: DataFrame) -> DataFrame:
    """(likeness, y, words) with the distinct folded words of each sampled text.

    ``likeness`` is the least hash of three words in a row: copies have the same one, and near copies mostly.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [fold(text) for text in batch.column(1).to_pylist()]
            words = [sorted(set(WORD.findall(text))) for text in texts]
            runs = [text.split() for text in texts]
            least = [min(zlib.crc32(" ".join(r[at : at + 3]).encode()) for at in range(max(1, len(r) - 2))) for r in runs]
            columns = [pa.array(least, pa.int64()), batch.column(0), pa.array(words, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["likeness", "y", "words"])

    return sample.select("y", "text").mapInArrow(run, "likeness bigint, y int, words array<string>")


def stem_counts(words: DataFrame, lengths: Column) -> DataFrame:
    """(stem, toxic, clean): texts of each class that have a word with that beginning; like texts count once."""
    stems = words.select("likeness", "y", "word", F.explode(lengths).alias("n")).where(F.length("word") >= F.col("n"))
    each = stems.select("likeness", "y", F.substring("word", F.lit(1), F.col("n")).alias("stem")).distinct()
    return each.groupBy("stem").agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("clean"))


def fit(
    docs: DataFrame, labels: DataFrame, exceptions: tuple[str, ...] = EXCEPTIONS, rows: int = SAMPLE_ROWS
) -> ToxicityModel:
    """Learn the lexicon and the curve from at most ``rows`` labelled texts.

    Word beginnings of a few lengths are counted first; only words that lean to toxic texts at one of them are
    counted at all lengths. What comes to the driver is bounded by the sample. Without labelled texts of both classes the
    lexicon is empty and every score is zero.
    """
    sample = written(folded_words(labelled_sample(docs, labels, "toxic", MODULUS, HELD, rows)), "sample")
    totals = sample.select("likeness", "y").distinct().agg(F.sum("y").alias("toxic"), F.count("*").alias("n")).first()
    toxic, clean = int(totals.toxic or 0), int(totals.n - (totals.toxic or 0))
    if not toxic or not clean:
        return ToxicityModel({}, exceptions, -math.inf, 0.0)
    words = sample.select("likeness", "y", F.explode("words").alias("word"))
    probes = F.array(*[F.lit(n) for n in PROBES])
    stems = written(stem_counts(words, probes), "stems")
    leaning = stems.where((F.col("toxic") >= MIN_DOCS) & (F.col("toxic") * clean > 3 * F.col("clean") * toxic))
    begun = words.select("word", F.explode(probes).alias("n")).distinct().where(F.length("word") >= F.col("n"))
    begun = begun.withColumn("stem", F.substring("word", F.lit(1), F.col("n"))).join(leaning, "stem", "left_semi")
    near = words.join(begun.select("word").distinct(), "word", "left_semi")
    every = F.sequence(F.lit(STEM), F.greatest(F.least(F.length("word"), F.lit(LONGEST)), F.lit(STEM)))
    counted = stem_counts(near, every).where(F.col("toxic") >= MIN_DOCS).collect()
    lexicon = choose_entries({r.stem: (r.toxic, r.clean) for r in counted}, toxic, clean, stems.count())
    texts = labelled_sample(docs, labels, "toxic", MODULUS, HELD, rows).select("y", "text")
    points = features(texts, lexicon, exceptions).select("y", "_x").toPandas()  # two numbers for each sampled row
    bias, slope = logistic(points["_x"].to_numpy(float), points["y"].to_numpy(float))
    return ToxicityModel(lexicon, exceptions, bias, slope)


def with_score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(given, score, hits): each row of ``docs`` as a struct, scored in one pass without a shuffle.

    Null and empty texts have no hits and get the curve's lowest score. Repeated rows and null ids give a row each.
    """
    packed = docs.select(F.struct(*docs.columns).alias("given"), docs["text"].alias("_text"))
    found = features(packed, model.lexicon, model.exceptions)
    raw = F.lit(model.bias) + F.lit(model.slope) * F.col("_x") if model.lexicon else F.lit(-math.inf)
    return found.select("given", (1 / (1 + F.exp(-raw))).alias("score"), F.col("_hits").alias("hits"))


def score_all(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted, hits) for every row of ``docs``, with a model fitted on ``labels``."""
    scored = with_score(docs.select("doc_id", "text"), fit(docs, labels, rows=rows))
    scored = scored.select("given.doc_id", "score", "hits")
    return scored.select(
        "doc_id", (id_remainder(MODULUS) == HELD).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "hits",
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` whose score stays below the threshold, all columns as they are."""
    return with_score(docs, fit(docs, labels, rows=rows)).where(F.col("score") < THRESHOLD).select("given.*")
