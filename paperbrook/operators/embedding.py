"""What a text is searched by: its terms with their counts, and a hashed vector of unit length.

Ready-made vectors can be used in place of the hashed ones.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperbrook.functions.text import token_line

DIM = 64
# Rows of an Arrow batch that are counted together.
FEW_ROWS = 1024
# Tokens whose bucket a worker remembers.
MEMO_TOKENS = 200_000

PROFILE = "struct<doc_len:int,terms:array<string>,tfs:array<int>,embedding:array<double>>"


def token_bucket(token: str, dim: int) -> int:
    """The first 32 bits of the token's md5, modulo the number of buckets."""
    return int.from_bytes(hashlib.md5(token.encode()).digest()[:4], "big") % dim


def _lists(values: pa.Array, lengths: np.ndarray) -> pa.ListArray:
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(offsets, values)


def _tokens(rows: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Number of tokens of each row and all of them in order; rows are lists or lines, of which an empty one has none."""
    line = pa.types.is_string(rows.type)
    lists = pc.split_pattern(rows, " ") if line else rows
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    words = lists.flatten()
    if line:
        lengths[pc.fill_null(pc.equal(rows, ""), False).to_numpy(zero_copy_only=False)] = 0
        words = words.filter(pc.not_equal(words, ""))
    return lengths, words


def term_profile(terms: Column, dim: int = DIM) -> Column:
    """Length in tokens, distinct terms in order, their counts and the vector, of a line of tokens or an array of them.

    One pass over an Arrow batch, some rows at a time: each distinct term of these is hashed once, and all
    their counts come from one sort of integers.
    """

    memo: dict[str, int] = {}

    def bucket(word: str) -> int:
        if word not in memo:
            if len(memo) >= MEMO_TOKENS:
                memo.clear()
            memo[word] = token_bucket(word, dim)
        return memo[word]

    def profile_few(rows: pa.Array) -> pa.Array:
        n = len(rows)
        lengths, words = _tokens(rows)
        encoded = words.dictionary_encode()
        order = pc.sort_indices(encoded.dictionary)
        words = encoded.dictionary.take(order)
        size = max(len(words), 1)
        place = np.empty(size, dtype=np.int64)
        place[order.to_numpy()] = np.arange(len(words))
        codes = place[encoded.indices.to_numpy()]
        pairs, counts = np.unique(np.repeat(np.arange(n), lengths) * size + codes, return_counts=True)
        row, word = pairs // size, pairs % size

        buckets = np.array([bucket(w) for w in words.to_numpy(zero_copy_only=False).tolist()], dtype=np.int64)
        sums = np.bincount(row * dim + buckets[word], weights=counts, minlength=n * dim)
        sums = sums.astype(np.float64).reshape(n, dim)
        norms = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        units = np.divide(sums, norms, out=np.zeros_like(sums), where=norms > 0)

        per_row = np.bincount(row, minlength=n)
        return pa.StructArray.from_arrays(
            [
                pa.array(lengths, pa.int32()),
                _lists(words.take(pa.array(word)), per_row),
                _lists(pa.array(counts, pa.int32()), per_row),
                _lists(pa.array(units.ravel()), np.full(n, dim)),
            ],
            names=["doc_len", "terms", "tfs", "embedding"],
        )

    def profile(rows: pa.Array) -> pa.Array:
        # What is held beside the batch and its result follows these rows and not the batch.
        return pa.concat_arrays([profile_few(rows.slice(at, FEW_ROWS)) for at in range(0, max(len(rows), 1), FEW_ROWS)])

    profile.__annotations__ = {"rows": pa.Array, "return": pa.Array}
    return F.arrow_udf(profile, PROFILE)(terms)


def embed(df: DataFrame, text: str = "text", dim: int = DIM, vector: str = "embedding") -> DataFrame:
    """Add the vector column, row by row and without a shuffle."""
    return df.withColumn(vector, term_profile(token_line(F.col(text)), dim)["embedding"])
