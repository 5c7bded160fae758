"""Split texts into overlapping chunks. Both splitters work row by row: no shuffle, no grouping."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperbrook.functions.ids import chunk_id
from paperbrook.functions.splitting import chunk_spans

SIZE, OVERLAP = 1024, 256
# Texts of an Arrow batch that are split together.
FEW_TEXTS = 256

CHUNK_TYPE = "array<struct<ordinal:int,start:int,end:int,text:string>>"


def _check(size: int, overlap: int) -> None:
    if size < 1 or not 0 <= overlap < size:
        raise ValueError(f"need size >= 1 and 0 <= overlap < size, got {size} and {overlap}")


def recursive_chunks(text: Column, size: int = SIZE, overlap: int = OVERLAP) -> Column:
    """The chunks of a text, cut at paragraphs, lines, words and characters in that order."""
    _check(size, overlap)

    def split_few(texts: pa.Array) -> pa.Array:
        offsets, ordinals, starts, ends, pieces = [0], [], [], [], []
        for text in texts.to_pylist():
            for ordinal, (start, end) in enumerate(chunk_spans(text, size, overlap) if text else ()):
                ordinals.append(ordinal)
                starts.append(start)
                ends.append(end)
                pieces.append(text[start:end])
            offsets.append(len(ordinals))
        rows = pa.StructArray.from_arrays(
            [pa.array(x, pa.int32()) for x in (ordinals, starts, ends)] + [pa.array(pieces, pa.string())],
            names=["ordinal", "start", "end", "text"],
        )
        return pa.ListArray.from_arrays(np.array(offsets, dtype=np.int32), rows)

    def split(texts: pa.Array) -> pa.Array:
        # Of a batch only a few texts are Python strings at a time.
        return pa.concat_arrays([split_few(texts.slice(at, FEW_TEXTS)) for at in range(0, max(len(texts), 1), FEW_TEXTS)])

    # Annotations are read at run time by arrow_udf, so they must be the types themselves.
    split.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(split, CHUNK_TYPE)(text)


def _windows(steps: Column, step: int, size: int, overlap: int) -> Column:
    """Windows put together from the steps each one spans, with ordinal, start and end."""
    joined = steps
    for shift in range(1, -(-size // step)):
        following = F.slice(steps, shift + 1, 1 << 30)
        joined = F.zip_with(joined, following, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    windows = F.transform(
        F.transform(joined, lambda w: F.substring(w, 1, size)),
        lambda w, i: F.struct(
            i.cast("int").alias("ordinal"),
            (i * step).cast("int").alias("start"),
            (i * step + F.length(w)).cast("int").alias("end"),
            w.alias("text"),
        ),
    )
    return F.filter(windows, lambda w: (w["ordinal"] == 0) | (w["end"] - w["start"] > overlap))


def _explode(df: DataFrame, chunks: Column, text: str) -> DataFrame:
    kept = [c for c in df.columns if c != text]
    return df.select(*kept, F.explode(chunks).alias("_c")).select(
        *kept,
        F.col("_c.ordinal").alias("ordinal"),
        F.col("_c.start").alias("start"),
        F.col("_c.end").alias("end"),
        F.col("_c.text").alias("chunk_text"),
    )


def chunk_recursive(df: DataFrame, size: int = SIZE, overlap: int = OVERLAP, text: str = "text") -> DataFrame:
    """One row per chunk with ordinal, start, end and chunk_text; every other column is carried along.

    Only the text column goes to Python; the others stay in the JVM.
    """
    return _explode(df, recursive_chunks(F.col(text), size, overlap), text)


def chunk_fixed(df: DataFrame, size: int = SIZE, overlap: int = OVERLAP, text: str = "text") -> DataFrame:
    """Windows of ``size`` characters, each ``size - overlap`` after the one before; built-in expressions only.

    The text is cut once into steps and every window is put together from the steps it spans, so a
    long text costs time in its length; taking each window by offset would rescan it from the start.
    A last window that lies wholly inside the one before is left out.
    """
    _check(size, overlap)
    step = size - overlap
    steps = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    return _explode(df.withColumn(text, steps), _windows(F.col(text), step, size, overlap), text)


def with_chunk_ids(chunks: DataFrame) -> DataFrame:
    """Add the stable id; ``path``, ``version`` and ``ordinal`` make it."""
    return chunks.withColumn("chunk_id", chunk_id(F.col("path"), F.col("version"), F.col("ordinal")))


def make_chunks(files: DataFrame, size: int = SIZE, overlap: int = OVERLAP, fixed: bool = False) -> DataFrame:
    """Chunk rows of files with path, version, category, year, month and text; every file is split."""
    split = chunk_fixed if fixed else chunk_recursive
    chunks = split(files.select("path", "version", "category", "year", "month", "text"), size, overlap)
    return with_chunk_ids(chunks).select(
        "path", "chunk_id", "chunk_text", "category", "year", "month", "version", "ordinal"
    )
