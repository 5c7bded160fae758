"""Token ids of documents packed into fixed-length rows of binary files."""

from __future__ import annotations

import base64
import io
import os
import uuid

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperbrook.llm.common import written
from paperbrook.session import new_run_folder

ROW_TOKENS = 2048
# Tokens gathered in a task before they are packed and written, which bounds its memory.
SHARD_TOKENS = 4 << 20
# How a byte-level vocabulary splits text before its merges (fixed by the public vocabulary).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PIECE_CHARS = 1 << 20
RESULT = (
    "doc_id bigint, piece bigint, n_pieces bigint, shard string, row bigint, start bigint, length bigint, "
    "ids_sha256 string"
)


class Tokenizer:
    """Byte-level BPE from a public rank file; token ids are below ``size`` and the last one ends a document."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.end = max(ranks.values()) + 1
        self.size = self.end + 1
        self.coder = tiktoken.Encoding(os.path.basename(path), pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        """Ids of the whole text and the end sign; very long texts are encoded in pieces cut after a line end or blank."""
        parts, at = [], 0
        while len(text) - at > PIECE_CHARS:
            cut = max(text.rfind("\n", at, at + PIECE_CHARS), text.rfind(" ", at, at + PIECE_CHARS))
            cut = cut if cut > at else at + PIECE_CHARS
            parts.append(self.coder.encode_ordinary(text[at:cut]))
            at = cut
        parts.append([*self.coder.encode_ordinary(text[at:]), self.end])
        return np.concatenate([np.asarray(p, np.uint32) for p in parts])

    def decode(self, ids: Iterable[int]) -> str:
        return self.coder.decode([int(i) for i in ids if i != self.end])


class Capacities:
    """A segment tree over remaining capacities 0..size: how many open rows have each, and the least that fits."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = np.zeros(2 * self.leaves, np.int64).tolist()
        self.rows: dict[int, list[int]] = {}

    def change(self, capacity: int, by: int) -> None:
        at = capacity + self.leaves
        while at:
            self.count[at] += by
            at >>= 1

    def put(self, capacity: int, row: int) -> None:
        self.rows.setdefault(capacity, []).append(row)
        self.change(capacity, 1)

    def take(self, needed: int) -> tuple[int, int] | None:
        """The row with the least capacity of at least ``needed``, and that capacity; it leaves the tree."""
        at = needed + self.leaves
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        capacity = at - self.leaves
        self.change(capacity, -1)
        return self.rows[capacity].pop(), capacity


def best_fit_decreasing(lengths: list[int], row_tokens: int) -> list[tuple[int, int]]:
    """(row, start) for every length, longest first, each into the fullest row that still has room."""
    open_rows, placed, rows = Capacities(row_tokens), [(0, 0)] * len(lengths), 0
    for at in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = open_rows.take(lengths[at])
        if found is None:
            found = rows, row_tokens
            rows += 1
        row, capacity = found
        placed[at] = row, row_tokens - capacity
        if capacity > lengths[at]:
            open_rows.put(capacity - lengths[at], row)
    return placed


def pack(pieces: list[np.ndarray], row_tokens: int, pad: int, kind: type) -> tuple[dict[str, np.ndarray], list[tuple[int, int]]]:
    """The arrays of a shard and where each piece lies.

    ``ids`` has a row of ``row_tokens`` ids for each packed row, filled up with ``pad``; ``cu_seqlens`` holds the
    cumulative lengths of the segments of all rows end to end, padding being a segment of its own; ``rows`` is
    the number of segments up to each row; ``resets`` are the flat places where positions start again at zero.
    """
    placed = best_fit_decreasing([len(p) for p in pieces], row_tokens)
    rows = 1 + max((row for row, _ in placed), default=-1)
    ids = np.full((rows, row_tokens), pad, kind)
    used = np.zeros(rows, np.int64)
    starts = []
    for piece, (row, start) in zip(pieces, placed, strict=True):
        ids[row, start : start + len(piece)] = piece
        used[row] += len(piece)
        starts.append(row * row_tokens + start)
    padding = np.flatnonzero(used < row_tokens) * row_tokens + used[used < row_tokens]
    resets = np.sort(np.concatenate([np.array(starts, np.int64), padding]))
    segments = np.searchsorted(resets, np.arange(rows + 1) * row_tokens)
    return {"ids": ids, "cu_seqlens": np.append(resets, rows * row_tokens), "rows": segments, "resets": resets}, placed


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def positions(shard: dict[str, np.ndarray]) -> np.ndarray:
    """Position ids of a shard's matrix: the distance from the last reset."""
    flat = np.arange(shard["ids"].size)
    resets = shard["resets"]
    return (flat - resets[np.searchsorted(resets, flat, "right") - 1]).reshape(shard["ids"].shape)


def read_shard(path: str) -> dict[str, np.ndarray]:
    store, inside = filesystem(path)
    with store.open_input_file(inside) as file:
        return dict(np.load(io.BytesIO(file.read()), allow_pickle=False))


def write_packed(
    docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, row_tokens: int = ROW_TOKENS,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Write the token ids of all rows of ``docs`` (doc_id, text) under ``folder``; returns the written placements.

    One row per piece: doc_id, piece (from 0), n_pieces, shard (file), row, start, length, ids_sha256 of the piece.
    A document's ids and the end sign are cut into pieces of at most ``row_tokens``; pieces of about
    ``shard_tokens`` ids of a task are packed together, so nothing is shuffled and memory is bounded however long a
    text is, as long as one text fits in a task. Ids are little-endian 16-bit numbers where the vocabulary allows.

    Null and empty texts are one piece that holds the end sign. Repeated rows and null ids are packed each. Other
    columns are not read. A shard has the attempt in its name and counts only through its placements, so the file
    of a lost task is never read.
    """
    from hashlib import sha256

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Tokenizer(vocabulary)
        kind = np.uint16 if coder.size <= 1 << 16 else np.uint32
        store, inside = filesystem(folder)
        store.create_dir(inside, recursive=True)
        context = TaskContext.get()
        name = f"{context.partitionId():06d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
        keys: list[tuple[int | None, int, int]] = []
        pieces: list[np.ndarray] = []
        gathered = number = 0

        def flush() -> pa.RecordBatch:
            shard, placed = pack(pieces, row_tokens, coder.end, kind)
            path = f"{inside}/shard-{name}-{number:04d}.npz"
            buffer = io.BytesIO()
            np.savez(buffer, **shard)
            with store.open_output_stream(path) as file:
                file.write(buffer.getbuffer())
            url = f"{folder}/{path.rsplit('/', 1)[1]}"
            lengths = [len(p) for p in pieces]
            digests = [sha256(p.astype("<u4").tobytes()).hexdigest() for p in pieces]
            doc_ids, at, of = zip(*keys, strict=True)
            rows, starts = zip(*placed, strict=True)
            columns = [pa.array(c, pa.int64()) for c in (doc_ids, at, of)] + [pa.array([url] * len(keys))]
            columns += [pa.array(c, pa.int64()) for c in (rows, starts, lengths)] + [pa.array(digests)]
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in RESULT.split(", ")])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = coder.encode(text.as_py() or "").astype(kind)
                count = -(-len(ids) // row_tokens)
                for piece in range(count):
                    keys.append((doc_id, piece, count))
                    pieces.append(ids[piece * row_tokens : (piece + 1) * row_tokens])
                gathered += len(ids)
                if gathered >= shard_tokens:
                    yield flush()
                    keys.clear(), pieces.clear()
                    gathered, number = 0, number + 1
        if keys:
            yield flush()

    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return written(given.mapInArrow(run, RESULT), "placements")


def verify(placements: DataFrame) -> DataFrame:
    """The placements with ``intact``: whether the file holds the piece's ids at its place, with a reset there."""
    from hashlib import sha256

    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        shard = read_shard(key[0].as_py())
        resets = set(shard["resets"].tolist())
        width = shard["ids"].shape[1]
        intact = []
        for row, start, length, digest in zip(*(group[c].to_pylist() for c in ("row", "start", "length", "ids_sha256")), strict=True):
            held = shard["ids"][row, start : start + length].astype("<u4").tobytes()
            intact.append(sha256(held).hexdigest() == digest and row * width + start in resets)
        return group.append_column("intact", pa.array(intact, pa.bool_()))

    return placements.groupBy("shard").applyInArrow(run, f"{RESULT}, intact boolean")


def token_output(docs: DataFrame, vocabulary: str = VOCABULARY, row_tokens: int = ROW_TOKENS) -> DataFrame:
    """Pack all rows into a new folder under the shared one, and read every piece back."""
    folder = new_run_folder(docs.sparkSession, "tokens")
    return verify(write_packed(docs, folder, vocabulary, row_tokens))
