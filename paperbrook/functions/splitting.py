"""Where to cut one text: at paragraphs, then lines, then words, then characters.

A separator stays at the head of the piece that follows it. A piece of ``size`` characters or more is cut
again at the next finer separator. Neighbouring small pieces form a run, and each run is packed on its own
into chunks of at most ``size``; a chunk starts with the longest tail of the one before that is at most
``overlap`` long and leaves room for the next piece. White space around a chunk is not part of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# The separators, coarse to fine; the empty one cuts between characters.
SEPARATORS = ("\n\n", "\n", " ", "")


def _cuts(codes: np.ndarray, separator: str) -> np.ndarray:
    """Offsets where a separator begins, none overlapping the one before."""
    if separator == "":
        return np.arange(len(codes))
    found = np.flatnonzero(codes == ord(separator[0]))
    for i, char in enumerate(separator[1:], start=1):
        found = found[found < len(codes) - i]
        found = found[codes[found + i] == ord(char)]
    if len(separator) == 1 or len(found) < 2:
        return found
    kept, free_from = [], 0
    for offset in found.tolist():
        if offset >= free_from:
            kept.append(offset)
            free_from = offset + len(separator)
    return np.array(kept, dtype=found.dtype)


def _runs(codes: np.ndarray, base: int, separators: tuple[str, ...], size: int) -> Iterator[np.ndarray]:
    """Piece boundaries of each run, in text order."""
    for depth, separator in enumerate(separators):
        cuts = _cuts(codes, separator)
        if len(cuts) or separator == "":
            break
    head = [] if len(cuts) and cuts[0] == 0 else [0]
    bounds = np.concatenate((head, cuts, [len(codes)])).astype(np.int64)
    large = np.flatnonzero(bounds[1:] - bounds[:-1] >= size)
    begin = 0
    for piece in large.tolist():
        if piece > begin:
            yield bounds[begin : piece + 1] + base
        lo, hi = bounds[piece], bounds[piece + 1]
        if separator == "":
            yield np.array([lo, hi]) + base
        else:
            yield from _runs(codes[lo:hi], base + int(lo), separators[depth + 1 :], size)
        begin = piece + 1
    if begin < len(bounds) - 1:
        yield bounds[begin:] + base


def _pack(bounds: np.ndarray, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Chunks of one run: the loop runs once per chunk, each step a binary search over the pieces."""
    first, last = 0, len(bounds) - 1
    while True:
        end = max(int(bounds.searchsorted(bounds[first] + size, "right")) - 1, first + 1)
        yield int(bounds[first]), int(bounds[end])
        if end >= last:
            return
        # The next chunk may start where the tail fits the overlap and leaves room for the next piece.
        earliest = max(bounds[end] - overlap, bounds[end + 1] - size)
        first = min(int(bounds.searchsorted(earliest, "left")), end)


def chunk_spans(text: str, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Start and end of each chunk of the whole text, white space at both ends left out."""
    if len(text) <= size:
        spans = [(0, len(text))]
    else:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        spans = (span for run in _runs(codes, 0, SEPARATORS, size) for span in _pack(run, size, overlap))
    for start, end in spans:
        body = text[start:end]
        start += len(body) - len(body.lstrip())
        end -= len(body) - len(body.rstrip())
        if start < end:
            yield start, end
