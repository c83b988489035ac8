"""Numpy kernels over whole texts: words, their hashes and n-gram hashes.

A word is ``[^\\x20\\x09-\\x0D]+``.  These separators are ASCII, so working on
UTF-8 bytes gives the same words as working on characters.  Hashes are 64-bit
polynomials over bytes (or over word hashes) taken from prefix sums, so a
chunk of documents is hashed without a Python loop over words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18
SLICE_ROWS = 128
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD6E8FEB86659FD93
_M64 = (1 << 64) - 1
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, n or more of them."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(1 << int(n).bit_length(), np.uint64(b))
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        _POWERS[base] = out[0], out[1]
    return _POWERS[base]


def _range_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[start:end] for each pair, whatever stands around it."""
    up, down = _powers(base, len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


class Words:
    """The words of some whole documents: byte ``start``/``end`` in ``buf``,
    ``doc`` (index of the document) and ``first`` (word offsets of documents,
    one more than there are documents)."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        if lower:
            self.buf = _LOWER[self.buf]
        inside = ~_SEPARATOR[self.buf]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edge = np.concatenate(([0], edge))
        self.start, self.end = edge[0::2], edge[1::2]
        at = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.first = np.searchsorted(self.start, at)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        return _range_hash(self.buf.astype(np.uint64) + np.uint64(1), self.start, self.end, _BYTE_BASE)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n word hashes (document borders not regarded)."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    start = np.arange(len(words) - n + 1)
    return _range_hash(words, start, start + n, _WORD_BASE)


def span_hashes(words: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of words[start:end] for each pair."""
    return _range_hash(words, start, end, _WORD_BASE)


def grams_inside(doc: np.ndarray, n: int) -> np.ndarray:
    """True where the run of n words lies in one document."""
    return doc[n - 1:] == doc[:len(doc) - n + 1] if len(doc) >= n else np.empty(0, bool)


def column_bytes(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [b"" if x is None else x for x in batch.column(name).cast(pa.binary()).to_pylist()]


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches of about ``limit`` bytes of whole texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(at, SLICE_ROWS)
            texts = column_bytes(part, text)
            begin, held = 0, 0
            for i, t in enumerate(texts):
                held += len(t)
                if held >= limit or i + 1 == len(texts):
                    yield part.slice(begin, i + 1 - begin), texts[begin:i + 1]
                    begin, held = i + 1, 0


def release() -> None:
    """Gives memory that the process no longer uses back to the system."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, and memory given back at the end of each task: Spark keeps idle
    Python workers, and an executor holds those of several stages at once."""
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()
    return whole
