"""Vectorised word splitting inside Arrow tasks.

A text is handled as UTF-8 bytes: separators are single ASCII bytes, so words
are found with array operations over the whole batch and no per-word Python
code.  ``Words`` holds, for a block of documents, the distinct words and one
index per word occurrence.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Documents are handled in blocks of about this many bytes of text.
BLOCK_BYTES = 3 << 20

#: ``[^\x20\x09-\x0D]+``: words are separated by space, tab, LF, VT, FF and CR.
SPACES = np.zeros(256, bool)
SPACES[[32, 9, 10, 11, 12, 13]] = True

#: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z: letters, digits, non-ASCII.
NON_ALNUM = np.ones(256, bool)
NON_ALNUM[128:] = False
NON_ALNUM[ord("0"):ord("9") + 1] = False
NON_ALNUM[ord("a"):ord("z") + 1] = False
NON_ALNUM[ord("A"):ord("Z") + 1] = False

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def utf8(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and document offsets of a string column (null: empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    if data is None or off[0] == off[-1]:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0]:off[-1]], off - off[0]


def release_memory() -> None:
    """Gives freed memory back to the system, so that idle workers stay small."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def blocks(batch: pa.RecordBatch, text: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``limit`` bytes of text (one document at least)."""
    if batch.num_rows == 0:
        return
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    cum = np.cumsum(size.astype(np.int64))
    at, done = 0, 0
    while at < batch.num_rows:
        end = max(int(np.searchsorted(cum, done + limit, "right")), at + 1)
        yield batch.slice(at, end - at)
        at, done = end, int(cum[end - 1])
    release_memory()


class Words:
    """Words of a block: ``first`` (n_docs + 1) bounds each document's words,
    ``index`` names the distinct word of each occurrence, ``distinct`` is an
    Arrow binary array of the distinct words."""

    def __init__(self, col, lower: bool = False, separators: np.ndarray = SPACES):
        data, off = utf8(col)
        word = ~separators[data]
        inner = off[1:-1]
        inner = inner[(inner > 0) & (inner < len(data))]
        opens = word.copy()
        opens[1:] &= ~word[:-1]
        opens[inner] = word[inner]
        closes = word.copy()
        closes[:-1] &= ~word[1:]
        closes[inner - 1] = word[inner - 1]
        starts = np.flatnonzero(opens)
        length = np.flatnonzero(closes) + 1 - starts
        self.first = np.searchsorted(starts, off).astype(np.int64)
        kept = data[word]
        if lower:
            kept = _LOWER[kept]
        bounds = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(length, out=bounds[1:])
        self.bytes, self.bounds = kept, bounds
        self.array = pa.Array.from_buffers(pa.large_binary(), len(starts),
                                           [None, pa.py_buffer(bounds), pa.py_buffer(kept)])
        coded = self.array.dictionary_encode()
        self.index = coded.indices.to_numpy()
        self.distinct = coded.dictionary
        self.n_docs = len(off) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of(self) -> np.ndarray:
        """Number in the block of each word's document."""
        return np.repeat(np.arange(self.n_docs), self.counts())

    def hashes(self, seed: int = 0) -> np.ndarray:
        """64-bit hash of each occurrence's word (hashed once per distinct word)."""
        h = np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in self.distinct.to_pylist()),
                        np.uint64, len(self.distinct))
        return h[self.index] if len(h) else np.zeros(0, np.uint64)

    def sentences(self, keep: np.ndarray) -> pa.Array:
        """Each document's words of ``keep``, joined by one space."""
        size = np.diff(self.bounds)
        length = np.where(keep, size + 1, 0)  # with the space that follows
        end = np.zeros(len(length) + 1, np.int64)
        np.cumsum(length, out=end[1:])
        out = np.full(end[-1], 32, np.uint8)
        kept = size[keep]
        source = self.bytes[np.repeat(keep, size)]
        out[np.arange(len(source)) + np.repeat(np.arange(len(kept)), kept)] = source
        # drop the space after a document's last word
        off = end[self.first]
        full = off[1:] > off[:-1]
        drop = np.ones(len(out), bool)
        drop[off[1:][full] - 1] = False
        bounds = off - np.concatenate([[0], np.cumsum(full)])
        return pa.Array.from_buffers(pa.large_string(), self.n_docs,
                                     [None, pa.py_buffer(bounds), pa.py_buffer(out[drop])]).cast(pa.string())


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising bit mixer for 64-bit hashes."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def window_hashes(h: np.ndarray, size: int, factor: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive word hashes (polynomial in
    ``factor``, an odd number); shorter input gives none."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = h[:n].copy()
    f = np.uint64(factor)
    for k in range(1, size):
        out *= f
        out += h[k:k + n]
    return mix(out)


def window_starts(first: np.ndarray, size: int) -> np.ndarray:
    """Positions (over the block) at which a window of ``size`` words fits into
    its document."""
    n = max(int(first[-1]) - size + 1, 0)
    ok = np.ones(n, bool)
    for end in first[1:-1]:
        ok[max(end - size + 1, 0):min(end, n)] = False
    return np.flatnonzero(ok)
