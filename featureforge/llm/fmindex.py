"""FM-index over the word symbols of one training shard (array operations)."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling (a shorter suffix sorts before
    its extensions)."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        nxt = np.zeros(n, np.int64)
        if step < n:
            nxt[:n - step] = rank[step:] + 1
        key = rank * (n + 1) + nxt
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.zeros(n, np.int64)
        new[order[1:]] = np.cumsum(ordered[1:] != ordered[:-1])
        rank = new
        step *= 2
        if n == 0 or rank[order[-1]] == n - 1:
            return order


class Bits:
    """Bit vector with rank by a running count per 64-bit word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        part = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(part)

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    """Rank and access over symbols, one bit vector per symbol bit."""

    def __init__(self, symbols: np.ndarray):
        self.n_bits = max(int(symbols.max()).bit_length() if len(symbols) else 0, 1)
        self.levels, self.zeros = [], []
        s = symbols
        for b in reversed(range(self.n_bits)):
            one = ((s >> b) & 1).astype(bool)
            self.levels.append(Bits(one))
            self.zeros.append(int(len(s) - one.sum()))
            s = np.concatenate([s[~one], s[one]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        low = np.zeros(len(at), np.int64)
        for k, (level, zeros) in enumerate(zip(self.levels, self.zeros)):
            one = ((symbol >> (self.n_bits - 1 - k)) & 1).astype(bool)
            a, z = level.rank(at), level.rank(low)
            at = np.where(one, zeros + a, at - a)
            low = np.where(one, zeros + z, low - z)
        return at - low

    def access(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros(len(at), np.int64)
        for level, zeros in zip(self.levels, self.zeros):
            one = level.get(at)
            ones = level.rank(at)
            out = out * 2 + one
            at = np.where(one, zeros + ones, at - ones)
        return out


class FMIndex:
    """Backward search and location of word phrases in ``text`` (symbols of at
    least 0; the index adds its own end)."""

    def __init__(self, text: np.ndarray, sample: int = 8):
        t = np.append(text.astype(np.int64) + 1, 0)
        order = suffix_array(t)
        self.n = len(t)
        last = t[order - 1]
        self.wavelet = WaveletMatrix(last)
        self.sigma = int(t.max()) + 1
        self.start = np.zeros(self.sigma + 1, np.int64)
        np.cumsum(np.bincount(t, minlength=self.sigma), out=self.start[1:])
        marked = order % sample == 0
        self.marked = Bits(marked)
        self.position = order[marked]
        self.steps = sample

    def search(self, phrases: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [lo, hi) of phrases; row i holds ``length[i]`` symbols of
        ``phrases`` from column 0 on."""
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), self.n, np.int64)
        for k in reversed(range(phrases.shape[1])):
            at = np.flatnonzero((length > k) & (lo < hi))
            if not len(at):
                continue
            symbol = phrases[at, k] + 1
            known = symbol < self.sigma
            hi[at[~known]] = lo[at[~known]]
            at, symbol = at[known], symbol[known]
            lo[at] = self.start[symbol] + self.wavelet.rank(symbol, lo[at])
            hi[at] = self.start[symbol] + self.wavelet.rank(symbol, hi[at])
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of index rows, by walking to a sampled position."""
        out = np.zeros(len(rows), np.int64)
        at, todo, walked = rows.copy(), np.arange(len(rows)), 0
        while len(todo):
            found = self.marked.get(at)
            out[todo[found]] = self.position[self.marked.rank(at[found])] + walked
            todo, at = todo[~found], at[~found]
            symbol = self.wavelet.access(at)
            at = self.start[symbol] + self.wavelet.rank(symbol, at)
            walked += 1
        return out
