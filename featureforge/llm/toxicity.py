"""Toxicity by a subsequence string-kernel support vector machine.

Units are words, windows of two and three words, and runs of up to twelve words
of at most two bytes, read without the spaces between them.  Units (lower-cased, look-alike digits and signs folded to letters, other ASCII
signs dropped, so ``i-d-1-o-t`` reads ``idiot``) are compared by the gap-weighted
subsequence kernel: all triples of bytes within ``SPAN`` bytes count, each
weighted by ``DECAY`` to the length it stretches over, so inserted or missing
letters cost a little and not everything.  Word limits count as letters.

Training (labelled documents outside the held-out part, at most about
``MAX_TRAIN_DOCS`` of them): of the words that toxic documents have and clean
ones lack, those that together explain the toxic documents (greedy cover) mark
the toxic sentences' units; words of clean documents are the other class.  Nystroem landmarks from both classes turn the kernel into vectors, a
linear support vector machine (squared hinge) separates them, and a second
round adds the clean words that came closest.  Because the kernel is a sum over
triples, landmarks and weights collapse into one table of triples, which scores
any word by lookups.  A document's score is a logistic function of the two best
word values and the number of positive words, fitted on the same documents.

Everything fitted has a bounded size (the sample, ``MAX_WORDS``, landmarks);
scoring is one pass without a shuffle.

Defined cases: texts without words get the score of no toxic word; unlabelled
rows are scored like others; several labels of one id count as toxic if one of
them is; without examples of both classes every score is 0; extra columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureforge.llm.words import Words, blocks, window_hashes

MAX_TRAIN_DOCS = 8000
#: Words of each class that train the machine at most.
MAX_WORDS = 3000
POSITIVE_LANDMARKS, NEGATIVE_LANDMARKS = 160, 96
SPAN, DECAY = 5, 0.6
#: A toxic unit occurs in at least this many toxic documents, and so much more often than in clean ones.
LEAST_TOXIC_DOCS, LEAST_RATIO = 4, 20.0
#: Toxic units are chosen until each toxic document holds this many, while one more explains enough of them.
UNITS_PER_DOC, LEAST_GAIN = 2, 0.004
#: Text bytes a task scores at a time.
PART_BYTES = 2 << 20
#: Longest unit; longer words are cut at signs, and what is still longer into overlapping parts.
MAX_BYTES = 40
#: Sizes of those parts; each begins a quarter of its size after the one before.
PART_SIZES = (8, 12, 20)
#: Words of a window, and of a window over words of at most SHORT bytes.
WINDOWS, SHORT_WINDOWS, SHORT = (2, 3), range(4, 13), 2
#: Windows that are scored at a time; one in so many is a training example of its class.
SLICE, SAMPLE = 1 << 15, 64
#: Phrases whose documents are counted at most.
MAX_PHRASES = 20000

# Signs written in place of letters.
LOOK_ALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}


def _codes() -> np.ndarray:
    """Code of each byte: 1-26 letters, 27-36 digits, 39-54 lead bytes, 64-127
    continuation bytes; 0: dropped."""
    code = np.zeros(256, np.int64)
    for k in range(26):
        code[ord("a") + k] = code[ord("A") + k] = k + 1
    for k in range(10):
        code[ord("0") + k] = 27 + k
    for sign, letter in LOOK_ALIKE.items():
        code[ord(sign)] = code[ord(letter)]
    code[0x80:0xC0] = np.arange(64, 128)
    code[0xC0:] = 39 + (np.arange(0xC0, 256) & 15)
    return code


CODES = _codes()
OPEN, CLOSE = 37, 38
_SIGNS = re.compile(b"[" + b"".join(re.escape(bytes([k])) for k in range(128) if not CODES[k]) + b"]+")
OFFSETS = [(a, b) for a in range(1, SPAN) for b in range(a + 1, SPAN + 1)]
PAD = SPAN
_FACTOR = 0x9E3779B97F4A7C15


class Units:
    """Codes of words with their limits, padded so that no triple joins two words."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray):
        n = len(bounds) - 1
        code = CODES[data]
        word = np.repeat(np.arange(n), np.diff(bounds))
        code, word = code[code > 0], word[code > 0]
        size = np.bincount(word, minlength=n)
        start = np.concatenate([[0], np.cumsum(size + 2 + PAD)])
        self.codes = np.zeros(int(start[-1]) + PAD, np.int64)
        self.codes[np.arange(len(code)) - np.repeat(np.cumsum(size) - size, size) + start[word] + 1] = code
        self.codes[start[:-1]] = OPEN
        self.codes[start[:-1] + size + 1] = CLOSE
        self.start, self.size = start[:-1], size

    def triples(self) -> Iterator[tuple[np.ndarray, float]]:
        """Triple number at every position (0 where it has a pad) and its weight."""
        n = len(self.codes) - PAD
        c = self.codes
        for a, b in OFFSETS:
            t = (c[:n] << 14) | (c[a:n + a] << 7) | c[b:n + b]
            t[(c[:n] == 0) | (c[a:n + a] == 0) | (c[b:n + b] == 0)] = 0
            yield t, DECAY ** (b + 1)

    def norm(self) -> np.ndarray:
        """Length of each word's vector as if all its triples differed."""
        total = np.zeros(len(self.size))
        for a, b in OFFSETS:
            total += np.maximum(self.size + 2 - b, 0) * DECAY ** (2 * (b + 1))
        return np.sqrt(np.maximum(total, DECAY ** 6))

    def score(self, table: np.ndarray) -> np.ndarray:
        """Inner product of each word with a table over triples, normalised."""
        if not len(self.size):
            return np.zeros(0)
        n = len(self.codes) - PAD
        value = np.zeros(n)
        c = self.codes.astype(np.int32)
        for a, b in OFFSETS:  # a table has no entry for a triple with a pad
            value += table[(c[:n] << 14) | (c[a:n + a] << 7) | c[b:n + b]] * DECAY ** (b + 1)
        return np.add.reduceat(value, self.start) / self.norm()

    def matrix(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, triple, weight) entries of the normalised vectors."""
        word = np.repeat(np.arange(len(self.size)), self.size + 2 + PAD)
        w, t, v = [], [], []
        norm = self.norm()
        for triple, weight in self.triples():
            at = np.flatnonzero(triple)
            w.append(word[at])
            t.append(triple[at])
            v.append(weight / norm[word[at]])
        return np.concatenate(w), np.concatenate(t), np.concatenate(v)


def units_of(words: list[bytes]) -> Units:
    bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    return Units(np.frombuffer(b"".join(words), np.uint8), bounds)


def kernel(landmarks: Units, units: Units) -> np.ndarray:
    """Kernel values, landmarks x units."""
    w, t, v = landmarks.matrix()
    out = np.zeros((len(landmarks.size), len(units.size)))
    table = np.zeros(1 << 21)
    for k in range(len(out)):
        mine = w == k
        table[:] = 0
        np.add.at(table, t[mine], v[mine])
        out[k] = units.score(table)
    return out


class Machine:
    """Linear machine over Nystroem features, collapsed to a table of triples."""

    def __init__(self, positive: list[bytes], negative: list[bytes], landmarks: list[bytes]):
        marks = units_of(landmarks)
        square = kernel(marks, marks)
        values, vectors = np.linalg.eigh((square + square.T) / 2)
        keep = values > 1e-6 * values.max()
        half = vectors[:, keep] / np.sqrt(values[keep])  # K^-1/2 on its range
        x = kernel(marks, units_of(positive + negative)).T @ half
        x = np.hstack([x, np.ones((len(x), 1))])
        y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
        share = np.where(y > 0, 0.5 / max(len(positive), 1), 0.5 / max(len(negative), 1))
        w = np.zeros(x.shape[1])
        ridge = np.full(x.shape[1], 1e-4)
        ridge[-1] = 1e-8
        for _ in range(30):  # Newton steps of the squared hinge
            active = y * (x @ w) < 1
            a, s = x[active], share[active]
            new = np.linalg.solve(a.T @ (a * s[:, None]) + np.diag(ridge), a.T @ (s * y[active]))
            if np.allclose(new, w, atol=1e-9):
                break
            w = new
        alpha = half @ w[:-1]
        word, triple, v = marks.matrix()
        self.table = np.bincount(triple, weights=v * alpha[word], minlength=1 << 21).astype(np.float32)
        self.bias = float(w[-1])

    def values(self, units: Units) -> np.ndarray:
        return units.score(self.table) + self.bias

    def small(self) -> tuple[np.ndarray, np.ndarray]:
        """(number of each code among those in the table, 0 for the others; the table over these numbers)."""
        if not hasattr(self, "_small"):
            at = np.flatnonzero(self.table)
            used = np.unique(np.concatenate([at >> 14, (at >> 7) & 127, at & 127, [OPEN, CLOSE]]))
            number = np.zeros(128, np.int64)
            number[used] = np.arange(1, len(used) + 1)
            k = len(used) + 1
            table = np.zeros(k ** 3)
            table[(number[at >> 14] * k + number[(at >> 7) & 127]) * k + number[at & 127]] = self.table[at]
            self._small = number, table
        return self._small

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_small"}


class Stream:
    """Values of any runs of consecutive words of a block.  Triples are scored once
    over the whole block as whole numbers, so that the sum of a run is an exact
    difference of running sums and does not depend on where the run lies."""

    UNIT = float(1 << 32)

    def __init__(self, data: np.ndarray, bounds: np.ndarray, machine: Machine):
        number, table = machine.small()
        k = int(round(len(table) ** (1 / 3)))
        kept = (CODES > 0)[data]
        at = np.concatenate([[0], np.cumsum(kept)])[bounds - bounds[0]]
        c = np.zeros(int(at[-1]) + 2 * SPAN, np.int64)
        c[SPAN:SPAN + at[-1]] = number[CODES][data[kept]]
        m, n = int(at[-1]), len(at)
        self.bias, self.at, self.code, self.table, self.k = machine.bias, at, c, table, k
        self.open, self.close = int(number[OPEN]), int(number[CLOSE])
        scale = [DECAY ** (b + 1) * self.UNIT for b in range(SPAN + 1)]
        sums = np.zeros((SPAN + 1, m + 1), np.int64)
        for lo in range(0, m, SLICE):
            x = c[lo + SPAN:min(lo + SLICE, m) + 2 * SPAN]
            size = len(x) - SPAN
            total = np.zeros((SPAN + 1, size))
            for a in range(1, SPAN):
                pair = (x[:size] * k + x[a:a + size]) * k
                for b in range(a + 1, SPAN + 1):
                    total[b] += table.take(pair + x[b:b + size])
            for b in range(2, SPAN + 1):
                sums[b, lo + 1:lo + 1 + size] = np.rint(total[b] * scale[b])
        self.inner = {b: np.cumsum(sums[b]) for b in range(2, SPAN + 1)}
        # a run's opening lies before its first letter, its close after its last
        self.heads, self.tails = np.zeros((SPAN + 1, n), np.int64), np.zeros((SPAN + 1, n), np.int64)
        for b in range(2, SPAN + 1):
            head, tail = np.zeros(n), np.zeros(n)
            for a in range(1, b):
                head += table.take((self.open * k + c[at + SPAN + a - 1]) * k + c[at + SPAN + b - 1])
                tail += table.take((c[at + SPAN - b] * k + c[at + SPAN - b + a]) * k + self.close)
            self.heads[b] = self.heads[b - 1] + np.rint(head * scale[b]).astype(np.int64)
            self.tails[b] = self.tails[b - 1] + np.rint(tail * scale[b]).astype(np.int64)
        size = np.arange(MAX_BYTES + 1)
        self.norms = np.sqrt(np.maximum(sum(np.maximum(size + 2 - b, 0) * DECAY ** (2 * (b + 1)) for _, b in OFFSETS), DECAY ** 6))

    def values(self, first: np.ndarray, size) -> np.ndarray:
        """Values of the runs of ``size`` words from ``first``."""
        out = np.empty(len(first))
        for lo in range(0, len(first), SLICE):
            w = first[lo:lo + SLICE]
            end = w + (size if np.isscalar(size) else size[lo:lo + SLICE])
            s, e = self.at[w], self.at[end]
            length = e - s
            near = np.minimum(length, SPAN)
            total = self.heads[near, w] + self.tails[near, end]
            for b, sums in self.inner.items():
                total += sums[np.maximum(e - b, s)] - sums[s]
            short = np.flatnonzero((length > 0) & (length < SPAN))  # one triple from the opening to the close
            for a in range(1, SPAN):
                i = short[length[short] >= a]
                whole = self.table[(self.open * self.k + self.code[s[i] + a - 1 + SPAN]) * self.k + self.close]
                total[i] += np.rint(whole * (DECAY ** (length[i] + 2.0) * self.UNIT)).astype(np.int64)
            out[lo:lo + SLICE] = total / self.UNIT / self.norms[length] + self.bias
        return out


def parts(word: bytes) -> list[bytes]:
    """Parts of a word longer than MAX_BYTES; those of one piece overlap."""
    out = []
    for piece in _SIGNS.split(word):
        if len(piece) > MAX_BYTES:
            for size in PART_SIZES:
                out += [piece[a:a + size] for a in range(0, len(piece) - size, size // 4)] + [piece[-size:]]
        elif piece:
            out.append(piece)
    return out


class Tokens:
    """Words of a block with those over MAX_BYTES replaced by their parts:
    ``first``, ``index`` and ``distinct`` as in ``Words``."""

    def __init__(self, column):
        words = Words(column, lower=True)
        self.n_docs, self.first, self.index, self.distinct = words.n_docs, words.first, words.index, words.distinct
        n = len(self.distinct)
        length = np.diff(np.frombuffer(self.distinct.buffers()[1], np.int64)[:n + 1]) if n else np.zeros(0, np.int64)
        if not (length > MAX_BYTES).any():
            return
        long = length > MAX_BYTES
        cut = [parts(w) for w in self.distinct.filter(pa.array(long)).to_pylist()]
        size, start = np.ones(n, np.int64), np.cumsum(~long) - 1
        size[long] = [len(x) for x in cut]
        start[long] = n - len(cut) + np.cumsum(size[long]) - size[long]  # parts follow the other words
        coded = pa.concat_arrays([self.distinct.filter(pa.array(~long)),
                                  pa.array([x for c in cut for x in c], pa.large_binary())]).dictionary_encode()
        many = size[self.index]
        end = np.concatenate([[0], np.cumsum(many)])
        at = np.repeat(start[self.index] - end[:-1], many) + np.arange(end[-1])
        self.index = coded.indices.to_numpy()[at] if len(at) else np.zeros(0, np.int32)
        self.distinct, self.first = coded.dictionary, end[self.first]

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), self.counts())


class Windows:
    """Runs of words of one document that are read as one unit: ``first`` and
    ``size`` are their words (occurrences), ``key`` a hash (none unless ``hashed``)."""

    def __init__(self, words: Tokens, hashed: bool = True):
        self.doc = words.doc_of()
        stream = words.distinct.take(pa.array(words.index)) if len(words.index) else words.distinct
        self.bounds = np.frombuffer(stream.buffers()[1], np.int64)[stream.offset:stream.offset + len(stream) + 1]
        self.data = np.frombuffer(stream.buffers()[2], np.uint8)
        length, n = np.diff(self.bounds), len(stream)
        if hashed:
            hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words.distinct.to_pylist()), np.uint64,
                                 len(words.distinct))[words.index]
        long = np.concatenate([[0], np.cumsum(length > SHORT)])
        first, size, key = [], [], []
        for k in (*WINDOWS, *SHORT_WINDOWS):
            if k > n:
                break
            ok = (self.doc[k - 1:] == self.doc[:n - k + 1]) & (self.bounds[k:] - self.bounds[:n - k + 1] <= MAX_BYTES)
            if k in SHORT_WINDOWS:
                ok &= long[k:] == long[:n - k + 1]
            at = np.flatnonzero(ok)
            if not len(at):
                continue
            first.append(at)
            size.append(np.full(len(at), k))
            if hashed:
                key.append(window_hashes(hashes, k, _FACTOR + 2 * k)[at])
        self.first, self.size = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (first, size))
        self.key = np.concatenate(key) if key else np.zeros(0, np.uint64)

    def keep(self, which: np.ndarray) -> None:
        self.first, self.size = self.first[which], self.size[which]
        self.key = self.key[which] if len(self.key) else self.key

    def units(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and bounds of some windows, without the spaces between words."""
        start = self.bounds[self.first[at]]
        length = self.bounds[self.first[at] + self.size[at]] - start
        bounds = np.concatenate([[0], np.cumsum(length)])
        return self.data[np.repeat(start - bounds[:-1], length) + np.arange(bounds[-1])], bounds

    def texts(self, at: np.ndarray) -> pa.Array:
        data, bounds = self.units(at)
        return pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(bounds), pa.py_buffer(data)])

    def peaks(self, value: np.ndarray) -> np.ndarray:
        """Windows with the highest value, the first of equals, wherever they overlap others."""
        order = np.lexsort((self.first, -value))
        taken = np.zeros(len(self.doc), bool)
        out = []
        for w in order.tolist():
            a = int(self.first[w])
            b = a + int(self.size[w])
            if not taken[a:b].any():
                taken[a:b] = True
                out.append(w)
        return np.array(out, np.int64)


def document_values(column, machine: Machine) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best and second best unit value of each text, and its number of positive
    units: its words, and its windows without a positive word (of overlapping
    ones the best; of a text without positive windows only the best)."""
    words = Tokens(column)
    n = words.n_docs
    best, second, positive = np.full(n, machine.bias), np.full(n, machine.bias), np.zeros(n)
    if len(words.index):
        doc = words.doc_of()
        windows = Windows(words, hashed=False)
        stream = Stream(windows.data[windows.bounds[0]:windows.bounds[-1]], windows.bounds, machine)
        value = stream.values(np.arange(len(doc)), 1)
        high = np.concatenate([[0], np.cumsum(value > 0)])
        windows.keep(high[windows.first + windows.size] == high[windows.first])
        if len(windows.first):
            of, more = doc[windows.first], stream.values(windows.first, windows.size)
            top = np.full(n, -np.inf)
            np.maximum.at(top, of, more)
            top_at = np.flatnonzero((more == top[of]) & (top[of] <= 0))
            top_at = top_at[np.unique(of[top_at], return_index=True)[1]]
            windows.keep(at := np.flatnonzero(more > 0))
            at = np.concatenate([top_at, at[windows.peaks(more[at])]])
            value, doc = np.concatenate([value, more[at]]), np.concatenate([doc, of[at]])
        positive = np.bincount(doc, weights=value > 0, minlength=n)
        order = np.argsort(doc, kind="stable")
        value, doc = value[order], doc[order]
        start = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        full, size = doc[start], np.diff(np.append(start, len(doc)))
        highest = np.maximum.reduceat(value, start)
        best[full] = np.maximum(machine.bias, highest)
        at = np.flatnonzero(value == np.repeat(highest, size))
        value[at[np.unique(doc[at], return_index=True)[1]]] = -np.inf
        second[full] = np.maximum(machine.bias, np.maximum.reduceat(value, start))
    return best, second, positive


def features(best, second, positive) -> np.ndarray:
    return np.column_stack([best, second, np.log1p(positive), np.ones(len(best))])


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by damped Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + 1e-2 * w
        hess = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return w


def training_rows(docs: DataFrame, labels: DataFrame, held_out: Column, label: str) -> DataFrame:
    """(t, y): at most about MAX_TRAIN_DOCS labelled texts outside the held-out part."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out)
             .groupBy(F.col("doc_id").alias("k")).agg(F.max((F.col(label) == 1).cast("int")).alias("y")))
    n = max(known.count(), 1)
    picked = known.where(F.pmod(F.xxhash64("k", F.lit(11)), F.lit(n)) < MAX_TRAIN_DOCS)
    # The sample is bounded, so it can be sent to all tasks; equal texts count once.
    return docs.join(F.broadcast(picked), "k").groupBy("t").agg(F.max("y").alias("y"))


def _held_by(words: Tokens, windows: Windows, values: pa.Array) -> np.ndarray:
    """(document, number) pairs of the values that are words or windows of a block, distinct."""
    found = pc.fill_null(pc.index_in(words.distinct, value_set=values), -1).to_numpy()[words.index]
    doc = words.doc_of()
    _, at, back = np.unique(windows.key, return_index=True, return_inverse=True)
    more = pc.fill_null(pc.index_in(windows.texts(at), value_set=values), -1).to_numpy()[back]
    doc, found = np.concatenate([doc, doc[windows.first]]), np.concatenate([found, more]).astype(np.int64)
    return np.unique(doc[found >= 0] * len(values) + found[found >= 0])


def phrases(train: DataFrame, ratio: float) -> list[bytes]:
    """Windows that toxic documents have and clean ones lack, the most frequent first."""
    def windows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "t", PART_BYTES):
                words = Tokens(block.column("t"))
                if not len(words.index):
                    continue
                windows = Windows(words)
                _, at, back = np.unique(windows.key, return_index=True, return_inverse=True)
                pair = np.unique(words.doc_of()[windows.first] * max(len(at), 1) + back)
                yield pa.RecordBatch.from_arrays(
                    [windows.texts(at).cast(pa.binary()),
                     pa.array(np.bincount(pair % max(len(at), 1), minlength=len(at)))], ["word", "toxic"])

    frequent = (train.where("y = 1").mapInArrow(windows_of, "word binary, toxic long").groupBy("word")
                .agg(F.sum("toxic").alias("toxic")).where(F.col("toxic") >= LEAST_TOXIC_DOCS)
                .orderBy(F.desc("toxic"), "word").limit(MAX_PHRASES).collect())
    if not frequent:
        return []
    value_set = pa.array([bytes(r["word"]) for r in frequent], pa.large_binary())

    def clean_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "t", PART_BYTES):
                words = Tokens(block.column("t"))
                if len(words.index):
                    number, n = np.unique(_held_by(words, Windows(words), value_set) % len(value_set), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(n)], ["number", "n"])

    clean = {r["number"]: r["n"] for r in train.where("y = 0").mapInArrow(clean_counts, "number long, n long")
             .groupBy("number").agg(F.sum("n").alias("n")).collect()}
    return [bytes(r["word"]) for k, r in enumerate(frequent) if r["toxic"] >= clean.get(k, 0) * ratio][:MAX_WORDS]


def word_counts(train: DataFrame) -> DataFrame:
    """(word, toxic, clean): documents of each class with the word, and with
    one in SAMPLE windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "t", PART_BYTES):
                words = Tokens(block.column("t"))
                if not len(words.index):
                    continue
                n = len(words.distinct)
                pair = np.unique(words.doc_of() * n + words.index)
                y = block.column("y").to_numpy()[pair // n]
                toxic = np.bincount(pair % n, weights=y, minlength=n).astype(np.int64)
                every = np.bincount(pair % n, minlength=n)
                yield pa.RecordBatch.from_arrays([words.distinct.cast(pa.binary()), pa.array(toxic),
                                                  pa.array(every - toxic)], ["word", "toxic", "clean"])
                windows = Windows(words)
                windows.keep(windows.key % np.uint64(SAMPLE) == 0)
                _, at, back = np.unique(windows.key, return_index=True, return_inverse=True)
                if len(at):
                    pair = np.unique(words.doc_of()[windows.first] * len(at) + back)
                    y = block.column("y").to_numpy()[pair // len(at)]
                    toxic = np.bincount(pair % len(at), weights=y, minlength=len(at)).astype(np.int64)
                    every = np.bincount(pair % len(at), minlength=len(at))
                    yield pa.RecordBatch.from_arrays([windows.texts(at).cast(pa.binary()), pa.array(toxic),
                                                      pa.array(every - toxic)], ["word", "toxic", "clean"])

    return (train.mapInArrow(run, "word binary, toxic long, clean long").groupBy("word")
            .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def explaining(train: DataFrame, candidates: list[bytes]) -> list[bytes]:
    """Candidates chosen by greedy cover of the toxic documents, best first."""
    value_set = pa.array(candidates, pa.large_binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "t", PART_BYTES):
                words = Tokens(block.column("t"))
                pair = _held_by(words, Windows(words), value_set) if len(words.index) else np.zeros(0, np.int64)
                cut = np.searchsorted(pair, np.arange(words.n_docs + 1) * len(value_set))
                yield pa.RecordBatch.from_arrays([pa.array(
                    [(pair[a:b] % len(value_set)).tolist() for a, b in zip(cut[:-1], cut[1:])],
                    pa.list_(pa.int32()))], ["found"])

    rows = [r["found"] for r in train.where("y = 1").mapInArrow(run, "found array<int>").collect()]
    holders: list[list[int]] = [[] for _ in candidates]
    for d, found in enumerate(rows):
        for w in found:
            holders[w].append(d)
    need = [UNITS_PER_DOC] * len(rows)
    least = max(LEAST_TOXIC_DOCS, LEAST_GAIN * len(rows))
    gain = [len(h) for h in holders]
    chosen = []
    while gain:
        w = max(range(len(gain)), key=lambda k: (gain[k], -k))
        if gain[w] < least:
            break
        chosen.append(candidates[w])
        for d in holders[w]:
            if need[d] > 0:
                need[d] -= 1
                if need[d] == 0:
                    for x in rows[d]:
                        gain[x] -= 1
        gain[w] = 0
    return chosen


def _collect_values(words: DataFrame, machine: Machine, top: int) -> list[bytes]:
    """Clean words with the highest values."""
    shared = words.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = batch.column("word").to_pylist()
            if w:
                yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(shared.value.values(units_of(w)))],
                                                 ["word", "value"])

    rows = (words.select("word").mapInArrow(run, "word binary, value double")
            .orderBy(F.desc("value"), "word").limit(top).collect())
    return [bytes(r["word"]) for r in rows]


class Model:
    def __init__(self, machine: Machine | None, weights: np.ndarray | None):
        self.machine, self.weights = machine, weights

    def scores(self, column) -> np.ndarray:
        if self.machine is None:
            return np.zeros(len(column))
        x = features(*document_values(column, self.machine))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "toxic", id_col: str = "doc_id",
        text_col: str = "text") -> Model:
    """Fits the model; ``held_out`` is an expression over labels' doc_id."""
    from featureforge.llm.scratch import Scratch
    scratch = Scratch(docs.sparkSession, "toxicity")
    keyed = docs.select(F.col(id_col).alias("k"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    train = scratch.table(training_rows(keyed, labels, held_out, label), "train")
    n = {r["y"]: r["n"] for r in train.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return Model(None, None)
    words = scratch.table(word_counts(train), "words")
    ratio = F.lit(LEAST_RATIO * n[1] / n[0])
    marks = words.where((F.col("toxic") >= LEAST_TOXIC_DOCS) & (F.col("toxic") >= F.col("clean") * ratio))
    positive = [bytes(r["word"]) for r in marks.orderBy(F.desc("toxic"), "word").limit(MAX_WORDS).collect()]
    positive = explaining(train, list(dict.fromkeys(positive + phrases(train, LEAST_RATIO * n[1] / n[0]))))
    if not positive:
        return Model(None, None)
    clean = words.where((F.col("clean") > 0) & (F.col("toxic") < F.col("clean") * ratio))
    common = [bytes(r["word"]) for r in clean.orderBy(F.desc("clean"), "word").limit(MAX_WORDS // 3).collect()]
    other = [bytes(r["word"]) for r in clean.orderBy(F.xxhash64("word")).limit(MAX_WORDS).collect()]
    negative = list(dict.fromkeys(common + other))
    landmarks = positive[:POSITIVE_LANDMARKS] + negative[:NEGATIVE_LANDMARKS]
    machine = Machine(positive, negative, landmarks)
    close = _collect_values(clean, machine, MAX_WORDS)
    negative = list(dict.fromkeys(close + negative))
    landmarks = positive[:POSITIVE_LANDMARKS] + negative[:NEGATIVE_LANDMARKS]
    machine = Machine(positive, negative, landmarks)
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "t", PART_BYTES):
                best, second, positive = document_values(block.column("t"), shared.value)
                yield pa.RecordBatch.from_arrays([block.column("y"), pa.array(best), pa.array(second), pa.array(positive)],
                                                 ["y", "best", "second", "positive"])

    rows = train.mapInArrow(run, "y int, best double, second double, positive double").collect()
    found = np.array(rows, np.float64)
    return Model(machine, fit_logistic(features(found[:, 1], found[:, 2], found[:, 3]), found[:, 0]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``score`` and ``predicted`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "t", PART_BYTES):
                s = shared.value.scores(block.column("t"))
                yield pa.RecordBatch.from_arrays([block.column("k"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                                 ["k", "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t"))
            .mapInArrow(run, f"k {kind}, score double, predicted int").withColumnRenamed("k", id_col))


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, text_col, PART_BYTES):
                yield block.filter(pa.array(shared.value.scores(block.column(text_col)) < 0.5))

    return docs.mapInArrow(run, docs.schema)
