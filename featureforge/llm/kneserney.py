"""Interpolated modified Kneser-Ney bigram scores, counted in Spark.

Texts are compiled once into chunks: the chunk's distinct word hashes (most
frequent first) and one local number per token.  A chunk then asks for what it
needs instead of loading the whole model:

1. every chunk sends its distinct word pairs and their training counts to the
   pair shards, which add the counts up, answer each chunk in the order asked,
   and pass on per first word its total and its pairs seen once, twice and
   more often, and per second word the number of its distinct predecessors;
2. every chunk sends its distinct words to the word shards, which add up the
   words' counts and those partial sums and answer likewise;
3. each chunk stores the answers as sorted hash arrays in a file that its
   worker maps into memory, and scores its documents by lookups.

Pairs are sharded by their first word; first words that make up a large share
of any chunk (``HOT_SHARE``) are spread over all shards by the whole pair.  A
shard's work is proportional to the text over the number of shards, which
follows the input.  Nothing but the list of hot words (at most ``HOT_WORDS``)
and a dozen totals passes the driver.

Model: p(w|v) = max(c(vw) - D, 0) / c(v) + g(v) p(w), with D by count (1, 2, 3
or more); p(w) likewise over the number of distinct predecessors, interpolated
with 1 / (V + 1).  Texts begin after a start mark and finish with an end token.

Defined cases: a null or empty text is the end token alone; an empty training
set scores every token with the uniform probability; repeated rows count as
often as they occur; extra columns are ignored.
"""

from __future__ import annotations

import contextlib
import math
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureforge.llm.scratch import Scratch, text_bytes
from featureforge.llm.words import Words, blocks, mix, release_memory

#: Tokens of a chunk (a longer document is a chunk of its own).
CHUNK_TOKENS = 3 << 19
#: Text bytes per shard.
SHARD_BYTES = 12 << 20
#: A first word with this share of a chunk's tokens is spread over all shards.
HOT_SHARE = 1 / 512
HOT_WORDS = 1 << 16

END = np.uint64(0xE4D)
START = np.uint64(0x57A47)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_LOW48 = np.uint64((1 << 48) - 1)

_PART = "kind int, shard int, chunk long, a binary, b binary, c binary, d binary, e binary, f binary"


def pack(values: np.ndarray) -> bytes:
    """Numbers below 2^32, byte planes apart, compressed."""
    planes = np.ascontiguousarray(values, np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()
    return np.uint32(len(values)).tobytes() + pa.compress(planes, "zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, np.uint32, 1)[0])
    planes = pa.decompress(data[4:], 4 * n, "zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, n).T).view(np.uint32).ravel()


def pack48(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack48(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def compiled(docs: DataFrame) -> DataFrame:
    """Chunks of documents (columns k, t, held): ids, token counts, held-out
    flags, word hashes by frequency, and the token stream."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(number: int):
            vocabulary, back = np.unique(np.concatenate([END[None], *(h for h, _ in held)]), return_inverse=True)
            sizes = np.cumsum([1] + [len(h) for h, _ in held])
            stream = np.concatenate([np.append(back[a:b], back[0])[np.where(i < 0, b - a, i)]
                                     for a, b, (_, i) in zip(sizes[:-1], sizes[1:], held)])
            order = np.argsort(-np.bincount(stream, minlength=len(vocabulary)), kind="stable")
            place = np.zeros(len(order), np.int64)
            place[order] = np.arange(len(order))
            return pa.RecordBatch.from_arrays(
                [pa.array([(TaskContext.get().partitionId() << 24) + number]),
                 pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(pa.int64())),
                 pa.array([pack(np.concatenate(counts))], pa.binary()),
                 pa.array([np.concatenate(flags).tobytes()], pa.binary()),
                 pa.array([vocabulary[order].tobytes()], pa.binary()),
                 pa.array([pack(place[stream])], pa.binary())],
                ["chunk", "ids", "tokens", "held", "vocabulary", "stream"])

        held, ids, counts, flags, n, number = [], [], [], [], 0, 0
        for batch in batches:
            for block in blocks(batch, "t"):
                words = Words(block.column("t"), lower=True)
                h = mix(np.append(words.hashes(), np.uint64(0)))[:-1]
                distinct, index = np.unique(h, return_inverse=True)
                stream = np.insert(index, words.first[1:], -1)  # an end after each document
                held.append((distinct, stream))
                ids.append(block.column("k"))
                counts.append(words.counts() + 1)
                flags.append(block.column("held").to_numpy(zero_copy_only=False))
                n += len(stream)
                if n >= CHUNK_TOKENS:
                    yield flush(number)
                    held, ids, counts, flags, n, number = [], [], [], [], 0, number + 1
        if held:
            yield flush(number)

    return docs.mapInArrow(run, "chunk long, ids array<long>, tokens binary, held binary, vocabulary binary, "
                                "stream binary")


class Chunk:
    """A compiled chunk and the requests it makes."""

    def __init__(self, vocabulary: bytes, stream: bytes, tokens: bytes, held: bytes, shards: int, hot: np.ndarray):
        self.words = np.frombuffer(vocabulary, np.uint64)
        self.stream = unpack(stream).astype(np.int64)
        self.tokens = unpack(tokens).astype(np.int64)
        self.held = np.frombuffer(held, bool)
        self.first = np.concatenate([[0], np.cumsum(self.tokens)[:-1]]).astype(np.int64)
        self.shards = shards
        n = len(self.words)
        before = np.empty_like(self.stream)
        before[1:] = self.stream[:-1]
        before[self.first] = n  # the start mark
        train = np.repeat(~self.held, self.tokens)
        key = before * n + self.stream
        order = np.argsort(key, kind="stable")
        new = np.ones(len(key), bool)
        new[1:] = key[order][1:] != key[order][:-1]
        self.pair_of = np.empty(len(key), np.int64)
        self.pair_of[order] = np.cumsum(new) - 1
        pair = key[order][new]
        self.v, self.w = pair // n, pair % n
        self.pair_count = np.bincount(self.pair_of, weights=train, minlength=len(pair)).astype(np.int64)
        self.word_count = np.bincount(self.stream, weights=train, minlength=n).astype(np.int64)
        low = np.append(self.words, START) & _LOW48
        self.low = low
        whole = mix(low[self.v] * _FACTOR + low[self.w])
        self.pair_hash = whole
        by = np.where(np.isin(low[self.v], hot), whole, mix(low[self.v] + _FACTOR))
        shard = ((by >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)
        self.pair_order = np.argsort(shard, kind="stable")
        self.pair_cut = np.searchsorted(shard[self.pair_order], np.arange(shards + 1))
        shard = word_shard(low, shards)
        self.word_order = np.lexsort((low, shard))
        self.word_cut = np.searchsorted(shard[self.word_order], np.arange(shards + 1))


def word_shard(low: np.ndarray, shards: int) -> np.ndarray:
    return ((mix(low) >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)


def _rows(found: list[dict]) -> pa.RecordBatch:
    names = ["kind", "shard", "chunk", "a", "b", "c", "d", "e", "f"]
    kinds = [pa.int32(), pa.int32(), pa.int64()] + [pa.binary()] * 6
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in found], t) for n, t in zip(names, kinds)], names)


def _groups(ordered: np.ndarray) -> np.ndarray:
    """Starts of the stretches of equal values."""
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(new)


def _spectrum(counts: np.ndarray) -> bytes:
    """How many counts are 1, 2, 3 and 4, how many positive, and their sum."""
    return np.array([*(int((counts == k).sum()) for k in (1, 2, 3, 4)), int((counts > 0).sum()),
                     int(counts.sum())], np.int64).tobytes()


def _parts(low: np.ndarray, columns: list[np.ndarray], kind: int, shards: int) -> Iterator[dict]:
    """Sums per word (48-bit hashes, distinct) for the word shards."""
    shard = word_shard(low, shards)
    order = np.lexsort((low, shard))
    cut = np.searchsorted(shard[order], np.arange(shards + 1))
    for s in range(shards):
        at = order[cut[s]:cut[s + 1]]
        if len(at):
            yield {"kind": kind, "shard": s, "a": pack48(low[at]), **dict(zip("bcde", (pack(c[at]) for c in columns)))}


# Kinds of rows: requests, partial sums, answers and totals.
PAIRS, WORDS, CONTEXTS, FOLLOWERS, PAIR_ANSWER, WORD_ANSWER, PAIR_TOTALS, WORD_TOTALS = range(8)


def _one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows as dictionaries, one at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


@contextlib.contextmanager
def _room():
    """Gives memory back when a chunk is done, so that idle workers stay small."""
    try:
        yield
    finally:
        release_memory()


def pair_requests(chunks: DataFrame, shards: int, hot: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _one_by_one(batches):
            with _room():
                c = Chunk(r["vocabulary"], r["stream"], r["tokens"], r["held"], shards, hot)
                for s in range(shards):
                    at = c.pair_order[c.pair_cut[s]:c.pair_cut[s + 1]]
                    if len(at):
                        start = _groups(c.v[at])
                        yield _rows([{"kind": PAIRS, "shard": s, "chunk": r["chunk"],
                                      "a": pack48(c.low[c.v[at[start]]]), "b": pack(np.diff(np.append(start, len(at)))),
                                      "c": pack48(c.low[c.w[at]]), "d": pack(c.pair_count[at])}])
                del c

    return chunks.drop("ids").mapInArrow(run, _PART)


def word_requests(chunks: DataFrame, shards: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _one_by_one(batches):
            with _room():
                c = Chunk(r["vocabulary"], r["stream"], r["tokens"], r["held"], shards, np.zeros(0, np.uint64))
                for s in range(shards):
                    at = c.word_order[c.word_cut[s]:c.word_cut[s + 1]]
                    if len(at):
                        words = np.append(c.words, START)[at]
                        yield _rows([{"kind": WORDS, "shard": s, "chunk": r["chunk"], "a": words.tobytes(),
                                      "b": pack(np.append(c.word_count, 0)[at])}])
                del c

    return chunks.drop("ids").mapInArrow(run, _PART)


def add_pairs(shards: int):
    """Reducer of a pair shard."""
    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = table.to_pylist()
        v = np.concatenate([np.repeat(unpack48(r["a"]), unpack(r["b"])) for r in rows])
        w = np.concatenate([unpack48(r["c"]) for r in rows])
        n = np.concatenate([unpack(r["d"]) for r in rows])
        asked = [(r["shard"], r["chunk"], len(r["c"]) // 6) for r in rows]
        del rows
        h = mix(v * _FACTOR + w)
        order = np.argsort(h, kind="stable")
        start = _groups(h[order])
        total = np.add.reduceat(n[order], start, dtype=np.int64)
        of = np.empty(len(h), np.int32)
        of[order] = np.repeat(np.arange(len(start), dtype=np.int32), np.diff(np.append(start, len(h))))
        del n, h
        v, w = v[order[start]], w[order[start]]
        del order, start
        at = 0
        for shard, chunk, size in asked:
            yield {"kind": PAIR_ANSWER, "shard": shard, "chunk": chunk, "a": pack(total[of[at:at + size]])}
            at += size
        del of
        yield {"kind": PAIR_TOTALS, "shard": asked[0][0], "a": _spectrum(total)}
        seen = total > 0
        v, w, total = v[seen], w[seen], total[seen]
        by = np.argsort(v, kind="stable")
        cut = _groups(v[by])
        if len(cut):
            sums = [np.add.reduceat(x[by].astype(np.int64), cut) for x in (total, total == 1, total == 2, total > 2)]
            yield from _parts(v[by][cut], sums, CONTEXTS, shards)
            by = np.argsort(w, kind="stable")
            cut = _groups(w[by])
            yield from _parts(w[by][cut], [np.diff(np.append(cut, len(w)))], FOLLOWERS, shards)

    return _reducer(run)


def _reducer(run):
    def each(table: pa.Table) -> pa.Table:
        made = pa.Table.from_batches([_rows([r]) for r in run(table)])  # answers leave Python one by one
        release_memory()
        return made
    return each


def add_words(table: pa.Table) -> Iterator[dict]:
    """Reducer of a word shard; answers to pair requests pass through."""
    rows = table.to_pylist()
    asked = [r for r in rows if r["kind"] == WORDS]
    yield from (r for r in rows if r["kind"] in (PAIR_ANSWER, PAIR_TOTALS))
    if not asked:
        return
    full = [np.frombuffer(r["a"], np.uint64) for r in asked]
    words, back = np.unique(np.concatenate(full), return_inverse=True)
    count = np.bincount(back, weights=np.concatenate([unpack(r["b"]) for r in asked]), minlength=len(words)).astype(np.int64)
    low = words & _LOW48
    order = np.argsort(low, kind="stable")
    sums = np.zeros((5, len(words)), np.int64)  # context total, pairs seen once, twice, more often; predecessors
    for r in rows:
        if r["kind"] in (CONTEXTS, FOLLOWERS):
            at = order[np.searchsorted(low[order], unpack48(r["a"]))]
            for k, name in ((0, "b"), (1, "c"), (2, "d"), (3, "e")) if r["kind"] == CONTEXTS else ((4, "b"),):
                np.add.at(sums[k], at, unpack(r[name]).astype(np.int64))
    first = 0
    for r, own in zip(asked, full):
        at = back[first:first + len(own)]
        first += len(own)
        yield {"kind": WORD_ANSWER, "shard": r["shard"], "chunk": r["chunk"], "a": pack(count[at]),
               **{name: pack(sums[k][at]) for k, name in enumerate("bcdef")}}
    real = words != START
    yield {"kind": WORD_TOTALS, "shard": asked[0]["shard"], "a": _spectrum(count[real]), "b": _spectrum(sums[4][real])}


def discounts(spectrum: np.ndarray) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more, from how many counts are 1 to 4."""
    n = [float(x) for x in spectrum[:4]]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    d = [0.0]
    for k in (1, 2, 3):
        fixed = k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else y
        d.append(min(max(fixed, 0.0), float(k)))
    return np.array(d)


class HashArrays:
    """Sorted 64-bit hashes and their values in a file mapped into memory."""

    def __init__(self, hashes: np.ndarray, values: dict[str, np.ndarray]):
        order = np.argsort(hashes, kind="stable")
        self.path = tempfile.mkdtemp(prefix="kneserney-")
        self.files = []
        self.hashes = self._map("hashes", hashes[order])
        self.values = {k: self._map(k, v[order]) for k, v in values.items()}

    def _map(self, name: str, data: np.ndarray) -> np.ndarray:
        path = os.path.join(self.path, name)
        data.tofile(path)
        self.files.append(path)
        return np.memmap(path, data.dtype, "r", shape=data.shape) if len(data) else data

    def find(self, hashes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.hashes, hashes)

    def close(self) -> None:
        for path in self.files:
            os.remove(path)
        os.rmdir(self.path)


def word_probability(predecessors: np.ndarray, spectrum: np.ndarray, n_words: int) -> np.ndarray:
    """p(w) from numbers of distinct predecessors."""
    d = discounts(spectrum)
    total, uniform = float(spectrum[5]), 1.0 / (n_words + 1)
    if total == 0:
        return np.full(len(predecessors), uniform)
    more = float(spectrum[4] - spectrum[0] - spectrum[1])
    rest = (d[1] * spectrum[0] + d[2] * spectrum[1] + d[3] * more) / total
    own = np.maximum(predecessors - d[np.minimum(predecessors, 3)], 0) / total
    return own + rest * uniform


def scorer(shards: int, hot: np.ndarray, totals: dict[str, np.ndarray]):
    """Scores the documents of one chunk from its answers."""
    pair_spectrum, word_spectrum, pred_spectrum = totals["pairs"], totals["words"], totals["predecessors"]
    d = discounts(pair_spectrum)
    n_train, n_words = int(word_spectrum[5]), int(word_spectrum[4])

    def run(table: pa.Table) -> pa.Table:
        with _room():
            return scored(table)

    def scored(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        own = next(r for r in rows if r["kind"] is None)
        c = Chunk(own["vocabulary"], own["stream"], own["tokens"], own["held"], shards, hot)
        pair_total = np.zeros(len(c.v), np.int64)
        words = np.zeros((6, len(c.low)), np.int64)
        for r in rows:
            if r["kind"] == PAIR_ANSWER:
                pair_total[c.pair_order[c.pair_cut[r["shard"]]:c.pair_cut[r["shard"] + 1]]] = unpack(r["a"])
            elif r["kind"] == WORD_ANSWER:
                at = c.word_order[c.word_cut[r["shard"]]:c.word_cut[r["shard"] + 1]]
                for k, name in enumerate("abcdef"):
                    words[k, at] = unpack(r[name])
        low = word_probability(words[5], pred_spectrum, n_words)
        context = words[1].astype(np.float64)
        seen = context > 0
        back = np.ones(len(context))
        back[seen] = (d[1] * words[2] + d[2] * words[3] + d[3] * words[4])[seen] / context[seen]
        model = HashArrays(c.pair_hash, {"count": pair_total})
        try:
            count = model.values["count"][model.find(c.pair_hash)]
            top = np.maximum(count - d[np.minimum(count, 3)], 0) / np.where(seen, context, 1)[c.v]
            log_pair = np.log10(np.where(seen[c.v], top, 0) + back[c.v] * low[c.w])
        finally:
            model.close()
        score = np.add.reduceat(log_pair[c.pair_of], c.first)
        base = np.add.reduceat(np.log10((words[0][c.stream] + 1) / (n_train + n_words + 1)), c.first)
        known = np.add.reduceat((words[0][c.stream] > 0).astype(np.int64), c.first)
        return pa.table({"k": pa.array(own["ids"], pa.int64()), "held_out": pa.array(c.held), "n_tokens": pa.array(c.tokens),
                         "n_known": pa.array(known), "train_tokens": pa.array(np.full(len(known), n_train)),
                         "base_score": pa.array(base), "score": pa.array(score)})

    return run


def hot_words(chunks: DataFrame) -> np.ndarray:
    """48-bit hashes of first words to spread (and the start mark)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for v, s in zip(batch.column("vocabulary").to_pylist(), batch.column("stream").to_pylist()):
                words, stream = np.frombuffer(v, np.uint64), unpack(s)
                n = np.bincount(stream, minlength=len(words))
                at = np.flatnonzero(n >= max(len(stream) * HOT_SHARE, 2))
                yield pa.RecordBatch.from_arrays([pa.array((words[at] & _LOW48).astype(np.int64)), pa.array(n[at])],
                                                 ["w", "n"])

    rows = (chunks.select("vocabulary", "stream").mapInArrow(run, "w long, n long").groupBy("w")
            .agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "w").limit(HOT_WORDS).collect())
    return np.array([r["w"] for r in rows] + [int(START)], np.uint64)


def language_scores(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` and ``score`` (log10 probability of the text) of every
    document; documents with ``held_out`` train nothing."""
    scratch = Scratch(docs.sparkSession, "kneserney")
    keyed = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).alias("t"),
                        F.coalesce(held_out, F.lit(False)).alias("held"))
    shards = text_bytes(keyed, "t") // SHARD_BYTES + 1
    chunks = scratch.table(compiled(keyed), "chunks")
    hot = hot_words(chunks)
    answered = pair_requests(chunks, shards, hot).groupBy("shard").applyInArrow(add_pairs(shards), _PART)
    answers = scratch.table(answered.unionByName(word_requests(chunks, shards)).groupBy("shard")
                            .applyInArrow(_reducer(add_words), _PART), "answers")
    totals = {k: np.zeros(6, np.int64) for k in ("pairs", "words", "predecessors")}
    for r in answers.where(F.col("kind").isin(PAIR_TOTALS, WORD_TOTALS)).select("kind", "a", "b").toLocalIterator():
        for name, data in (("pairs", r["a"]),) if r["kind"] == PAIR_TOTALS else (("words", r["a"]), ("predecessors", r["b"])):
            totals[name] += np.frombuffer(data, np.int64)
    replies = answers.where(F.col("kind").isin(PAIR_ANSWER, WORD_ANSWER))
    together = chunks.unionByName(replies, allowMissingColumns=True)
    return (together.groupBy("chunk").applyInArrow(
        scorer(shards, hot, totals), "k long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                                     "base_score double, score double").withColumnRenamed("k", id_col))
