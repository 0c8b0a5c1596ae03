"""Substring deduplication with a count-min prefilter.

A window is ``size`` consecutive words.  Every word covered by a window that
also starts in a document with a smaller id is removed.

1. Each task counts its windows into sketch cells (``DEPTH`` rows of cells; a
   cell counts the documents with a window in it, 0, 1 or more) and emits its
   non-empty cells; the partition sketches are merged cell by cell.  A merged
   cell can only overestimate, so a window whose cells do not all say "two or
   more" occurs in one document only.
2. A second pass groups the other windows exactly, by 95-bit hashes.  A task
   decides what it can on its own: of the documents that share a window there,
   all but the smallest are settled at once, so a window sends at most one
   document per task chunk however often it occurs.  The smallest id per
   window settles the rest.
3. Merged runs of removed windows are joined back and the kept words put out.

The sketch has about two cells per window, up to ``MAX_CELLS``; beyond that it
lets more single windows through to the exact pass, and results stay the same.

Defined cases: null or empty texts have no words; repeated ids are one
document; documents of fewer words than a window lose nothing; rows without an
id are never removed from and remove nothing; extra columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featureforge.llm.scratch import Scratch, text_bytes
from featureforge.llm.words import Words, blocks, mix, window_hashes, window_starts

DEPTH = 2
MAX_CELLS = 1 << 29
#: Cells of one merge unit.
BLOCK_CELLS = 1 << 18
#: Windows a task holds before it settles and sends them.
CHUNK_WINDOWS = 2_700_000
#: Text bytes a task splits at a time.
PART_BYTES = 2 << 20
#: Removed runs are broadcast up to this many, joined by shuffle beyond.
BROADCAST_RUNS = 1 << 20

#: Marks the start of the sketch's bits in what is broadcast.
_MAGIC = b"merged-window-sketch"
_FACTOR = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_ROW = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def cells_for(n_bytes: int) -> int:
    """Power of two of at least two cells per estimated window (six bytes a word)."""
    n = BLOCK_CELLS
    while n < n_bytes // 3 and n < MAX_CELLS:
        n *= 2
    return n


def cell_numbers(h: np.ndarray, row: int, cells: int) -> np.ndarray:
    return mix(h ^ np.uint64(_ROW[row])) >> np.uint64(65 - cells.bit_length())


def windows(block: pa.RecordBatch, size: int):
    """Words, word hashes, window positions, their documents and hashes."""
    words = Words(block.column("t"))
    h = words.hashes()
    at = window_starts(words.first, size)
    return words, at, words.doc_of()[at], window_hashes(h, size, _FACTOR[0])[at]


def encode_cells(cells: np.ndarray) -> bytes:
    """Sorted cell numbers as steps: the steps' low bytes, one bit each for
    "longer than a byte", and the upper parts of those."""
    step = np.diff(cells, prepend=0).astype(np.uint32)
    long = step > 255
    return (np.uint32(len(step)).tobytes() + step.astype(np.uint8).tobytes() + np.packbits(long).tobytes()
            + (step[long] >> 8).astype(np.uint16).tobytes())


def decode_cells(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, np.uint32, 1)[0])
    step = np.frombuffer(data, np.uint8, n, 4).astype(np.int64)
    mask = np.frombuffer(data, np.uint8, (n + 7) // 8, 4 + n)
    long = np.unpackbits(mask, count=n).astype(bool)
    step[long] += np.frombuffer(data[4 + n + len(mask):], np.uint16).astype(np.int64) << 8
    return np.cumsum(step)


def bits_in(shared) -> np.ndarray:
    """Bits of a broadcast sketch (rows x bytes).  A worker maps the file in which
    Spark delivers the broadcast, so the workers of an executor share one copy;
    where there is no such file it reads the value."""
    path = getattr(shared, "_path", None)
    if path and os.path.exists(path):
        with open(path, "rb") as f:
            at = f.read(4096).find(_MAGIC) + len(_MAGIC)
        size = (os.path.getsize(path) - at) // (DEPTH * BLOCK_CELLS // 8) * (DEPTH * BLOCK_CELLS // 8)
        if at >= len(_MAGIC):
            return np.memmap(path, np.uint8, "r", at, (size,)).reshape(DEPTH, -1)
    return np.frombuffer(shared.value, np.uint8)[len(_MAGIC):].reshape(DEPTH, -1)


def merged_sketch(docs: DataFrame, size: int, cells: int) -> bytearray:
    """One bit per cell and row, after a mark: whether its merged count is two or
    more."""
    def partition_sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush():
            for row in range(DEPTH):
                # (cell, document) pairs once each, then every cell at most twice
                key = np.concatenate([(cell_numbers(h, row, cells) << np.uint64(32)) | d for h, d in held])
                key.sort()
                key = key[np.concatenate([[True], key[1:] != key[:-1]])] >> np.uint64(32)
                if len(key) > 2:
                    key = key[np.concatenate([[True, True], key[2:] != key[:-2]])]
                key = key.astype(np.int64)
                part = key // BLOCK_CELLS
                cut = np.flatnonzero(np.diff(part, prepend=-1))
                ends = np.append(cut[1:], len(key))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[cut] * DEPTH + row),
                     pa.array([encode_cells(key[a:b] % BLOCK_CELLS) for a, b in zip(cut, ends)], pa.binary())],
                    ["part", "cells"])

        held, n, seen = [], 0, 0
        for batch in batches:
            for block in blocks(batch, "t", PART_BYTES):
                _, _, doc, h = windows(block, size)
                if len(h):
                    held.append((h, (doc + seen).astype(np.uint64)))
                n, seen = n + len(h), seen + block.num_rows
                if n >= CHUNK_WINDOWS:
                    yield from flush()
                    held, n, seen = [], 0, 0
        if held:
            yield from flush()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def bits():
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int64()),
                 pa.array([np.packbits(count >= 2, bitorder="little").tobytes()], pa.binary())], ["part", "bits"])

        now, count = None, None
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if part != now:
                    if now is not None and (count >= 2).any():
                        yield bits()
                    now, count = part, np.zeros(BLOCK_CELLS, np.uint8)
                got = decode_cells(data)
                twice = np.concatenate([got[1:] == got[:-1], [False]])
                once = np.concatenate([[True], got[1:] != got[:-1]])
                count[got[once]] += 1
                count[got[twice]] += 1
                np.minimum(count, 2, out=count)
        if now is not None and (count >= 2).any():
            yield bits()

    found = (docs.select("t").mapInArrow(partition_sketch, "part long, cells binary")
             .repartition("part").sortWithinPartitions("part")
             .mapInArrow(merge, "part long, bits binary").toLocalIterator())
    out = bytearray(len(_MAGIC) + DEPTH * cells // 8)
    out[:len(_MAGIC)] = _MAGIC
    rows = np.frombuffer(out, np.uint8)[len(_MAGIC):].reshape(DEPTH, -1)
    for r in found:
        a = r["part"] // DEPTH * (BLOCK_CELLS // 8)
        rows[r["part"] % DEPTH, a:a + BLOCK_CELLS // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def _runs(at: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each stretch of consecutive windows of a document."""
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    return first, np.append(first[1:], len(at))[:len(first)] - 1


def repeated_windows(docs: DataFrame, size: int, sketch: bytearray, cells: int) -> DataFrame:
    """Rows (h1, rest, doc, place).  ``place`` >= 0: a window at that word that
    waits for the smallest id of its hash (h1, rest); below 0: a run of windows
    already known to be removed, from word -place - 1 to word ``rest``."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bits_in(shared)

        def flush():
            doc = np.concatenate([x[0] for x in held])
            at = np.concatenate([x[1] for x in held])
            h1 = np.concatenate([x[2] for x in held])
            h2 = np.concatenate([x[3] for x in held])
            order = np.lexsort((at, doc))
            doc, at, h1, h2 = doc[order], at[order], h1[order], h2[order]
            by = np.argsort(h1, kind="stable")
            new = np.ones(len(by), bool)
            new[1:] = (h1[by][1:] != h1[by][:-1]) | (h2[by][1:] != h2[by][:-1])
            least = doc[by][np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))]
            settled = np.zeros(len(by), bool)
            settled[by] = doc[by] > least
            d, a = doc[settled], at[settled]
            first, last = _runs(a, d)
            wait = ~settled
            # settled rows take a hash of their own place, so that no key gathers them
            spread = mix(d[first].astype(np.uint64) * np.uint64(_FACTOR[1]) + a[first].astype(np.uint64))
            for start in range(0, max(len(first), int(wait.sum())), 1 << 16):
                some, left = slice(start, start + (1 << 16)), np.flatnonzero(wait)[start:start + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([spread[some], h1[left]]).view(np.int64)),
                     pa.array(np.concatenate([a[last[some]], (h2[left] >> np.uint64(33)).astype(np.int64)]).astype(np.int32)),
                     pa.array(np.concatenate([d[first[some]], doc[left]])),
                     pa.array(np.concatenate([-a[first[some]] - 1, at[left]]).astype(np.int32))],
                    ["h1", "rest", "doc", "place"])

        held, n = [], 0
        for batch in batches:
            for block in blocks(batch, "t", PART_BYTES):
                words, at, doc, h = windows(block, size)
                hit = np.ones(len(h), bool)
                for row in range(DEPTH):
                    c = cell_numbers(h, row, cells)
                    hit &= (bits[row][(c >> np.uint64(3)).astype(np.int64)] >> (c & np.uint64(7)).astype(np.uint8)) & 1 == 1
                at, doc, h = at[hit], doc[hit], h[hit]
                n += len(hit)
                if len(at):
                    g = words.hashes(1)
                    h2 = np.zeros(len(at), np.uint64)
                    for k in range(size):
                        h2 *= np.uint64(_FACTOR[1])
                        h2 += g[at + k]
                    ids = block.column("k").to_numpy(zero_copy_only=False)
                    held.append((ids[doc], at - words.first[doc], h, mix(h2)))
                if n >= CHUNK_WINDOWS:
                    if held:
                        yield from flush()
                    held, n = [], 0
        if held:
            yield from flush()

    return docs.where("k IS NOT NULL").mapInArrow(
        candidates, "h1 long, rest int, doc long, place int")


def removed_runs(docs: DataFrame, size: int) -> DataFrame:
    """Per document (k): sorted, merged runs of removed words (``starts``, ``ends``)."""
    cells = cells_for(text_bytes(docs, "t"))
    sketch = merged_sketch(docs.where("k IS NOT NULL"), size, cells)
    rows = repeated_windows(docs, size, sketch, cells)
    settled = F.col("place") < 0
    least = F.min("doc").over(Window.partitionBy("h1", "rest"))
    gone = (rows.withColumn("least", least).where(settled | (F.col("doc") > F.col("least")))
            .select("doc", F.when(settled, -F.col("place") - 1).otherwise(F.col("place")).alias("first"),
                    F.when(settled, F.col("rest")).otherwise(F.col("place")).alias("last")))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, ends = [], []
            for x in batch.column("runs"):
                first = x.values.field("first").to_numpy()
                last = x.values.field("last").to_numpy()
                order = np.argsort(first, kind="stable")
                first, reach = first[order], np.maximum.accumulate(last[order] + size)
                new = np.ones(len(first), bool)
                new[1:] = first[1:] > reach[:-1]
                starts.append(first[new])
                ends.append(reach[np.append(np.flatnonzero(new)[1:], len(first)) - 1])
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(starts, kind), pa.array(ends, kind)],
                                             ["k", "starts", "ends"])

    return (gone.groupBy("doc").agg(F.collect_list(F.struct("first", "last")).alias("runs"))
            .mapInArrow(merge, "k long, starts array<int>, ends array<int>"))


def deduplicate_substrings(docs: DataFrame, size: int = 13, id_col: str = "doc_id", text_col: str = "text",
                           carry: tuple[str, ...] = ()) -> DataFrame:
    """Per document: id, ``n_words``, ``n_removed``, ``kept_text`` (kept words
    joined by one space), the removed runs of words (``starts``, ``ends``) and
    the columns named in ``carry``."""
    carried = {f"carried_{i}": c for i, c in enumerate(carry)}
    keyed = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).alias("t"),
                        *[F.col(c).alias(x) for x, c in carried.items()])
    runs = Scratch(docs.sparkSession, "substrings").table(removed_runs(keyed.select("k", "t"), size), "runs")
    n_runs = runs.agg(F.coalesce(F.sum(F.size("starts")), F.lit(0)).alias("n")).first()["n"]
    joined = keyed.join(F.broadcast(runs) if n_runs <= BROADCAST_RUNS else runs, "k", "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "t", PART_BYTES):
                words = Words(block.column("t"))
                edge = np.zeros(len(words.bounds), np.int32)
                for name, sign in (("starts", 1), ("ends", -1)):
                    lists = block.column(name)
                    owner = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
                    at = lists.flatten().to_numpy() + words.first[owner]
                    np.add.at(edge, at, sign)
                keep = np.cumsum(edge[:-1]) == 0
                kept_before = np.zeros(len(keep) + 1, np.int64)
                np.cumsum(keep, out=kept_before[1:])
                n_kept = np.diff(kept_before[words.first])
                yield pa.RecordBatch.from_arrays(
                    [block.column("k"), pa.array(words.counts()), pa.array(words.counts() - n_kept),
                     words.sentences(keep), block.column("starts"), block.column("ends"),
                     *[block.column(x) for x in carried]],
                    ["k", "n_words", "n_removed", "kept_text", "starts", "ends", *carried])

    more = "".join(f", {x} {keyed.schema[x].dataType.simpleString()}" for x in carried)
    out = joined.mapInArrow(cut, "k long, n_words long, n_removed long, kept_text string, "
                                 "starts array<int>, ends array<int>" + more)
    return out.select(F.col("k").alias(id_col), "n_words", "n_removed", "kept_text", "starts", "ends",
                      *[F.col(x).alias(c) for x, c in carried.items()])


def oracle_sql(size: int = 13) -> str:
    """DuckDB SQL of the contract's rows."""
    return f"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'),
                                      lambda x: x <> '') AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + {size - 1}], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {size} + 2)) AS i FROM w WHERE len(ws) >= {size})),
gone AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + {size})))) AS p
         FROM (SELECT *, min(doc_id) OVER (PARTITION BY g) AS least FROM g) WHERE least < doc_id GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(p), 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN p IS NULL THEN array_to_string(ws, ' ') ELSE array_to_string(
         list_transform(list_filter(list_zip(ws, range(1, len(ws) + 1)), lambda z: NOT list_contains(p, z[2])),
                        lambda z: z[1]), ' ') END) AS kept_sha256
FROM w LEFT JOIN gone USING (doc_id)
"""
