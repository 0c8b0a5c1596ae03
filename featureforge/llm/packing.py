"""Packing documents into fixed-length token sequences.

A document's ids (tokenizer ids, then one end id) are cut into pieces of at
most ``capacity``.  Only the pieces' lengths travel: pieces are dealt into
randomised groups of documents of bounded size, and each group is packed on
its own by first-fit decreasing, with a tournament tree of bin capacities that
finds the first bin with room in O(log bins).

Texts are encoded in parts, cut where the tokenizer's pattern always starts a
new word: at a space or line break between two characters that are no white
space, after such a line break, and between an ASCII letter and an ASCII sign.
Equal parts of a task are encoded once.

Defined cases: a null or empty text is the end id alone; repeated rows are
packed like others; only the id and text columns are read, so extra columns
cannot clash.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureforge.llm.scratch import Scratch
from featureforge.llm.words import blocks, utf8

CAPACITY = 1024
#: Pieces of a group on average (what one task packs at a time).
GROUP_PIECES = 4096
#: Distinct parts whose ids a task remembers (about 100 MB), and that it encodes at a time.
MEMORY_PARTS = 500_000
ENCODE_PARTS = 1 << 14

_BREAK = np.zeros(256, bool)
_BREAK[[9, 10, 11, 12, 13, 32, 28, 29, 30, 31]] = True

_LETTER, _SIGN = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_SIGN[33:48] = _SIGN[58:65] = _SIGN[91:97] = _SIGN[123:127] = True


class PartEncoder:
    """Ids of text parts, remembered for the parts seen in this task."""

    def __init__(self, path: str, memory_parts: int = MEMORY_PARTS):
        self.memory_parts = memory_parts
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # no cut may fall into a special string
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cuts = not any(c.isspace() for t in special for c in t)
        self.sign = _SIGN.copy()
        self.sign[[ord(b) for t in special for a, b in zip(t, t[1:]) if a.isascii() and a.isalpha() and ord(b) < 256]] = False
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.bounds = np.zeros(1 << 15, np.int64)

    def numbers(self, parts: list[str]) -> np.ndarray:
        """Number of each part; its ids are ``ids[bounds[n]:bounds[n + 1]]``."""
        if len(self.known) > self.memory_parts:
            self.forget()
        known = self.known
        fresh = [p for p in parts if p not in known]
        if fresh:
            coded = [e.ids for a in range(0, len(fresh), ENCODE_PARTS) for e in
                     self.tokenizer.encode_batch_fast(fresh[a:a + ENCODE_PARTS], add_special_tokens=False)]
            n = len(known)
            size = np.fromiter(map(len, coded), np.int64, len(coded))
            end = self.bounds[n] + np.cumsum(size)
            while len(self.bounds) < n + len(fresh) + 1:
                self.bounds = np.concatenate([self.bounds, np.zeros_like(self.bounds)])
            while len(self.ids) < end[-1]:
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[self.bounds[n]:end[-1]] = np.fromiter((i for c in coded for i in c), np.int32, int(size.sum()))
            self.bounds[n + 1:n + 1 + len(fresh)] = end
            known.update(zip(fresh, range(n, n + len(fresh))))
        return np.fromiter((known[p] for p in parts), np.int64, len(parts))

    def encode(self, col) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column, and the bounds of each text's ids."""
        data, off = utf8(col)
        if len(data) == 0:
            return np.zeros(0, np.int32), np.zeros(len(off), np.int64)
        start = np.zeros(len(data), bool)
        if len(data) > 2 and self.cuts:
            plain = ~_BREAK[data]
            # a character of two or three bytes that may be white space
            wide = np.zeros(len(data), bool)
            wide[1:] = data[:-1] == 0xC2
            wide[2:] |= (data[:-2] >= 0xE1) & (data[:-2] <= 0xE3) & (data[1:-1] >= 0x80) & (data[1:-1] <= 0x9A)
            after_plain = plain[:-2] & ~wide[:-2]
            start[1:-1] = (data[1:-1] == 32) & plain[2:] & after_plain
            # a line break between two such characters is a word of its own
            line = (data[1:-1] == 10) & (data[2:] < 128) & plain[2:] & (data[:-2] < 128) & plain[:-2]
            start[1:-1] |= line
            start[2:] |= line
            # so is what follows a run of ASCII letters if it is an ASCII sign
            start[1:] |= _LETTER[data[:-1]] & self.sign[data[1:]]
        last = off[1:] - 1
        start[last[last >= 0]] = False
        inner = off[:-1]
        start[inner[inner < len(data)]] = True
        starts = np.flatnonzero(start)
        parts = pa.Array.from_buffers(pa.large_string(), len(starts),
                                      [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)])
        coded = parts.dictionary_encode()
        number = self.numbers(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        size = self.bounds[number + 1] - self.bounds[number]
        total = np.zeros(len(number) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        at = np.repeat(self.bounds[number] - total[:-1], size)
        at += np.arange(total[-1])
        return self.ids[at], total[np.searchsorted(starts, off)]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0, carry: str = "ids",
           id_col: str = "doc_id", text_col: str = "text", memory_parts: int = MEMORY_PARTS) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``doc_tokens`` and its ids
    (``carry="ids"``: array; ``"crc32"``: their CRC-32 only).  A task remembers ``memory_parts`` parts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PartEncoder(tokenizer_path, memory_parts)
        for batch in batches:
            for block in blocks(batch, "t"):
                ids, bounds = encoder.encode(block.column("t"))
                row, start, length, tokens, content = [], [], [], [], []
                for k in range(block.num_rows):
                    own = np.append(ids[bounds[k]:bounds[k + 1]], np.int32(end_id))
                    for a in range(0, len(own), capacity):
                        part = own[a:a + capacity]
                        row.append(k)
                        start.append(a)
                        length.append(len(part))
                        tokens.append(len(own))
                        content.append(part if carry == "ids" else zlib.crc32(part.astype("<u4").tobytes()))
                last = pa.array(content, pa.list_(pa.int32()) if carry == "ids" else pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [block.column("k").take(pa.array(row)), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                     pa.array(tokens, pa.int64()), last], ["k", "start", "length", "doc_tokens", carry_name])

    carry_name = "ids" if carry == "ids" else "ids_crc32"
    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t"))
            .mapInArrow(run, f"k {kind}, start long, length long, doc_tokens long, {carry_name} "
                             + ("array<int>" if carry == "ids" else "long"))
            .withColumnRenamed("k", id_col))


def first_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each piece; ``lengths`` must not increase."""
    size = 1
    while size < len(lengths):
        size *= 2
    room = [capacity] * (2 * size)  # node k holds the larger room of 2k and 2k+1; leaves are the bins
    bins, offsets = [], []
    for n in lengths:
        node = 1
        while node < size:
            node *= 2
            if room[node] < n:
                node += 1
        bins.append(node - size)
        offsets.append(capacity - room[node])
        room[node] -= n
        while node > 1:
            node //= 2
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
    return bins, offsets


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0, carry: str = "ids",
         id_col: str = "doc_id", text_col: str = "text", group_pieces: int = GROUP_PIECES, seed: int = 7,
         memory_parts: int = MEMORY_PARTS) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``."""
    made = Scratch(docs.sparkSession, "packing").table(
        pieces(docs, tokenizer_path, capacity, end_id, carry, id_col, text_col, memory_parts), "pieces")
    groups = -(-made.count() // group_pieces) or 1
    # A document's pieces share a group, but for runs of a very long document.
    run = F.floor(F.col("start") / F.lit(capacity * group_pieces))
    own = F.coalesce(F.xxhash64(id_col, run, F.lit(seed)), F.lit(0))
    grouped = made.withColumn("pack_group", F.when(F.col(id_col).isNull(), F.xxhash64(F.rand(seed))).otherwise(own))
    grouped = grouped.withColumn("pack_group", F.pmod("pack_group", F.lit(groups)))

    def run_group(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), (id_col, "ascending"), ("start", "ascending")])
        bins, offsets = first_fit_decreasing(table.column("length").to_pylist(), capacity)
        group = table.column("pack_group")[0].as_py()
        return (table.drop_columns(["pack_group"])
                .append_column("sequence_id", pa.array(np.array(bins, np.int64) + (group << 32)))
                .append_column("offset", pa.array(offsets, pa.int64())))

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in made.schema.fields)
    return grouped.groupBy("pack_group").applyInArrow(run_group, kind + ", sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """Token ids of each sequence (from ``pack(..., carry="ids")``)."""
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
