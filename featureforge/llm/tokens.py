"""Token counts: lengths of the token sequences of whole texts.

Texts are encoded in Arrow functions that return lengths only.  Long texts
are split at safe boundaries: before a space that follows anything but a space
marker, a place no vocabulary piece spans (checked against the model when it
is loaded), so the parts' counts add up to the whole text's count.  The equal
parts of a block are encoded once, and the distinct parts are encoded in
batches of about equal bytes.

Defined cases: null and empty texts have no tokens; the result holds only the
id and the counts, so extra columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureforge.llm.words import blocks, utf8

#: Target size of one encoding batch.
BATCH_BYTES = 1 << 19
MARK = "▁"


class SentencePieceCounter:
    """Counts tokens of UTF-8 parts with a SentencePiece model."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        inner = [p for i in range(n) if MARK in (p := self.model.id_to_piece(i)).lstrip(MARK)
                 and not self.model.is_control(i) and not self.model.is_unknown(i)]
        #: Only if no piece has a space marker after another character do words encode apart.
        self.safe = not inner and self._plain_normaliser()

    def _plain_normaliser(self) -> bool:
        """Spaces are kept one to one and every text gets one marker in front."""
        probe = ["a  b", " a", "a ", "ﬁ é é Ａ"]
        return all(self.model.normalize(x) == MARK + x.replace(" ", MARK) for x in probe)

    def count(self, parts: list[str]) -> np.ndarray:
        out = np.zeros(len(parts), np.int64)
        size = np.cumsum([len(p) + 8 for p in parts]) if parts else np.zeros(0)
        a = 0
        while a < len(parts):
            done = size[a - 1] if a else 0
            b = max(int(np.searchsorted(size, done + BATCH_BYTES, "right")), a + 1)
            out[a:b] = [len(x) for x in self.model.encode(parts[a:b], num_threads=1)]
            a = b
        return out


def cut_points(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Byte positions at which a new part starts: every document's start and
    every space between a byte that is no space and no end of a literal space
    marker and another byte that is no space."""
    space = data == 32
    start = np.zeros(len(data), bool)
    if len(data) > 1:
        start[1:] = space[1:] & ~space[:-1]
        marker = np.zeros(len(data), bool)
        marker[2:] = (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
        start[1:] &= ~marker[:-1]
    last = off[1:] - 1
    start[last[last >= 0]] = False  # a space that ends a text stays with what precedes it
    inner = off[:-1]
    start[inner[inner < len(data)]] = True
    return np.flatnonzero(start)


def count_block(col, counter) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, tokens) of each text of a column."""
    data, off = utf8(col)
    size = np.diff(off)
    if len(data) == 0:
        return size, np.zeros(len(size), np.int64)
    if not counter.safe:
        return size, counter.count(["" if x is None else x for x in col.to_pylist()])
    starts = cut_points(data, off)
    bounds = np.append(starts, len(data))
    first = np.searchsorted(starts, off)
    # A part but a document's first begins with a space, which stands for the marker put in front.
    parts = pa.Array.from_buffers(pa.large_string(), len(starts),
                                  [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    lead = np.zeros(len(starts), bool)
    lead[first[:-1][size > 0]] = True
    coded = parts.dictionary_encode()
    distinct = coded.dictionary
    inner = pc.utf8_slice_codeunits(distinct, 1).to_pylist()
    whole = distinct.to_pylist()
    index = coded.indices.to_numpy()
    used_first = np.zeros(len(distinct), bool)
    used_first[index[lead]] = True
    used_inner = np.zeros(len(distinct), bool)
    used_inner[index[~lead]] = True
    n_first = np.zeros(len(distinct), np.int64)
    n_inner = np.zeros(len(distinct), np.int64)
    at = np.flatnonzero(used_first)
    n_first[at] = counter.count([whole[i] for i in at])
    at = np.flatnonzero(used_inner)
    n_inner[at] = counter.count([inner[i] for i in at])
    each = np.where(lead, n_first[index], n_inner[index])
    total = np.zeros(len(each) + 1, np.int64)
    np.cumsum(each, out=total[1:])
    return size, np.diff(total[first])


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096) -> DataFrame:
    """id, ``n_bytes``, ``n_tokens`` and ``over_limit`` (n_tokens > limit) of
    every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = SentencePieceCounter(model_path)
        for batch in batches:
            for block in blocks(batch, "t"):
                size, n = count_block(block.column("t"), counter)
                yield pa.RecordBatch.from_arrays(
                    [block.column("k"), pa.array(size), pa.array(n), pa.array(n > limit)],
                    ["k", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t"))
            .mapInArrow(run, f"k {kind}, n_bytes long, n_tokens long, over_limit boolean")
            .withColumnRenamed("k", id_col))
