"""Alignment of two tokenizers' tokens over the same bytes.

Both tokenizers encode a space and the text.  A token's byte range comes from
its character span (``tokenizers``) or its span in the piece message
(``sentencepiece``), which are coarse: a character of several bytes may be
shared by tokens, byte-fallback pieces share one span, and a model may count
the space in front differently.  Where spans are not exact the ranges are
refined with the tokens' decoded bytes.  Positions at which a token of either
side ends cut the bytes into groups; every token of one side is linked with
every token of the other side in its group.

Texts are cut where both tokenizers begin a word whatever stands before: at a
space between two characters that are no white space.  Both sides end a token
there, so no group spans a cut, and the distinct parts of a task are encoded,
aligned and written out as text once; a document is a list of part numbers.

Link counts over the corpus: tasks write their documents in chunks of bounded
size, each with the distinct id pairs it holds and in how many of its documents
each is linked.  The pairs' sums go back to the chunks by a join on the pair,
so no table of pairs is broadcast (only the highest count of each first id,
which the vocabulary bounds).

Defined cases: null and empty texts, texts with U+2581, and texts whose tokens
of either side do not spell the text have no tokens (zeros, an empty digest);
repeated rows are documents of their own; a very long text is handled in
segments cut at the same places; an empty table gives no rows; only the id and
text columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureforge.llm.scratch import Scratch
from featureforge.llm.words import release_memory, utf8

#: Bytes of text that are cut into parts at a time, and bytes of text of a chunk.
SEGMENT_BYTES = 2 << 20
CHUNK_BYTES = 8 << 20
#: Distinct parts a task remembers, and bytes of parts encoded at a time.
MEMORY_PARTS = 400_000
ENCODE_BYTES = 1 << 16
#: Id pairs of a row that lists a chunk's pairs.
ROW_PAIRS = 1 << 14
MARK = "▁".encode()

_BREAK = np.zeros(256, bool)
_BREAK[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True


def ragged(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indices ``first[k], first[k] + 1, ...`` (``size[k]`` of them) one after another."""
    size = np.asarray(size, np.int64)
    at = np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) if len(size) else np.zeros(0, np.int64)
    return at + np.arange(len(at))


def table_of(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    bounds = np.zeros(len(pieces) + 1, np.int64)
    np.cumsum([len(p) for p in pieces], out=bounds[1:])
    return np.frombuffer(b"".join(pieces), np.uint8), bounds


def byte_alphabet() -> dict[str, int]:
    """Characters with which byte-level vocabularies write bytes: printable
    Latin-1 characters stand for themselves, other bytes for 256, 257, ..."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def byte_ends(begin: np.ndarray, end: np.ndarray, size: np.ndarray) -> np.ndarray:
    """End of each token: the coarse span's end where the next span begins
    there and nothing is shared, else the last such end plus decoded sizes."""
    done = np.cumsum(size)
    exact = np.ones(len(end), bool)
    exact[:-1] = (begin[1:] >= end[:-1]) & (end[1:] > begin[1:])
    exact &= end > begin
    at = np.maximum.accumulate(np.where(exact, np.arange(len(end)), -1))
    return np.where(at >= 0, end[at] + done - done[at], done)


def large(x):
    """A string or column of strings with 64-bit offsets."""
    return pa.scalar(x, pa.large_string()) if isinstance(x, str) else x


class LevelA:
    """Byte-level tokenizer: ids and byte ends over joined parts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        alphabet = byte_alphabet()
        names = self.model.get_vocab()
        pieces = [b""] * (max(names.values()) + 1)
        for token, i in names.items():
            pieces[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.data, self.bounds = table_of(pieces)

    def spans(self, text: str, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids and coarse byte spans of ``text``; ``starts``: byte position of each character and the end."""
        coded = self.model.encode(text, add_special_tokens=False)
        span = starts[np.fromiter(chain.from_iterable(coded.offsets), np.int64, 2 * len(coded.ids))]
        return np.array(coded.ids, np.int64), span[::2], span[1::2]


class PieceB:
    """SentencePiece model with a space put in front: ids and byte ends over joined parts."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            pieces.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i)
                          else b"" if self.model.is_control(i) or self.model.is_unknown(i)
                          else piece.replace("▁", " ").encode())
        self.data, self.bounds = table_of(pieces)
        # newer versions name the span message "proto", older ones "immutable_proto"; spans are bytes or characters
        try:
            self.kind = "proto"
            probe = self._message("é")
        except ValueError:
            self.kind = "immutable_proto"
            probe = self._message("é")
        self.in_bytes = probe.pieces[-1].end == 2

    def _message(self, text: str):
        return self.model.encode(text, out_type=self.kind)

    def spans(self, text: str, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        pieces = self._message(text[1:]).pieces  # the model puts the space back
        n = len(pieces)
        flat = np.fromiter(chain.from_iterable((p.id, p.begin, p.end) for p in pieces), np.int64, 3 * n).reshape(n, 3)
        begin, end = flat[:, 1] + 1, flat[:, 2] + 1
        if not self.in_bytes:
            begin, end = starts[begin], starts[end]
        if n:
            begin[0] = 0
        return flat[:, 0], begin, end


class Side:
    """Tokens of a batch of parts: ids, byte ends, and each part's first token;
    ``good``: the part's tokens spell it."""

    def __init__(self, model, texts: list[str], sizes: np.ndarray, n_clean: int):
        self.model = model
        ids, ends, n, good, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(1, np.int64)], [], 0
        for text, own in joined(texts, sizes, n_clean):
            for i, end, tokens, fits, size in self._spelt(text, own):
                ids.append(i)
                ends.append(end + at)
                n.append(tokens)
                good.append(fits)
                at += size
        self.ids, self.ends, self.first = np.concatenate(ids), np.concatenate(ends), np.cumsum(np.concatenate(n))
        self.good = np.concatenate([*good, np.zeros(0, bool)])

    def _spelt(self, text: str, own: np.ndarray) -> list[tuple]:
        """(ids, ends, tokens of each part, good, bytes) of a run of parts of ``own`` bytes each."""
        raw = np.frombuffer(text.encode(), np.uint8)
        starts = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
        ids, begin, end = self.model.spans(text, starts)
        size = self.model.bounds[ids + 1] - self.model.bounds[ids]
        end = byte_ends(begin, end, size)
        stop = np.cumsum(own)
        last = np.searchsorted(end, stop, "right")
        fits = np.array_equal(self.model.data[ragged(self.model.bounds[ids], size)], raw) and np.array_equal(
            end, np.cumsum(size)) and bool(np.all(last > 0)) and np.array_equal(end[last - 1], stop)
        if not fits and len(own) > 1:  # find the part that is not spelt
            cut = np.concatenate([[0], stop])
            return [x for k in range(len(own)) for x in
                    self._spelt(raw[cut[k]:cut[k + 1]].tobytes().decode(), own[k:k + 1])]
        if not fits:
            return [(ids[:0], end[:0], np.zeros(1, np.int64), np.zeros(1, bool), len(raw))]
        return [(ids, end, np.diff(last, prepend=0), np.ones(len(own), bool), len(raw))]


def clean(part: str) -> bool:
    """Whether a part may be encoded together with others: one space, then no
    white space at either end."""
    return len(part) > 1 and part[0] == " " and not part[1].isspace() and not part[-1].isspace()


def joined(texts: list[str], sizes: np.ndarray, n_clean: int) -> Iterator[tuple[str, np.ndarray]]:
    """Runs of the first ``n_clean`` parts as one text each, the others alone; with the parts' byte sizes."""
    done = np.cumsum(sizes)
    at = 0
    while at < n_clean:
        end = int(np.searchsorted(done[:n_clean], (done[at - 1] if at else 0) + ENCODE_BYTES, "left")) + 1
        end = min(end, n_clean)
        yield "".join(texts[at:end]), sizes[at:end]
        at = end
    for k in range(n_clean, len(texts)):
        yield texts[k], sizes[k:k + 1]


class Aligner:
    """Aligned parts of a task: numbers for parts, and each part's counts, links and group text."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = LevelA(path_a), PieceB(path_b)
        self.digits = [table_of([b"%d" % i for i in range(len(m.bounds) - 1)]) for m in (self.a, self.b)]
        self.forget()

    def forget(self) -> None:
        """Starts anew; part and pair numbers are no longer valid."""
        self.known: dict[str, int] = {}
        self.n = np.zeros((0, 4), np.int64)  # tokens of A, of B, groups, links
        self.good = np.zeros(0, bool)
        self.shown: list[bytes] = []
        self.pair_of: dict[int, int] = {}  # id pair -> number
        self.links, self.times = np.zeros(0, np.int32), np.zeros(0, np.int64)  # pair numbers of each part, and how often
        self.bounds = np.zeros(1, np.int64)

    def numbers(self, distinct: pa.Array) -> np.ndarray:
        """Numbers of distinct parts, which are aligned if they are new."""
        known, parts = self.known, distinct.to_pylist()
        number = np.fromiter((known.get(p, -1) for p in parts), np.int64, len(parts))
        new = np.flatnonzero(number < 0)
        if len(new):
            fresh = [parts[k] for k in new.tolist()]
            number[new] = np.arange(len(known), len(known) + len(new))
            known.update(zip(fresh, number[new].tolist()))
            self._align(fresh, pc.binary_length(distinct).to_numpy().astype(np.int64)[new])
        return number

    def _align(self, texts: list[str], sizes: np.ndarray) -> None:
        # odd parts last, so that both sides see the same order of runs
        tidy = np.fromiter(map(clean, texts), bool, len(texts))
        texts_order = np.argsort(~tidy, kind="stable")
        n_clean = int(tidy.sum())
        ordered, sizes = [texts[k] for k in texts_order.tolist()], sizes[texts_order]
        a, b = Side(self.a, ordered, sizes, n_clean), Side(self.b, ordered, sizes, n_clean)
        good = a.good & b.good
        n = len(ordered)
        # groups: byte positions at which a token of either side ends
        shared = np.intersect1d(a.ends, b.ends, assume_unique=True)
        group_a, group_b = np.searchsorted(shared, a.ends), np.searchsorted(shared, b.ends)
        part_a, part_b = np.repeat(np.arange(n), np.diff(a.first)), np.repeat(np.arange(n), np.diff(b.first))
        keep_a, keep_b = good[part_a], good[part_b]
        ids_a, ids_b = a.ids[keep_a], b.ids[keep_b]
        group_a, group_b, part_a = group_a[keep_a], group_b[keep_b], part_a[keep_a]
        # a group's tokens follow each other on both sides
        names, first_a, n_a = np.unique(group_a, return_index=True, return_counts=True)
        names_b, first_b, n_b = np.unique(group_b, return_index=True, return_counts=True)
        assert np.array_equal(names, names_b)
        part = part_a[first_a] if len(names) else np.zeros(0, np.int64)
        counts = np.zeros((n, 4), np.int64)
        for col, x in enumerate((n_a, n_b, np.ones(len(names), np.int64), n_a * n_b)):
            np.add.at(counts[:, col], part, x)
        codes, times, owner = self._pairs(ids_a, ids_b, first_a, first_b, n_a, n_b, part)
        shown = self._shown(ids_a, ids_b, n_a, n_b, part, n)
        # back to the order of the numbers
        back = np.empty(n, np.int64)
        back[texts_order] = np.arange(n)
        cut = np.searchsorted(owner, np.arange(n + 1))
        size = np.diff(cut)[back]
        take = ragged(cut[:-1][back], size)
        pair_of = self.pair_of
        distinct, inverse = np.unique(codes, return_inverse=True)
        for code in distinct.tolist():
            if code not in pair_of:
                pair_of[code] = len(pair_of)
        number = np.fromiter((pair_of[c] for c in distinct.tolist()), np.int32, len(distinct))[inverse]
        self.links = np.concatenate([self.links, number[take]])
        self.times = np.concatenate([self.times, times[take]])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(size)])
        self.n = np.concatenate([self.n, counts[back]])
        self.good = np.concatenate([self.good, good[back]])
        self.shown += [shown[k] for k in back.tolist()]

    def _pairs(self, ids_a, ids_b, first_a, first_b, n_a, n_b, part):
        """Distinct id pairs of each part (in part order) and how often each is linked."""
        out_code, out_times, out_part = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        wide = n_a * n_b > 1 << 12
        small = np.flatnonzero(~wide)
        # expand the small groups together
        size = (n_a * n_b)[small]
        within = ragged(np.zeros(len(small), np.int64), size)
        per = np.repeat(n_b[small], size)
        code = (ids_a[np.repeat(first_a[small], size) + within // np.maximum(per, 1)] << 32) \
            | ids_b[np.repeat(first_b[small], size) + within % np.maximum(per, 1)]
        out_code.append(code)
        out_times.append(np.ones(len(code), np.int64))
        out_part.append(np.repeat(part[small], size))
        for g in np.flatnonzero(wide):  # a long group: distinct ids of both sides first
            x, nx = np.unique(ids_a[first_a[g]:first_a[g] + n_a[g]], return_counts=True)
            y, ny = np.unique(ids_b[first_b[g]:first_b[g] + n_b[g]], return_counts=True)
            out_code.append(((x[:, None] << 32) | y[None, :]).ravel())
            out_times.append((nx[:, None] * ny[None, :]).ravel())
            out_part.append(np.full(len(x) * len(y), part[g]))
        code, times, part = map(np.concatenate, (out_code, out_times, out_part))
        order = np.lexsort((code, part))
        code, times, part = code[order], times[order], part[order]
        new = np.ones(len(code), bool)
        new[1:] = (code[1:] != code[:-1]) | (part[1:] != part[:-1])
        at = np.flatnonzero(new)
        return code[at], np.add.reduceat(times, at) if len(at) else times, part[at]

    def _shown(self, ids_a, ids_b, n_a, n_b, part, n) -> list[bytes]:
        """Each part's groups as ``a1,a2|b1;`` with a semicolon after every group."""
        group = np.arange(len(n_a))
        side = np.concatenate([np.repeat(group * 2, n_a), np.repeat(group * 2 + 1, n_b)])
        order = np.argsort(side, kind="stable")
        piece, start, size = [], [], []
        for ids, (data, bounds), base in ((ids_a, self.digits[0], 0), (ids_b, self.digits[1], len(self.digits[0][0]))):
            start.append(bounds[ids] + base)
            size.append(bounds[ids + 1] - bounds[ids])
            piece.append(data)
        data = np.concatenate(piece)
        start, size = np.concatenate(start)[order], np.concatenate(size)[order]
        side = side[order]
        end = np.cumsum(size + 1)
        out = np.full(int(end[-1]) if len(end) else 0, ord(","), np.uint8)
        out[ragged(end - size - 1, size)] = data[ragged(start, size)]
        last = np.ones(len(side), bool)
        last[:-1] = side[1:] != side[:-1]
        out[end[last] - 1] = np.where(side[last] % 2 == 0, ord("|"), ord(";"))
        # bytes of each part
        stop = end[np.searchsorted(side, np.arange(len(n_a)) * 2 + 1, "right") - 1] if len(n_a) else np.zeros(0, np.int64)
        cut = np.concatenate([[0], stop])[np.searchsorted(part, np.arange(n + 1))]
        text = out.tobytes()
        return [text[cut[k]:cut[k + 1]] for k in range(n)]


def part_starts(data: np.ndarray) -> np.ndarray:
    """Positions in one text at which a new part starts: 0, and every space
    between two characters that are no white space."""
    start = np.zeros(len(data), bool)
    if len(data) > 2:
        plain = ~_BREAK[data]
        # characters of two or three bytes that may be white space
        wide = np.zeros(len(data), bool)
        wide[1:] = data[:-1] == 0xC2
        wide[2:] |= (data[:-2] >= 0xE1) & (data[:-2] <= 0xE3) & (data[1:-1] >= 0x80) & (data[1:-1] <= 0x9A)
        lead = (data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3))  # may begin such a character
        start[1:-1] = (data[1:-1] == 32) & plain[:-2] & ~wide[:-2] & plain[2:] & ~lead[2:]
    if len(data):
        start[0] = True
    return np.flatnonzero(start)


def segments(data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A text in segments of about ``SEGMENT_BYTES``, cut at part starts, with their part starts."""
    at = 0
    while at < len(data):
        size = SEGMENT_BYTES
        while True:
            piece = data[at:at + size]
            starts = part_starts(piece)
            if at + size >= len(data):
                yield piece, starts
                at = len(data)
                break
            if len(starts) > 1:  # the last part may go on
                yield piece[:starts[-1]], starts[:-1]
                at += int(starts[-1])
                break
            size *= 2  # no cut: take more


class Chunk:
    """Documents whose links wait for the counts of the whole corpus."""

    def __init__(self):
        self.keys, self.rows, self.pairs, self.times, self.size = [], [], [], [], 0

    def add(self, keys, rows: list[tuple], pairs: list[np.ndarray], times: list[np.ndarray], size: int) -> None:
        self.keys.append(keys)
        self.rows += rows
        self.pairs += pairs
        self.times += times
        self.size += size


def merged(owner: np.ndarray, item: np.ndarray, weight: np.ndarray, n_items: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of ``weight`` by (owner, item), in that order."""
    key = owner * np.int64(max(n_items, 1)) + item
    order = np.argsort(key, kind="stable")
    key, weight = key[order], weight[order]
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    total = np.add.reduceat(weight, at) if len(at) else weight
    return key[at] // max(n_items, 1), key[at] % max(n_items, 1), total


def texts_of(aligner: Aligner, data: np.ndarray, off: np.ndarray, starts: np.ndarray):
    """Of texts that lie in ``data`` at ``off`` and are cut at ``starts``: whether
    their tokens spell them, counts, group text, pair numbers and times."""
    parts = pa.Array.from_buffers(pa.large_string(), len(starts), [
        None, pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))])
    coded = parts.dictionary_encode()
    number = aligner.numbers(coded.dictionary)
    index = coded.indices.to_numpy()
    first = np.searchsorted(starts, off)
    n = len(off) - 1
    doc, part, often = merged(np.repeat(np.arange(n), np.diff(first)), index, np.ones(len(index), np.int64), len(number))
    part = number[part]
    good = np.ones(n, bool)
    good[doc[~aligner.good[part]]] = False
    keep = good[doc]
    doc, part, often = doc[keep], part[keep], often[keep]
    counts = np.zeros((n, 4), np.int64)
    np.add.at(counts, doc, aligner.n[part] * often[:, None])
    size = aligner.bounds[part + 1] - aligner.bounds[part]
    take = ragged(aligner.bounds[part], size)
    doc, pair, times = merged(np.repeat(doc, size), aligner.links[take].astype(np.int64),
                              aligner.times[take] * np.repeat(often, size), len(aligner.pair_of))
    cut = np.searchsorted(doc, np.arange(n + 1))
    used = number[index]
    shown = [b"".join([aligner.shown[k] for k in used[first[d]:first[d + 1]].tolist()]) if good[d] else b"" for d in range(n)]
    return good, counts, shown, [pair[cut[d]:cut[d + 1]] for d in range(n)], [times[cut[d]:cut[d + 1]] for d in range(n)]


def long_text(aligner: Aligner, data: np.ndarray):
    """As ``texts_of`` for one long text: whether spelt, counts, digest, pairs and times."""
    counts, digest, tail = np.zeros(4, np.int64), hashlib.sha256(), b""
    pairs, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for piece, starts in segments(data):
        good, n, shown, own, often = texts_of(aligner, piece, np.array([0, len(piece)]), starts)
        if not good[0]:
            return False, counts * 0, "", pairs[:0], times[:0]
        counts += n[0]
        digest.update(tail + shown[0][:-1])
        tail = b";"
        own, often = np.concatenate([pairs, own[0]]), np.concatenate([times, often[0]])
        _, pairs, times = merged(np.zeros(len(own), np.int64), own, often, len(aligner.pair_of))
    return True, counts, digest.hexdigest(), pairs, times


def runs(size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``SEGMENT_BYTES``; a longer text is alone."""
    at = 0
    done = np.cumsum(size)
    while at < len(size):
        limit = (done[at - 1] if at else 0) + SEGMENT_BYTES
        end = max(int(np.searchsorted(done, limit, "right")), at + 1)
        yield at, end
        at = end


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str, text_col: str) -> DataFrame:
    """Rows of documents (``links``: their pairs' places in the chunk's list and
    how often, compressed) and rows that list the chunks' pairs."""
    kind = docs.schema[id_col].dataType
    names = ["chunk", "k", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links", "base", "pairs", "held"]

    def flush(chunk: Chunk, name: int, aligner: Aligner) -> Iterator[pa.RecordBatch]:
        n_pairs = len(aligner.pair_of)
        held = np.zeros(n_pairs, np.int64)
        for own in chunk.pairs:
            held[own] += 1
        place = np.cumsum(held > 0) - 1
        n, columns = len(chunk.rows), list(zip(*chunk.rows))
        # places ascend, so that their differences are small
        links = [zlib.compress(np.diff(place[own], prepend=0).astype(np.int32).tobytes() + often.tobytes(), 1)
                 for own, often in zip(chunk.pairs, chunk.times)]
        keys = pa.concat_arrays(chunk.keys)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * n, pa.int64()), keys]
            + [pa.array(c, pa.int64()) for c in columns[:4]] + [pa.array(columns[4], pa.string()), pa.array(links, pa.binary())]
            + [pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64()))], names)
        codes = np.fromiter(aligner.pair_of, np.int64, n_pairs)[held > 0]  # in the order of the numbers
        held = held[held > 0]
        for a in range(0, len(codes), ROW_PAIRS):
            yield pa.RecordBatch.from_arrays(
                [pa.array([name], pa.int64()), pa.nulls(1, keys.type)] + [pa.nulls(1, pa.int64())] * 4
                + [pa.nulls(1, pa.string()), pa.nulls(1, pa.binary()), pa.array([a], pa.int64()),
                   pa.array([codes[a:a + ROW_PAIRS]], pa.list_(pa.int64())),
                   pa.array([held[a:a + ROW_PAIRS]], pa.list_(pa.int64()))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        name = TaskContext.get().partitionId() << 32
        aligner, chunk = Aligner(path_a, path_b), Chunk()
        for batch in batches:
            size = pc.fill_null(pc.binary_length(batch.column("t")), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
            for a, b in runs(size):
                keys = batch.column("k").slice(a, b - a)
                # a text without tokens becomes no bytes at all
                texts = pc.cast(batch.column("t").slice(a, b - a), pa.large_string())
                told = pc.and_kleene(pc.greater(pc.binary_length(texts), 0), pc.invert(pc.match_substring(texts, "▁")))
                texts = pc.if_else(pc.fill_null(told, False), pc.binary_join_element_wise(*map(large, (" ", texts, ""))), large(""))
                data, off = utf8(texts)
                if b - a == 1 and len(data) > SEGMENT_BYTES:
                    good, counts, digest, pairs, times = long_text(aligner, data)
                    chunk.add(keys, [(*counts.tolist(), digest)], [pairs], [times], len(data))
                else:
                    starts = np.union1d(part_starts(data), off[:-1][np.diff(off) > 0])
                    good, counts, shown, pairs, times = texts_of(aligner, data, off, starts)
                    rows = [(*n, hashlib.sha256(x[:-1]).hexdigest() if x else "") for n, x in zip(counts.tolist(), shown)]
                    chunk.add(keys, rows, pairs, times, len(data) + 64 * len(rows))
                if chunk.size >= CHUNK_BYTES or len(aligner.known) >= MEMORY_PARTS:
                    yield from flush(chunk, name, aligner)
                    name, chunk = name + 1, Chunk()
                    if len(aligner.known) >= MEMORY_PARTS:
                        aligner.forget()
                    release_memory()
        if chunk.rows:
            yield from flush(chunk, name, aligner)

    return docs.select(F.col(id_col).alias("k"), F.col(text_col).alias("t")).mapInArrow(
        run, f"chunk long, k {kind.simpleString()}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
             "links binary, base long, pairs array<long>, held array<long>")


def alignment(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256`` of every document."""
    scratch = Scratch(docs.sparkSession, "alignment")
    made = scratch.table(aligned(docs, path_a, path_b, id_col, text_col), "chunks")
    asked = made.where(F.col("base").isNotNull()).select("chunk", "base", F.posexplode(F.arrays_zip("pairs", "held"))).select(
        "chunk", (F.col("base") + F.col("pos")).alias("place"), F.col("col.pairs").alias("pair"), F.col("col.held").alias("held"))
    counts = scratch.table(pair_counts(asked), "counts")
    answers = asked.select("chunk", "place", "pair").join(counts, "pair").select(
        F.col("chunk").alias("to"), "place", "count", "best")
    kind = docs.schema[id_col].dataType.simpleString()

    def settle(rows: pa.Table, told: pa.Table) -> pa.Table:
        count, best = np.zeros(told.num_rows, np.int64), np.zeros(told.num_rows, np.int64)
        place = told.column("place").to_numpy()
        count[place], best[place] = told.column("count").to_numpy(), told.column("best").to_numpy(zero_copy_only=False)
        n_best, total = np.zeros(rows.num_rows, np.int64), np.zeros(rows.num_rows, np.int64)
        for i, blob in enumerate(rows.column("links").to_pylist()):
            x = zlib.decompress(blob)
            own = np.cumsum(np.frombuffer(x, np.int32, len(x) // 12))
            often = np.frombuffer(x, np.int64, len(x) // 12, 4 * (len(x) // 12))
            n_best[i], total[i] = often @ best[own], often @ count[own]
        return (rows.select(["k", "n_a", "n_b", "n_groups", "n_links"]).append_column("n_best", pa.array(n_best))
                .append_column("count_sum", pa.array(total)).append_column("groups_sha256", rows.column("groups_sha256")))

    return (made.where(F.col("base").isNull()).drop("base", "pairs", "held").groupBy("chunk")
            .cogroup(answers.groupBy("to"))
            .applyInArrow(settle, f"k {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                                  "groups_sha256 string").withColumnRenamed("k", id_col))


def pair_counts(asked: DataFrame) -> DataFrame:
    """``pair``, its ``count`` of documents, and ``best``: 1 if no pair of its first id has a higher count."""
    counts = asked.groupBy("pair").agg(F.sum("held").alias("count")).withColumn("first", F.shiftright("pair", 32))
    highest = counts.groupBy("first").agg(F.max("count").alias("highest"))  # a row per id of the vocabulary at most
    return counts.join(F.broadcast(highest), "first").select(
        "pair", "count", (F.col("count") == F.col("highest")).cast("long").alias("best"))
