"""Benchmark decontamination with an FM-index per training shard.

A benchmark item is cut into windows of ``size`` consecutive words (an item of
fewer words is one window).  A task reads its documents, keeps the runs of
words that occur in the benchmark at all and are long enough to hold a window
(no window can cross another word, so nothing is lost), and builds an FM-index
over those runs: backward search with wavelet-tree ranks finds every window,
sampled suffix positions locate its occurrences, and overlapping occurrences
merge into removal spans.  Documents are not shuffled.

The benchmark is taken in blocks of at most ``BLOCK_BYTES`` of text, each sent
to the tasks in turn, so what is broadcast is bounded; several blocks' spans
are merged per document afterwards.

Defined cases: null or empty documents have no words and no hits; null or
empty items have no windows; items without an id count for hits but are not
listed; repeated item ids are listed once; an empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureforge.llm.fmindex import FMIndex
from featureforge.llm.scratch import text_bytes
from featureforge.llm.words import NON_ALNUM, Words, blocks

#: Benchmark text in one block of windows.
BLOCK_BYTES = 4 << 20
#: Words of one shard's index at most (a longer document has an index of its own).
SHARD_WORDS = 1 << 20


class Phrases:
    """Distinct windows of a block of benchmark items."""

    def __init__(self, rows: list, size: int):
        words = Words(pa.array([r["text"] for r in rows], pa.string()), True, NON_ALNUM)
        self.vocabulary = words.distinct
        seen: dict[tuple, set] = {}
        for k, r in enumerate(rows):
            s = words.index[words.first[k]:words.first[k + 1]].tolist()
            for w in ([tuple(s)] if len(s) < size else [tuple(s[i:i + size]) for i in range(len(s) - size + 1)]):
                if w:
                    seen.setdefault(w, set()).add(r["item"])
        self.length = np.array([len(w) for w in seen], np.int64)
        self.symbols = np.zeros((len(seen), size), np.int64)
        for k, w in enumerate(seen):
            self.symbols[k, :len(w)] = np.array(w) + 1  # 0: a word that no item has
        names = sorted({i for items in seen.values() for i in items if i is not None})
        number = {x: i for i, x in enumerate(names)}
        self.items = names
        lists = [sorted(number[i] for i in items if i is not None) for items in seen.values()]
        self.n_items = np.array([len(x) for x in lists], np.int64)
        self.first_item = np.concatenate([[0], np.cumsum(self.n_items)]).astype(np.int64)
        self.item = np.array([i for x in lists for i in x], np.int64)


class Shard:
    """Documents whose runs of benchmark words wait for one index."""

    def __init__(self, phrases: Phrases):
        self.p = phrases
        self.least = int(phrases.length.min()) if len(phrases.length) else 1 << 62
        self.clear()

    def clear(self):
        self.ids, self.row_hash, self.n_words, self.symbols, self.doc, self.place = [], [], [], [], [], []
        self.n_docs = self.size = 0

    def add(self, block: pa.RecordBatch) -> None:
        words = Words(block.column("t"), True, NON_ALNUM)
        known = pc.fill_null(pc.index_in(words.distinct, value_set=self.p.vocabulary), -1).to_numpy() + 1
        symbol = known[words.index].astype(np.int64) if len(words.index) else np.zeros(0, np.int64)
        doc = words.doc_of()
        # runs of known words inside a document
        new = np.ones(len(symbol), bool)
        new[1:] = (doc[1:] != doc[:-1]) | ((symbol[1:] > 0) != (symbol[:-1] > 0))
        run = np.cumsum(new) - 1
        long = np.bincount(run, minlength=1) >= self.least
        keep = (symbol > 0) & long[run] if len(symbol) else np.zeros(0, bool)
        at = np.flatnonzero(keep)
        # a foreign symbol ends every run
        end = np.ones(len(at), bool)
        end[:-1] = run[at[1:]] != run[at[:-1]]
        spot = np.arange(len(at)) + np.concatenate([[0], np.cumsum(end)[:-1]]) if len(at) else at
        n = len(at) + int(end.sum())
        text, owner, place = np.zeros(n, np.int64), np.full(n, -1, np.int64), np.zeros(n, np.int64)
        text[spot] = symbol[at]
        owner[spot] = doc[at] + self.n_docs
        place[spot] = at - words.first[doc[at]]
        self.symbols.append(text)
        self.doc.append(owner)
        self.place.append(place)
        self.ids.append(block.column("k"))
        self.row_hash.append(block.column("h"))
        self.n_words.append(words.counts())
        self.n_docs += block.num_rows
        self.size += n

    def flush(self) -> pa.RecordBatch:
        n_words = np.concatenate(self.n_words)
        doc, place = np.concatenate(self.doc), np.concatenate(self.place)
        text = np.concatenate(self.symbols)
        spans: list[list] = [[] for _ in range(self.n_docs)]
        items: list[list] = [[] for _ in range(self.n_docs)]
        hit = np.zeros(self.n_docs, np.int64)
        if len(text):
            index = FMIndex(text)
            lo, hi = index.search(self.p.symbols, self.p.length)
            count = hi - lo
            phrase = np.repeat(np.arange(len(count)), count)
            row = np.arange(len(phrase)) - np.repeat(np.cumsum(count) - count, count) + lo[phrase]
            at = index.locate(row)
            edge = np.zeros(len(text) + 1, np.int64)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + self.p.length[phrase], -1)
            covered = np.cumsum(edge[:-1]) > 0
            hit = np.bincount(doc[covered], minlength=self.n_docs)
            change = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(np.int8), [0]])))
            for a, b in zip(change[::2].tolist(), change[1::2].tolist()):
                spans[doc[a]].append((int(place[a]), int(place[b - 1]) + 1))
            n = self.p.n_items[phrase]
            which = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.p.first_item[phrase], n)
            pair = np.unique(np.repeat(doc[at], n) * max(len(self.p.items), 1) + self.p.item[which])
            for x in pair.tolist():
                items[x // len(self.p.items)].append(self.p.items[x % len(self.p.items)])
        out = pa.RecordBatch.from_arrays(
            [pa.chunked_array(self.ids).combine_chunks(), pa.chunked_array(self.row_hash).combine_chunks(), pa.array(n_words, pa.int64()), pa.array(hit, pa.int64()),
             pa.array(items, pa.list_(pa.string())),
             pa.array([[{"first": a, "last": b - 1} for a, b in s] for s in spans],
                      pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])))],
            ["k", "h", "n_words", "n_hit", "items", "spans"])
        self.clear()
        return out


def _one_block(docs: DataFrame, rows: list, size: int, kind: str) -> DataFrame:
    phrases = docs.sparkSession.sparkContext.broadcast(Phrases(rows, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = Shard(phrases.value)
        for batch in batches:
            for block in blocks(batch, "t"):
                shard.add(block)
                if shard.size >= SHARD_WORDS or shard.n_docs >= SHARD_WORDS // 16:
                    yield shard.flush()
        if shard.n_docs:
            yield shard.flush()

    return docs.mapInArrow(run, f"k {kind}, h long, n_words long, n_hit long, items array<string>, "
                                "spans array<struct<first: long, last: long>>")


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 13, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per document: ``n_words``, ``n_hit`` (words inside an occurring window),
    ``items`` (ids as sorted strings) and ``spans`` (first and last word of
    each merged removal span)."""
    kind = docs.schema[id_col].dataType.simpleString()
    keyed = docs.select(F.col(id_col).alias("k"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("t"))
    bench = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(item_text).alias("text"))
    n_blocks = text_bytes(bench, "text") // BLOCK_BYTES + 1
    block_of = F.pmod(F.xxhash64("text"), F.lit(n_blocks))
    parts = [_one_block(keyed, bench.where(block_of == b).collect(), size, kind) for b in range(n_blocks)]
    out = parts[0]
    if n_blocks > 1:
        for p in parts[1:]:
            out = out.unionByName(p)
        # Spans of several blocks may overlap: merge them in each document.
        merged = F.aggregate(
            F.array_sort(F.flatten(F.collect_set("spans"))),
            F.array().cast("array<struct<first: long, last: long>>"),
            lambda acc, s: F.when((F.size(acc) > 0) & (F.element_at(acc, -1)["last"] + 1 >= s["first"]),
                                  F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                                           F.array(F.struct(
                                               F.element_at(acc, -1)["first"].alias("first"),
                                               F.greatest(F.element_at(acc, -1)["last"], s["last"]).alias("last")))))
            .otherwise(F.concat(acc, F.array(s))))
        # Equal rows give equal spans; each comes back as often as it came in.
        out = (out.groupBy("k", "h").agg(F.max("n_words").alias("n_words"), merged.alias("spans"),
                                         F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
                                         (F.count("*") / n_blocks).cast("int").alias("copies"))
               .select("k", "n_words", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"),
                       F.aggregate("spans", F.lit(0).cast("long"),
                                   lambda acc, s: acc + s["last"] - s["first"] + 1).alias("n_hit"), "items", "spans"))
    return out.select(F.col("k").alias(id_col), "n_words", "n_hit", "items", "spans")


def with_verdict(found: DataFrame) -> DataFrame:
    """Adds ``n_items``, ``items_sha256`` and ``contaminated`` (hit words are at
    least a twentieth of all words)."""
    return found.select(
        "*", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))).alias("contaminated"))


def oracle_sql(size: int = 13) -> str:
    """DuckDB SQL of the contract's rows."""
    def split(table, key):
        return (f"SELECT {key}, list_filter(regexp_split_to_array(translate(coalesce(text, ''), "
                "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
                f"'[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS ws FROM {table}")
    return f"""
WITH d AS ({split('documents', 'doc_id')}),
b AS ({split('benchmark', 'item_id')}),
bw AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, least(len(ws), {size}) AS n,
              array_to_string(ws[i:i + least(len(ws), {size}) - 1], ' ') AS g
       FROM (SELECT *, unnest(range(1, greatest(len(ws) - {size} + 1, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS g
       FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, sizes WHERE len(ws) >= n)),
hit AS (SELECT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw USING (n, g)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
       FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN it USING (doc_id)
"""
