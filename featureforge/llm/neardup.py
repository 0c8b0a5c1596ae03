"""Near-duplicate documents by HyperMinHash registers.

1. Each document's set of distinct word shingles is hashed into ``REGISTERS``
   buckets.  A bucket keeps its smallest hash, stored in 16 bits: the number of
   leading zeros and ten mantissa bits.  Buckets left empty by a small set are
   filled by further hashing rounds, so a register agrees with probability
   equal to the similarity for sets of any size.
2. Documents with equal sets form a class; its smallest id stands for it.
3. Bands of ``BAND`` consecutive registers are bucket keys.  At the threshold a
   pair shares none of the bands with a probability of 1e-10.  A bucket's
   smallest id is its hub, and every document is compared with its hubs.
4. A pair's similarity is estimated from its registers, corrected for chance
   collisions of the compressed registers; pairs at six standard deviations
   below the threshold are dropped, the others are verified on full sets.
5. Two documents that share a bucket share its hub, so what the hubs left open
   are pairs of one hub's documents in different components.  The documents
   outside a hub's largest component meet all its documents in blocks of about
   ``BLOCK_BYTES``; pairs that pass the estimate are verified, the likeliest
   first, until the components meet.  Pairs inside a component need no test, so
   a large group of copies costs one comparison per document, and no task holds
   a whole large group.

Defined cases: texts without words have an empty set and link with nothing; a
text of fewer words than a shingle is one shingle; rows without an id get no
component and are kept; repeated rows share a class; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureforge.llm.components import components
from featureforge.llm.scratch import Scratch
from featureforge.llm.words import Words, blocks, mix, window_hashes

REGISTERS = 126
BAND = 3
MANTISSA_BITS = 10
#: Bytes of sets on one side of a block of comparisons.
BLOCK_BYTES = 4 << 20
#: Ids sent to all tasks at most; beyond that the texts are joined by shuffle.
BROADCAST_IDS = 1 << 20

_FACTOR = 0x9E3779B97F4A7C15
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(col, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and their bounds."""
    words = Words(col, lower=True)
    h = words.hashes()
    every = window_hashes(h, size, _FACTOR)
    sets = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        n = b - a
        if n == 0:
            sets.append(h[:0])
        elif n < size:
            sets.append(mix(window_hashes(h[a:b], n, _FACTOR) + np.uint64(n)))
        else:
            s = np.sort(every[a:b - size + 1])
            keep = np.ones(len(s), bool)
            keep[1:] = s[1:] != s[:-1]
            sets.append(s[keep])
    bounds = np.zeros(len(sets) + 1, np.int64)
    np.cumsum([len(s) for s in sets], out=bounds[1:])
    return (np.concatenate(sets) if sets else h[:0]), bounds


def registers(h: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """HyperMinHash registers (documents x REGISTERS, uint16) of non-empty sets."""
    n_docs = len(bounds) - 1
    low = np.full(n_docs * REGISTERS, _EMPTY)
    todo, first, rounds = np.arange(n_docs), 0, 1
    while len(todo):
        size = bounds[todo + 1] - bounds[todo]
        at = np.arange(int(size.sum())) + np.repeat(bounds[todo] - np.cumsum(size) + size, size)
        element, slot = h[at], np.repeat(todo * REGISTERS, size)
        for r in range(first, first + rounds):
            x = mix(element + np.uint64((r * _FACTOR) & 0xFFFFFFFFFFFFFFFF))
            bucket = ((x >> np.uint64(32)) * np.uint64(REGISTERS)) >> np.uint64(32)
            value = (mix(x) >> np.uint64(16)) | np.uint64(min(r, 0xFFFE) << 48)
            np.minimum.at(low, slot + bucket.astype(np.int64), value)
        first += rounds
        rounds = min(first, 64)
        empty = (low.reshape(n_docs, REGISTERS)[todo] == _EMPTY).any(axis=1)
        todo = todo[empty & (size > 0)]
    r = (low >> np.uint64(48)).astype(np.int64)
    part, exponent = np.frexp((low & np.uint64((1 << 48) - 1)).astype(np.float64))
    zeros = np.minimum(48 - exponent, 47)
    mantissa = np.maximum((part * 2 - 1) * (1 << MANTISSA_BITS), 0).astype(np.int64)
    top = ((low >> np.uint64(38)) & np.uint64((1 << MANTISSA_BITS) - 1)).astype(np.int64)
    code = np.where(r == 0, (zeros << MANTISSA_BITS) | mantissa, ((48 + np.minimum(r, 15)) << MANTISSA_BITS) | top)
    return code.astype(np.uint16).reshape(n_docs, REGISTERS)


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """(k, n, d1, d2, regs) per document (columns k, t)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "t", 3 << 20):
                h, bounds = shingle_sets(block.column("t"), size)
                regs = registers(h, bounds)
                digests = []
                for f in (0x94D049BB133111EB, 0xD6E8FEB86659FD93):
                    total = np.zeros(len(h) + 1, np.uint64)
                    np.cumsum(mix(h * np.uint64(f)), out=total[1:])
                    digests.append(pa.array((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [block.column("k"), pa.array(np.diff(bounds)), *digests,
                     pa.array([r.tobytes() for r in regs], pa.binary())], ["k", "n", "d1", "d2", "regs"])

    return docs.mapInArrow(run, "k long, n long, d1 long, d2 long, regs binary")


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One 64-bit key per document and band."""
    r = regs.astype(np.uint64).reshape(len(regs), -1, BAND)
    key = np.arange(r.shape[1], dtype=np.uint64)[None, :]
    for k in range(BAND):
        key = mix(key * np.uint64(_FACTOR) + r[:, :, k])
    return key


def bands(reps: DataFrame) -> DataFrame:
    """(key, k): every band of every representative."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                key = band_keys(_matrix(batch.column("regs")))
                k = np.repeat(batch.column("k").to_numpy(), key.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(k)], ["key", "k"])

    return reps.select("k", "regs").mapInArrow(run, "key long, k long")


def estimate(matches: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Similarity from agreeing registers, less the chance collisions of
    compressed registers (0.72 * 2^-mantissa * nm / (n + m)^2)."""
    chance = 0.7213 * 2.0 ** -MANTISSA_BITS * n * m / (n + m) ** 2
    return (matches / REGISTERS - chance) / (1 - chance)


def lowest_estimate(threshold: float) -> float:
    return threshold - 6 * math.sqrt(threshold * (1 - threshold) / REGISTERS)


def estimated(pairs: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose estimate allows the threshold."""
    floor = lowest_estimate(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                same = (_matrix(batch.column("ra")) == _matrix(batch.column("rb"))).sum(axis=1)
                ok = estimate(same, batch.column("na").to_numpy(), batch.column("nb").to_numpy()) >= floor
                yield batch.select(["a", "b"]).filter(pa.array(ok))

    side = {x: reps.select(F.col("k").alias(x), F.col("n").alias("n" + x), F.col("regs").alias("r" + x))
            for x in ("a", "b")}
    return pairs.join(side["a"], "a").join(side["b"], "b").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with 100 * intersection >= percent * union of their sets."""
    side = {x: sets.select(F.col("k").alias(x), F.col("shingles").alias("s" + x)) for x in ("a", "b")}
    common = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(side["a"], "a").join(side["b"], "b")
            .select("a", "b", common.alias("c"), (F.size("sa") + F.size("sb")).alias("n"))
            .where(F.col("c") * 100 >= (F.col("n") - F.col("c")) * percent).select("a", "b"))


def full_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(k, shingles) of the documents in ``ids``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "t"):
                h, bounds = shingle_sets(block.column("t"), size)
                yield pa.RecordBatch.from_arrays(
                    [block.column("k"), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(h.view(np.int64)))],
                    ["k", "shingles"])

    ids = ids.select("k").distinct()
    few = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, "k", "left_semi").mapInArrow(run, "k long, shingles array<long>")


def open_links(members: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Verified links (a, b) between components, among each hub's documents
    (hub, k, comp): enough of them to join all components that a link joins."""
    floor = lowest_estimate(percent / 100)
    sized = members.join(reps.select("k", "n"), "k")
    per = sized.groupBy("hub", "comp").agg(F.count("*").alias("c"), F.sum("n").alias("n"))
    blocks_of = lambda n: F.ceil(n * 8 / BLOCK_BYTES).cast("int")
    mixed = (per.groupBy("hub").agg(F.count("*").alias("comps"), F.sum("n").alias("n"),
                                    F.max(F.struct("c", "comp", "n")).alias("top")).where("comps > 1")
             .select("hub", F.col("top.comp").alias("main"), blocks_of(F.col("n")).alias("many"),
                     blocks_of(F.col("n") - F.col("top.n")).alias("few")))
    rows = members.join(mixed, "hub").join(reps.select("k", "n", "regs"), "k").join(sets, "k")
    part = F.xxhash64("k")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ("k", "comp", "n", "regs", "shingles")
    many = rows.select("hub", F.pmod(part, "many").cast("int").alias("i"), every("few").alias("j"),
                       F.lit(False).alias("is_few"), *columns)
    few = rows.where("comp <> main").select("hub", every("many").alias("i"), F.pmod(part, "few").cast("int").alias("j"),
                                            F.lit(True).alias("is_few"), *columns)

    def run(table: pa.Table) -> pa.Table:
        is_few = table.column("is_few").to_numpy()
        k, comp, n = (table.column(c).to_numpy() for c in ("k", "comp", "n"))
        regs = _matrix(table.column("regs"))
        own = [x.values.to_numpy() for x in table.column("shingles")]
        above: dict[int, int] = {}

        def root(c):
            while c in above:
                c = above[c]
            return c

        links = []
        others = np.flatnonzero(~is_few)
        for x in np.flatnonzero(is_few).tolist():
            guess = estimate((regs[others] == regs[x]).sum(axis=1), n[others], n[x])
            at = np.flatnonzero((guess >= floor) & (comp[others] != comp[x]))
            for y in others[at[np.argsort(-guess[at], kind="stable")]].tolist():
                a, b = root(int(comp[x])), root(int(comp[y]))
                if a == b:
                    continue
                both = np.concatenate([own[x], own[y]])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                if 100 * common >= percent * (len(both) - common):
                    above[max(a, b)] = min(a, b)
                    links.append((int(k[x]), int(k[y])))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return many.union(few).groupBy("hub", "i", "j").applyInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 75, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """id, ``n_shingles``, ``component_id`` (smallest id reachable) and ``kept``."""
    threshold = percent / 100
    scratch = Scratch(docs.sparkSession, "neardup")
    keyed = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).alias("t"))
    signed = scratch.table(signatures(keyed, size), "signatures")
    sets_of = signed.where("n > 0 AND k IS NOT NULL")
    classes = sets_of.groupBy("d1", "d2", "n").agg(F.min(F.struct("k", "regs")).alias("rep"))
    reps = scratch.table(classes.select("d1", "d2", "n", "rep.k", "rep.regs"), "classes")

    every = bands(reps)
    hubs = every.groupBy("key").agg(F.min("k").alias("hub"), F.count("*").alias("c")).where("c > 1")
    hubs = scratch.table(every.join(hubs, "key").select("hub", "k").distinct(), "hubs")
    star = hubs.where("k <> hub").select(F.col("hub").alias("a"), F.col("k").alias("b"))
    sets = scratch.table(full_sets(keyed.where("k IS NOT NULL"), hubs, size).dropDuplicates(["k"]), "sets")
    links = scratch.table(verified(estimated(star, reps, threshold), sets, percent), "links")
    comps = components(links, scratch, "star")
    members = hubs.join(comps, "k", "left").select("hub", "k", F.coalesce("comp", "k").alias("comp"))
    more = scratch.table(open_links(members, reps, sets, percent), "more")
    if not more.isEmpty():
        comps = components(links.union(more), scratch, "all")

    of_class = reps.select("d1", "d2", "n", F.col("k").alias("rep")).join(
        comps.withColumnRenamed("k", "rep"), "rep", "left").select("d1", "d2", "n", F.coalesce("comp", "rep").alias("comp"))
    out = signed.select("k", "n", "d1", "d2").join(of_class, ["d1", "d2", "n"], "left")
    component = F.when(F.col("n") > 0, F.coalesce("comp", "k")).otherwise(F.col("k"))
    return out.select(F.col("k").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("k").isNotNull(), component).alias("component_id"),
                      F.coalesce(F.col("k") == component, F.lit(True)).alias("kept"))


def oracle_sql(size: int = 5, percent: int = 75) -> str:
    """DuckDB SQL of the contract's rows."""
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS ws
     FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + {size - 1}], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {size - 1}, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS seen FROM w UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.seen),
c AS (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY doc_id)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
"""
