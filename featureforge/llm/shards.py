"""Shards of near-equal size by minimax contiguous partition.

Documents with equal texts are one atomic group.  Groups stand in the order of
their text's MD5; a contiguous partition of that order into ``n_shards`` runs
with the smallest possible largest run is found by binary search over the
capacity: a capacity is feasible if filling shards greedily up to it uses no
more than ``n_shards``.  The shards are then cut there; among the cuts that
the capacity leaves open, each is the one nearest below an even share of what
remains, so that no shard stays empty without need.

Groups, their running sums and all look-ups are DataFrame operations: a greedy
step asks for the last running sum that does not exceed a position, for many
capacities at a time, and reads only the running sums within one group size of
the positions.  Shards are contiguous in the text hash, so a document's shard
is a comparison with at most ``n_shards - 1`` literals and needs no join.
Slots number a shard's rows without gaps through counts per input partition.

Defined cases: a null text is an empty one (size 1, CRC 0); repeated rows and
rows without an id are rows like others; an empty table gives no rows; a group
larger than an even share gets a shard to itself and its neighbours as far as
the capacity, which then is its size, allows; fewer groups than shards leave
shards empty; only the id and text columns are read, so extra columns cannot
clash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featureforge.llm.scratch import Scratch

N_SHARDS = 8
#: Capacities tried at a time, and hex digits of the hash that name a bucket of groups.
PROBES = 256
BUCKET_DIGITS = 3
#: Groups a task sums at a time, about.
TASK_GROUPS = 1 << 20


class RunningSums:
    """Groups (``digest``, ``size``) in digest order with their running sum ``end``."""

    def __init__(self, scratch: Scratch, sizes: DataFrame):
        groups = scratch.table(sizes.groupBy("digest").agg(F.sum("size").alias("size"))
                               .withColumn("bucket", F.substring("digest", 1, BUCKET_DIGITS)), "groups")
        buckets = groups.groupBy("bucket").agg(F.sum("size").alias("own"))  # at most 16 ** BUCKET_DIGITS rows
        before = buckets.select("bucket", (F.sum("own").over(Window.orderBy("bucket")) - F.col("own")).alias("before"))
        facts = groups.agg(F.count("size").alias("n"), F.sum("size").alias("total"), F.max("size").alias("most")).first()
        self.total, self.most = facts["total"] or 0, facts["most"] or 0
        tasks = max(1, -(-facts["n"] // TASK_GROUPS))
        inside = F.sum("size").over(Window.partitionBy("bucket").orderBy("digest"))
        self.rows = scratch.table(groups.repartitionByRange(tasks, "bucket").withColumn("inside", inside)
                                  .join(F.broadcast(before), "bucket")
                                  .select("digest", (F.col("before") + F.col("inside")).alias("end")), "sums")

    def _asked(self, positions: list[int], agg, low: int, high: int, slot) -> dict[int, int]:
        found = self.rows.where(F.col("end").between(low, high)).groupBy(slot.alias("slot")).agg(agg.alias("end"))
        return {r["slot"]: r["end"] for r in found.collect()}  # one row per position at most

    def last_up_to(self, positions: list[int]) -> list[int]:
        """The largest running sum (or 0) not above each position."""
        marks = sorted(set(positions))
        below = F.size(F.filter(F.array(*[F.lit(m) for m in marks]), lambda x: x < F.col("end")))
        found = self._asked(marks, F.max("end"), marks[0] - self.most, marks[-1], below)
        best, out = 0, {}
        for i, m in enumerate(marks):
            best = max(best, found.get(i, 0))
            out[m] = best
        return [out[p] for p in positions]

    def first_from(self, position: int) -> int:
        """The smallest running sum not below a position (0 for none above 0)."""
        if position <= 0:
            return 0
        return self.rows.where(F.col("end").between(position, position + self.most)).agg(F.min("end")).first()[0]

    def digests(self, ends: list[int]) -> dict[int, str]:
        rows = self.rows.where(F.col("end").isin(ends)).collect() if ends else []  # one row per cut
        return {r["end"]: r["digest"] for r in rows}


def smallest_capacity(sums: RunningSums, n_shards: int, probes: int = PROBES) -> int:
    """The smallest capacity that greedy filling does not exceed."""
    low = max(sums.most, -(-sums.total // n_shards))  # nothing smaller is feasible
    high = max(low, min(sums.total, -(-sums.total // n_shards) + sums.most))  # feasible: no shard stays a group short of it
    while low < high:
        # capacities in [low, high), high is known to do
        tried = sorted({low + (high - low) * i // probes for i in range(probes)})
        ends = [0] * len(tried)
        for _ in range(n_shards):
            asked = [min(e + c, sums.total) for e, c in zip(ends, tried)]
            ends = sums.last_up_to(asked)
            if ends[0] == sums.total:  # the smallest does
                break
        fits = [c for c, e in zip(tried, ends) if e == sums.total]
        high = fits[0] if fits else high
        low = max([c + 1 for c in tried if c < high], default=low)
    return high


def cuts(sums: RunningSums, n_shards: int, capacity: int) -> list[int]:
    """Running sums after which a new shard begins, ``n_shards - 1`` of them."""
    earliest = [sums.total]
    for _ in range(n_shards - 1):  # how early a shard may end, seen from the last
        earliest.append(sums.first_from(earliest[-1] - capacity))
    earliest = earliest[::-1]
    out, start = [], 0
    for k in range(n_shards - 1):
        even = start + -(-(sums.total - start) // (n_shards - k))
        start = max(earliest[k], sums.last_up_to([min(start + capacity, even)])[0], start)
        out.append(start)
    return out


def shard(docs: DataFrame, n_shards: int = N_SHARDS, id_col: str = "doc_id", text_col: str = "text",
          probes: int = PROBES) -> DataFrame:
    """id, ``size``, ``text_crc32``, ``digest`` (the group), ``shard`` and ``slot`` of every document."""
    scratch = Scratch(docs.sparkSession, "shards")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = scratch.table(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.md5(text).alias("digest"),
        F.monotonically_increasing_id().alias("row")), "rows")
    sums = RunningSums(scratch, rows)
    ends = cuts(sums, n_shards, smallest_capacity(sums, n_shards, probes)) if sums.total else []
    digest = sums.digests(sorted({e for e in ends if e}))
    # a shard begins after the digest of each cut; a cut at 0 leaves the shards before it empty
    number = sum(((F.col("digest") > digest[e]).cast("int") if e else F.lit(1) for e in ends), F.lit(0))
    placed = rows.withColumn("shard", number.cast("int")).withColumn("part", F.shiftright("row", 33))
    counted = placed.groupBy("shard", "part").agg(F.count("row").alias("own"))
    before = counted.select("shard", "part", (F.sum("own").over(
        Window.partitionBy("shard").orderBy("part")) - F.col("own")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("row")) - 1
    return (placed.withColumn("inside", inside).join(before, ["shard", "part"])
            .select(F.col("id").alias(id_col), "size", "text_crc32", "digest", "shard",
                    (F.col("before") + F.col("inside")).cast("long").alias("slot")))
