"""Prefix trie of conversations from the longest common prefixes of sorted neighbours.

A turn is the MD5 of its role and text, a conversation the sequence of its
turns.  Conversations are sorted; the longest common prefix (LCP) of two
neighbours is an edge between them.  A task takes its edges by descending depth
through a union-find: the merge of two components creates the branching node at
that depth (or joins one that is there already), and a component that is merged
climbs from its last node to the new one, which yields the nodes between.

Nodes on the path of a task's first or last conversation may go on in the
neighbouring tasks.  They are not finished but contracted to two paths that
hold, per depth, what the finished parts of their subtrees add up to.  The paths
of neighbouring tasks are sorted strings again, so the same function merges
some of them, round by round, until one task holds the rest; its size follows
the number of tasks of the round before.

A conversation of more than ``segment`` turns is several strings: a segment's
trie is rooted at the node where the segment before it ends (its first element
is the hash of all turns before), and the totals of that root are added to that
node when the level above is built.

Only hashes, lengths and numbers travel, never texts.  Defined cases: turns
are ordered by ``turn`` (null first), equal ones by role and then by the hash of
the text; repeated rows are turns like others; a null role or text is empty; rows
without a conversation id are left out; an empty table gives no nodes; extra
columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featureforge.llm.scratch import Scratch

#: Turns of a string at most; strings of a task about; contracted paths merged at a time.
SEGMENT = 1024
TASK_STRINGS = 1 << 14
TASK_TURNS = 1 << 18
FAN = 64
HEX = 32
NO_ID = np.iinfo(np.int64).max

NODE = "depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, " \
       "root long, end_key string, own_key string, parent_key string"
WEIGHTS = ("n", "least", "children", "leaves", "saved", "root")
PATH = "place long, string string, lens array<long>, " + ", ".join(f"w_{w} array<long>" for w in WEIGHTS) + ", w_end array<string>"
NODE_NAMES = [x.split()[0] for x in NODE.split(", ")]
PATH_NAMES = [x.split()[0] for x in PATH.split(", ")]


class Sums:
    """What the subtree below a node adds up to so far."""

    __slots__ = (*WEIGHTS, "end")

    def __init__(self, n=0, least=NO_ID, children=0, leaves=0, saved=0, root=NO_ID, end=None):
        self.n, self.least, self.children, self.leaves, self.saved = n, least, children, leaves, saved
        self.root, self.end = root, end  # of the node alone: the segments that go on from it, the key of its conversations

    def add(self, o: "Sums") -> None:
        self.n += o.n
        self.least = min(self.least, o.least)
        self.children += o.children
        self.leaves += o.leaves
        self.saved += o.saved
        self.root = min(self.root, o.root)
        self.end = self.end or o.end


def common(strings: list[str], lengths: np.ndarray) -> np.ndarray:
    """Elements that each string shares with the next."""
    if len(strings) < 2:
        return np.zeros(0, np.int64)
    data = np.frombuffer("".join(strings).encode(), f"S{HEX}")
    first = np.concatenate([[0], np.cumsum(lengths)])
    size = np.minimum(lengths[:-1], lengths[1:])
    start = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(start[-1]) - np.repeat(start[:-1], size)
    differs = data[np.repeat(first[:-2], size) + at] != data[np.repeat(first[1:-1], size) + at]
    where = np.flatnonzero(differs)
    k = np.searchsorted(where, start[:-1])
    nearest = np.append(where, start[-1])[k]
    return np.minimum(nearest - start[:-1], size)


class Forest:
    """Trie nodes of sorted strings.  ``ends[i]`` are the sums at string i's
    last element; ``inner[i]``, if given, those at each element before."""

    def __init__(self, strings: list[str], lens: list, ends: list[Sums], inner: list | None, last: bool):
        self.strings, self.lens, self.inner, self.last = strings, lens, inner, last
        self.size = np.fromiter((len(s) // HEX for s in strings), np.int64, len(strings))
        n = len(strings)
        self.depth = self.size.tolist()          # of each node
        self.sums = ends                         # of each node
        self.low, self.high = list(range(n)), list(range(n))  # the strings below each node
        self.weighted = [[i] for i in range(n)] if inner else None
        self.alias = list(range(n))              # nodes that are the same one
        self.rows: list[tuple] = []
        self.up: list[int] = []                  # the row's parent: a row (>= 0) or a node (~node)
        self.row_of: dict[int, int] = {}         # of a finished node
        self.paths: dict[int, dict[int, Sums]] = {0: {}, n - 1: {}} if not last else {}
        self._merge(common(strings, self.size))

    def _find(self, parent: list[int], i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def _merge(self, edges: np.ndarray) -> None:
        n = len(self.strings)
        parent, node = list(range(n)), list(range(n))  # union-find; the top node of each component
        for e in np.argsort(-edges, kind="stable").tolist():
            depth = int(edges[e])
            a, b = self._find(parent, e), self._find(parent, e + 1)
            if self.depth[node[a]] > depth and self.depth[node[b]] > depth:
                top = self._branch(depth, node[a], node[b])
            elif self.depth[node[a]] > depth:
                top = self._join(node[b], node[a])
            else:
                top = self._join(node[a], node[b])
            if self.high[node[a]] - self.low[node[a]] < self.high[node[b]] - self.low[node[b]]:
                a, b = b, a
            parent[b] = a
            node[a] = top
        if n:
            self._climb(node[self._find(parent, 0)], 0)
        for r, up in enumerate(self.up):  # the parents are finished now
            if up < 0:
                up = self._named(~up)
                row = self.row_of.get(up)
                self.up[r] = row if row is not None else ~up

    def _named(self, x: int) -> int:
        while self.alias[x] != x:
            x = self.alias[x]
        return x

    def _branch(self, depth: int, a: int, b: int) -> int:
        """A new node at ``depth`` above two components."""
        x = len(self.depth)
        self.depth.append(depth)
        self.sums.append(Sums())
        self.low.append(min(self.low[a], self.low[b]))
        self.high.append(max(self.high[a], self.high[b]))
        self.alias.append(x)
        if self.inner:
            self.weighted.append([])
        self._attach(x, a)
        self._attach(x, b)
        if self.inner:
            self._weigh(self.sums[x], self.weighted[x], depth)
        return x

    def _join(self, x: int, y: int) -> int:
        """Component ``y`` meets node ``x``: below it, or the same node."""
        depth = self.depth[x]
        self.low[x], self.high[x] = min(self.low[x], self.low[y]), max(self.high[x], self.high[y])
        if self.depth[y] == depth:
            self.sums[x].add(self.sums[y])
            self.alias[y] = x
            if self.inner:
                self.weighted[x] += self.weighted[y]
        else:
            mine = len(self.weighted[x]) if self.inner else 0
            self._attach(x, y)
            if self.inner:
                self._weigh(self.sums[x], self.weighted[x][mine:], depth)
        return x

    def _weigh(self, sums: Sums, strings: list[int], depth: int) -> None:
        """Adds what contracted paths hold at ``depth`` (their last element is a node's own)."""
        for i in strings:
            if depth < self.size[i]:
                sums.add(self.inner[i][depth])

    def _attach(self, x: int, y: int) -> None:
        """Node ``y``'s component becomes a child of ``x``, after climbing to just below it."""
        told = self._climb(y, self.depth[x], x)
        if told is not None:  # else the child is counted when it is finished
            self.sums[x].add(told)
        if self.inner:
            self.weighted[x] += self.weighted[y]

    def _climb(self, y: int, floor: int, above: int | None = None) -> Sums | None:
        """Finishes the nodes from ``y`` up to depth ``floor + 1``; what they add
        to the node above, or None if they lie on a path that goes on."""
        sums, low, high = self.sums[y], self.low[y], self.high[y]
        edge = None if self.last else 0 if low == 0 else high if high == len(self.strings) - 1 else None
        lens = self.lens[low]
        for depth in range(self.depth[y], floor, -1):
            if edge is not None:
                self.paths[edge][depth] = sums
                sums = Sums()
            else:
                if depth == self.depth[y]:
                    self.row_of[y] = len(self.rows)
                leaves = sums.leaves if sums.children else 1
                saved = sums.saved + (sums.n - 1) * int(lens[depth - 1])
                self.rows.append((depth, sums.least, sums.n, sums.children, leaves, saved, sums.root, sums.end, low))
                self.up.append(len(self.rows) if depth > floor + 1 else ~above if above is not None else len(self.rows) - 1)
                sums = Sums(sums.n, sums.least, 1, leaves, saved)
            if depth - 1 > floor and self.inner:
                self._weigh(sums, self.weighted[y], depth - 1)
        if edge is not None:
            return None
        return sums

    def nodes(self, base: int, keyed: bool) -> pa.Table:
        """Finished nodes.  ``base``: depth of the strings' second element's node less one; ``keyed``: with own keys."""
        keys: dict[tuple[int, int], str] = {}

        def key(i: int, depth: int) -> str:
            if (i, depth) not in keys:
                keys[i, depth] = hashlib.md5(self.strings[i][:HEX * depth].encode()).hexdigest()
            return keys[i, depth]

        out = []
        for r, (depth, least, n, children, leaves, saved, root, end, low) in enumerate(self.rows):
            up, parent, parent_key = self.up[r], None, None
            if depth > 1:
                if up >= 0:
                    parent = self.rows[up][1]
                else:  # on a path that goes on; its first string names it
                    parent_key = key(self.low[~up], depth - 1)
            out.append((base + depth - 1, least, parent, n, children, leaves, saved, None if root == NO_ID else root, end,
                        key(low, depth) if keyed else None, parent_key))
        columns = list(zip(*out)) or [[]] * len(NODE_NAMES)
        kinds = [pa.int64()] * 8 + [pa.string()] * 3
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=NODE_NAMES)

    def contracted(self, place: int) -> pa.Table:
        """The one or two paths that go on, ``place`` being the first one's."""
        made = {c: [] for c in PATH_NAMES}
        ends = [0] if len(self.strings) == 1 else [0, len(self.strings) - 1]
        for k, i in enumerate(ends):
            held = [self.paths[i].get(d) or Sums() for d in range(1, int(self.size[i]) + 1)]
            made["place"].append(place + k)
            made["string"].append(self.strings[i])
            made["lens"].append([int(x) for x in self.lens[i]])
            for w in WEIGHTS:
                made[f"w_{w}"].append([getattr(s, w) for s in held])
            made["w_end"].append([s.end for s in held])
        kinds = [pa.int64(), pa.string()] + [pa.list_(pa.int64())] * (1 + len(WEIGHTS)) + [pa.list_(pa.string())]
        return pa.table([pa.array(made[c], t) for c, t in zip(PATH_NAMES, kinds)], names=PATH_NAMES)


def both(nodes: pa.Table, paths: pa.Table | None, block: int) -> Iterator[pa.RecordBatch]:
    """Node and path rows in one schema."""
    for table in (nodes, paths):
        if table is not None and table.num_rows:
            n = table.num_rows
            kinds = {c: pa.list_(pa.string()) if c == "w_end" else pa.list_(pa.int64()) if c == "lens" or c.startswith("w_")
                     else pa.string() if c == "string" or c.endswith("key") else pa.int64() for c in NODE_NAMES + PATH_NAMES}
            columns = [table.column(c).combine_chunks() if c in table.column_names else pa.nulls(n, t) for c, t in kinds.items()]
            yield from pa.table([pa.array([block] * n, pa.int64()), *columns], names=["block", *kinds]).to_batches()


SCHEMA = f"block long, {NODE}, {PATH}"


def build(scratch: Scratch, strings: DataFrame, base: int, n_strings: int, n_turns: int, name: str,
          task_strings: int, fan: int) -> DataFrame:
    """Nodes (with keys where a parent was finished in another task) of the
    tries of ``strings``: ``string``, ``lens``, ``conv_id``, ``end_key`` and what lies below its end
    (``x_children``, ``x_leaves``, ``x_saved`` and that trie's ``x_root``)."""
    tasks = max(1, -(-n_strings // task_strings), -(-n_turns // TASK_TURNS))
    alone = tasks == 1

    strings = strings.select("string", "lens", "conv_id", "end_key", "x_children", "x_leaves", "x_saved", "x_root")

    def first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        columns: dict[str, list] = {}
        for batch in batches:
            for c in batch.schema.names:
                columns.setdefault(c, []).extend(batch.column(c).to_pylist())
        if not columns or not columns["string"]:
            return
        ends = [Sums(1, c, *x) for c, *x in zip(columns["conv_id"], columns["x_children"], columns["x_leaves"],
                                               columns["x_saved"], columns["x_root"], columns["end_key"])]
        forest = Forest(columns["string"], columns["lens"], ends, None, alone)
        block = TaskContext.get().partitionId()
        yield from both(forest.nodes(base, False), None if alone else forest.contracted(2 * block), block)

    ordered = (strings.repartitionByRange(tasks, "string", "conv_id") if tasks > 1 else strings.coalesce(1)
               ).sortWithinPartitions("string", "conv_id")
    made = scratch.table(ordered.mapInArrow(first_round, SCHEMA), f"{name}-0")
    nodes = made.where("place IS NULL").select(*NODE_NAMES)
    k = 0
    while not alone:
        # the tasks there were may be more than were asked for
        blocks = (made.agg(F.max("place")).first()[0] or 0) // (2 * fan) + 1
        alone = final = blocks == 1

        def merge_round(rows: pa.Table) -> pa.Table:
            rows = rows.sort_by("place")
            held = {c: rows.column(c).to_pylist() for c in PATH_NAMES}
            weights = [[Sums(*x) for x in zip(*own)] for own in zip(*(held[f"w_{w}"] for w in WEIGHTS), held["w_end"])]
            # inner sums by depth: element d - 1 is depth d; the last element's are the string's own
            forest = Forest(held["string"], held["lens"], [w[-1] for w in weights],
                            [[Sums(), *w] for w in weights], final)
            block = rows.column("to")[0].as_py()
            made = list(both(forest.nodes(base, True), None if final else forest.contracted(2 * block), block))
            return pa.Table.from_batches(made) if made else pa.Table.from_batches([], schema=EMPTY)

        k += 1
        paths = made.where("place IS NOT NULL").select(*PATH_NAMES, F.floor(F.col("place") / (2 * fan)).alias("to"))
        made = scratch.table(paths.groupBy("to").applyInArrow(merge_round, SCHEMA), f"{name}-{k}")
        nodes = nodes.unionByName(made.where("place IS NULL").select(*NODE_NAMES))
    if not k:
        return nodes
    # parents that were finished in a later round
    known = nodes.where("own_key IS NOT NULL").select(F.col("own_key").alias("key"), F.col("conv_id").alias("found"))
    waiting = (nodes.where("parent_key IS NOT NULL").join(known, F.col("parent_key") == F.col("key"))
               .withColumn("parent_conv_id", F.col("found")).select(*NODE_NAMES))
    return nodes.where("parent_key IS NULL").unionByName(waiting)


EMPTY = pa.schema([("block", pa.int64())] + [(c, pa.string() if c.endswith("key") else pa.int64()) for c in NODE_NAMES]
                  + [("place", pa.int64()), ("string", pa.string()), ("lens", pa.list_(pa.int64()))]
                  + [(f"w_{w}", pa.list_(pa.int64())) for w in WEIGHTS] + [("w_end", pa.list_(pa.string()))])


def turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """conv_id, ``pos`` (from 0), ``turn_key`` and ``len`` of every turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), role.alias("role"),
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("turn_key"),
        F.length(text).cast("long").alias("len"), F.monotonically_increasing_id().alias("row"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Numbers the rows of each conversation within the sorted partition."""
        from pyspark import TaskContext
        part, conv, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            own = batch.column("conv_id").to_numpy()
            new = np.ones(len(own), bool)
            new[1:] = own[1:] != own[:-1]
            starts = np.flatnonzero(new)
            pos = np.arange(len(own)) - np.repeat(starts, np.diff(np.append(starts, len(own))))
            if len(own) and own[0] == conv:  # goes on
                pos[:starts[1] if len(starts) > 1 else len(own)] += n
            if len(own):
                conv, n = own[-1], int(pos[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * len(own), pa.int64()), batch.column("conv_id"), pa.array(pos.astype(np.int64)),
                 batch.column("turn_key"), batch.column("len")], ["part", "conv_id", "local", "turn_key", "len"])

    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "turn_key", "row"]  # the row parts repeated ones
    placed = scratch.table(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                           .select("conv_id", "turn_key", "len")
                           .mapInArrow(count, "part long, conv_id long, local long, turn_key string, len long"), "turns")
    # a conversation that goes on in the next partition: rows before it; at most one conversation per partition
    edges = placed.groupBy("part").agg(F.min("conv_id").alias("low"), F.max("conv_id").alias("high"))
    open_ = edges.select("part", F.explode(F.array_distinct(F.array("low", "high"))).alias("conv_id"))
    shared = open_.groupBy("conv_id").agg(F.count("part").alias("n")).where("n > 1").select("conv_id")  # fewer than partitions
    counted = placed.join(F.broadcast(shared), "conv_id").groupBy("conv_id", "part").agg(F.count("local").alias("own"))
    before = counted.select("conv_id", "part", (F.sum("own").over(
        Window.partitionBy("conv_id").orderBy("part")) - F.col("own")).alias("before"))  # at most two rows per partition
    return placed.join(F.broadcast(before), ["conv_id", "part"], "left").select(
        "conv_id", (F.col("local") + F.coalesce("before", F.lit(0))).alias("pos"), "turn_key", "len")


def rebuilt(conversations: DataFrame, scratch: Scratch, heads: int = 6, stride: int = 100, segment: int = SEGMENT) -> DataFrame:
    """Segments of rebuilt conversations: conv_id, ``seg``, ``string`` (turn hashes one after another), ``lens`` and
    ``ends`` (the last segment).  A conversation begins with the first h turns of the
    conversation whose id is its own rounded towards zero to a multiple of ``stride``."""
    rows = turns(conversations, scratch)
    head = (rows.where((F.col("conv_id") % stride == 0) & (F.col("pos") < heads - 1)).groupBy("conv_id")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "turn_key", "len"))).alias("head"))
            .withColumnRenamed("conv_id", "head_id"))
    plan = (rows.groupBy("conv_id").agg(F.count("pos").alias("n"))
            .withColumn("h", F.crc32(F.col("conv_id").cast("string")) % heads)
            .withColumn("head_id", F.col("conv_id") - F.col("conv_id") % stride).join(head, "head_id", "left"))
    taken = F.when(F.col("h") > 0, F.slice("head", 1, F.greatest("h", F.lit(1)).cast("int")))
    plan = plan.withColumn("head", F.coalesce(taken, F.expr("array()").cast(
        "array<struct<pos:bigint,turn_key:string,len:bigint>>"))).withColumn("m", F.size("head").cast("long"))
    plan = scratch.table(plan.select("conv_id", "h", "m", "head", (F.col("m") + F.greatest(
        F.col("n") - F.col("h"), F.lit(0))).alias("total")), "plan")
    own = rows.join(plan.drop("head"), "conv_id").where(F.col("pos") >= F.col("h")).select(
        "conv_id", "total", (F.col("pos") - F.col("h") + F.col("m")).alias("pos"), "turn_key", "len")
    # every conversation has a first segment, even without turns
    begin = plan.select("conv_id", "total", F.explode_outer("head").alias("t")).select(
        "conv_id", "total", "t.pos", "t.turn_key", "t.len")
    turn = F.when(F.col("pos").isNotNull(), F.struct("pos", "turn_key", "len"))
    cut = (own.unionByName(begin).withColumn("seg", F.coalesce(F.floor(F.col("pos") / segment), F.lit(0)).cast("long"))
           .groupBy("conv_id", "seg").agg(F.array_sort(F.collect_list(turn)).alias("t"), F.max("total").alias("total")))
    last = F.greatest(F.ceil(F.col("total") / segment) - 1, F.lit(0))
    return cut.select(
        "conv_id", "seg", F.array_join(F.col("t.turn_key"), "").alias("string"), F.col("t.len").alias("lens"),
        (F.col("seg") == last).alias("ends"))


def prefix_trie(conversations: DataFrame, segment: int = SEGMENT, task_strings: int = TASK_STRINGS,
                fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """Nodes of the trie (``conv_id``, ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``,
    ``end_key``) and the conversations that end at a node (``end_key``, ``conv_id``)."""
    scratch = Scratch(conversations.sparkSession, "trie")
    cut = scratch.table(rebuilt(conversations, scratch, segment=segment), "segments")
    root = F.lit("0" * HEX)
    facts = {r["seg"]: r for r in cut.groupBy("seg").agg(F.count("conv_id").alias("n"), F.sum(F.size("lens")).alias("turns")).collect()}
    if len(facts) > 1:  # a row per level
        several = cut.where("seg > 0").select("conv_id").distinct()
        upward = Window.partitionBy("conv_id").orderBy("seg")
        chained = cut.join(several, "conv_id").withColumn("own", F.md5("string")).select(
            "conv_id", "seg", "string", "lens", "ends",
            F.array_join(F.collect_list("own").over(upward.rowsBetween(Window.unboundedPreceding, -1)), "").alias("chain"))
        chained = chained.withColumn("group", F.when(F.col("seg") == 0, root).otherwise(F.md5("chain"))).drop("chain")
        cut = cut.join(several, "conv_id", "left_anti").withColumn("group", root).unionByName(chained)
    else:
        cut = cut.withColumn("group", root)
    cut = scratch.table(cut.select("conv_id", "seg", "ends", F.concat("group", "string").alias("string"),
                                   F.concat(F.array(F.lit(0).cast("long")), "lens").alias("lens"))
                        .withColumn("end_key", F.when(F.col("ends"), F.md5("string"))).drop("ends"), "strings")
    levels, below = [], None
    zero, none = F.lit(0).cast("long"), F.lit(NO_ID).cast("long")
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "end_key")
    for seg in sorted(facts, reverse=True):
        own = cut.where(F.col("seg") == seg).drop("seg")
        if below is None:
            own = own.withColumns({"x_children": zero, "x_leaves": zero, "x_saved": zero, "x_root": none})
        else:  # a trie's root is a node of this level, where its smallest member carries what lies below
            own = (own.join(below.select("conv_id", F.col("n_children").alias("x_children"), F.col("n_leaves").alias("x_leaves"),
                                         F.col("saved_tokens").alias("x_saved"), F.col("conv_id").alias("x_root")), "conv_id", "left")
                   .fillna(0, ["x_children", "x_leaves", "x_saved"]).fillna(NO_ID, ["x_root"]))
        nodes = build(scratch, own, seg * segment, facts[seg]["n"], facts[seg]["turns"], f"level-{seg}", task_strings, fan)
        if seg or below is not None:
            nodes = scratch.table(nodes, f"nodes-{seg}")
        if below is not None:  # conversations that end at the root's node may have smaller ids
            roots = nodes.where("root IS NOT NULL").select(F.col("root").alias("parent_conv_id"), F.col("conv_id").alias("least"))
            first = F.col("depth") == (seg + 1) * segment + 1
            lower = levels.pop()
            levels += [lower.where(~first), lower.where(first).join(roots, "parent_conv_id")
                       .withColumn("parent_conv_id", F.col("least")).select(*columns)]
        below = nodes.where(F.col("depth") == seg * segment) if seg else None
        levels.append((nodes.where(F.col("depth") > seg * segment) if seg else nodes).select(*columns))
    if not levels:  # no conversation
        levels.append(conversations.sparkSession.createDataFrame([], NODE).select(*columns))
    out = levels[0]
    for more in levels[1:]:
        out = out.unionByName(more)
    return out, cut.where("end_key IS NOT NULL").select("end_key", "conv_id")


def ends_digests(ends: DataFrame) -> DataFrame:
    """``end_key`` and ``ends_sha256`` of its conversations' ids, ascending and
    joined by commas.  The ids of a node stream through the hash in order; they are never held together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for key, c in zip(batch.column("end_key").to_pylist(), batch.column("conv_id").to_pylist()):
                if key != now:
                    if state is not None:
                        done.append((now, state.hexdigest()))
                    now, state = key, hashlib.sha256(str(c).encode())
                else:
                    state.update(b",%d" % c)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], ["end_key", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([state.hexdigest()])], ["end_key", "ends_sha256"])

    return ends.repartition("end_key").sortWithinPartitions("end_key", "conv_id").mapInArrow(
        run, "end_key string, ends_sha256 string")
