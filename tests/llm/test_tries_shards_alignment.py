"""Prefix tries, shards and tokenizer alignment against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from featureforge.llm import alignment, catalog, prefix_trie, shards
from featureforge.llm.scratch import Scratch
from tests.llm.conftest import ODD, SF

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(autouse=True, scope="module")
def few_partitions(spark):
    """Small tables: fewer, larger shuffle partitions save task starts."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


# ------------------------------------------------------------------ prefix trie
def brute_trie(rows):
    """Node rows by dictionaries over all prefixes."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs[c].append(((turn is not None, turn or 0), role, key, text))
    convs = {c: [(r, t) for _, r, _, t in sorted(own)] for c, own in convs.items()}
    whole = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        head = c - (c % 100 if c >= 0 else -(-c % 100))
        whole[c] = tuple(convs.get(head, [])[:h] + own[h:])
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(whole):
        seq = whole[c]
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
            if d:
                children[seq[:d - 1]].add(seq[:d])
        ends[seq].append(c)
    leaves, saved = Counter(), Counter()
    for node in sorted(members, key=len, reverse=True):
        leaves[node] += not children[node]
        saved[node] += (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        if node:
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    return sorted((m[0], len(n), members[n[:-1]][0] if n else None, len(m), len(children[n]), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest()) for n, m in members.items())


def trie_rows(conversations, **parameters):
    nodes, ends = prefix_trie.prefix_trie(conversations, **parameters)
    made = nodes.join(prefix_trie.ends_digests(ends), "end_key", "left").fillna(
        {"ends_sha256": hashlib.sha256(b"").hexdigest()})
    return sorted(tuple(r[c] for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                       "saved_tokens", "ends_sha256")) for r in made.collect())


def test_trie_of_all_conversations(spark):
    rows = [tuple(r.values()) for r in pq.read_table(f"{SF}/conversations.parquet").to_pylist()]
    got = catalog.op11_prefix_trie(spark, SF)
    assert sorted(tuple(r) for r in got.collect()) == brute_trie(rows)


TALKS = ([(c, t, "user" if t % 2 else None, f"say {(c * t) % 3}é" if t < 4 else None) for c in range(95, 140) for t in range(c % 9)]
         + [(200 + c, t, "a", "same") for c in range(40) for t in range(6)]  # copies
         + [(300, t, "b", str(t % 7)) for t in range(60)] + [(c, t, "b", str(t % 7)) for c in (301, 302, 377) for t in range(30 + c % 10)]
         + [(-5, 0, "x", "y"), (-105, None, "x", "z"), (-105, 3, "x", "y"), (None, 1, "q", "r"), (None, None, None, None)]
         + [(400, 1, "a", "tie"), (400, 1, "a", "tie"), (400, 1, "A", "tie"), (400, None, "a", "first"), (401, 2, "a", "😀" * 9)]
         + [(404, t, "c", "long " * 5000) for t in range(3)])


@pytest.fixture(scope="module")
def talks(spark):
    df = spark.createDataFrame(TALKS, "conv_id long, turn long, role string, text string").repartition(5)
    for c in ("pos", "len", "seg", "head", "h", "total", "lens", "string", "ends", "row", "part"):
        df = df.withColumn(c, F.lit("x"))
    return df


@pytest.mark.parametrize("parameters", [{}, {"task_strings": 12, "fan": 2}, {"segment": 7, "task_strings": 20, "fan": 3}])
def test_trie_of_odd_conversations(talks, parameters):
    """One task, merged partition forests, several segments, and both."""
    assert trie_rows(talks, **parameters) == brute_trie(TALKS)


def test_trie_of_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert trie_rows(empty) == []
    assert trie_rows(spark.createDataFrame([(None, 1, "a", "b")], empty.schema)) == []


# ------------------------------------------------------------------ shards
def brute_capacity(sizes, n):
    """Smallest largest run of a contiguous partition, by dynamic programming."""
    done = np.concatenate([[0], np.cumsum(sizes)])
    best = done.copy()
    for _ in range(n - 1):
        best = np.array([min(max(best[j], done[i] - done[j]) for j in range(i + 1)) for i in range(len(done))])
    return int(best[-1])


def check_shards(rows, out, n_shards=8):
    """Every row once, equal texts together, gapless slots, runs of the digest order, smallest capacity."""
    want = sorted(((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in rows), key=str)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in out), key=str) == want
    slots, groups, total, shard_of = defaultdict(list), Counter(), Counter(), {}
    digests = defaultdict(set)
    for k, t in rows:
        digests[k, zlib.crc32((t or "").encode())].add(hashlib.md5((t or "").encode()).hexdigest())
    for r in out:
        (digest,) = digests[r["doc_id"], r["text_crc32"]]
        assert shard_of.setdefault(digest, r["shard"]) == r["shard"]
        slots[r["shard"]].append(r["slot"])
        groups[digest] += r["size"]
        total[r["shard"]] += r["size"]
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    order = sorted(groups)
    assert [shard_of[d] for d in order] == sorted(shard_of[d] for d in order) and set(total) <= set(range(n_shards))
    assert max(total.values()) == brute_capacity([groups[d] for d in order], n_shards)
    return total


def test_shards_of_all_documents(spark, rows):
    out = catalog.op12_sharding(spark, SF).collect()
    total = check_shards(rows, out)
    assert {(r["law"], r["grown_shard"]) for r in out} == {("bytes", None)}
    assert len(total) == 8


@pytest.mark.parametrize("probes", [2, 3, 256])
def test_shards_of_odd_rows(odd, empty, probes):
    check_shards(ODD, shards.shard(odd, probes=probes).collect())
    assert shards.shard(empty).collect() == []


def test_shards_with_a_hot_group(spark):
    rows = [(i, "copy" if i % 3 == 0 else "t" * (i % 17)) for i in range(600)] + [(None, "x" * 300)] * 4
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    check_shards(rows, shards.shard(df).collect())
    for n in (1, 2, 5):
        check_shards(rows, shards.shard(df, n).collect(), n)


def test_shards_are_native(spark):
    plan = catalog.op12_sharding(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Cartesian"))


# ------------------------------------------------------------------ alignment
class Brute:
    """Tokens by whole texts, ranges by decoded bytes, groups by loops."""

    def __init__(self):
        self.a = Tokenizer.from_file(BYTE)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PIECE)
        self.alphabet = alignment.byte_alphabet()

    def groups(self, text):
        if not text:
            return []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        x = [bytes(self.alphabet[c] for c in self.a.id_to_token(i)) for i in a]
        y = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i)
             else self.b.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not b"".join(x) == b"".join(y) == (" " + text).encode():
            return []
        out, i, j = [], 0, 0
        while i < len(x):
            own, other, n, m = [a[i]], [b[j]], len(x[i]), len(y[j])
            i, j = i + 1, j + 1
            while n != m:
                if n < m:
                    own.append(a[i])
                    n += len(x[i])
                    i += 1
                else:
                    other.append(b[j])
                    m += len(y[j])
                    j += 1
            out.append((own, other))
        return out

    def rows(self, rows):
        docs = [(k, self.groups(t)) for k, t in rows]
        links = [Counter((x, y) for own, other in g for x in own for y in other) for _, g in docs]
        count = Counter(p for own in links for p in own)
        best = Counter()
        for (x, _), n in count.items():
            best[x] = max(best[x], n)
        return sorted(((k, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(own.values()),
                        sum(n for p, n in own.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in own.items()),
                        hashlib.sha256(";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g).encode()).hexdigest()
                        if g else "") for (k, g), own in zip(docs, links)), key=str)


def test_alignment_of_all_documents(spark, rows):
    got = catalog.op13_alignment(spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == Brute().rows(rows)


SIGNS = ["  two  spaces ", "中文字，没有空格。" * 50, "🏳️‍🌈 é é   x", "▁ marked", "a\x00b \x1c c", "'ll I'll <0x0A> </s>",
         "\n\n\n", "tab\tand\r\nline ", "𝛼𝛽" * 30, "zażółć gęślą jaźń " * 20, " ", "x" * 5000]


def test_alignment_of_odd_rows(spark, odd, empty, monkeypatch):
    got = alignment.alignment(odd, BYTE, PIECE).collect()
    assert sorted(map(tuple, got), key=str) == Brute().rows(ODD)
    assert alignment.alignment(empty, BYTE, PIECE).collect() == []


def test_alignment_of_signs_in_small_segments(spark, monkeypatch):
    """Texts longer than a segment, chunks of few documents, parts forgotten on the way."""
    monkeypatch.setattr(alignment, "SEGMENT_BYTES", 64)
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 500)
    monkeypatch.setattr(alignment, "MEMORY_PARTS", 40)
    monkeypatch.setattr(alignment, "ROW_PAIRS", 7)
    rows = list(enumerate(SIGNS + SIGNS[::2] + [" ".join(SIGNS), "the cat sat on the mat and " * 60]))
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    assert sorted(map(tuple, alignment.alignment(df, BYTE, PIECE).collect()), key=str) == Brute().rows(rows)


def test_pair_counts_have_ties(spark):
    held = [(0, 0, (7 << 32) | 1, 3), (1, 0, (7 << 32) | 2, 3), (1, 1, (7 << 32) | 3, 2), (1, 2, (8 << 32) | 3, 1)]
    got = alignment.pair_counts(spark.createDataFrame(held, "chunk long, place long, pair long, held long")).collect()
    assert {(r["pair"] & 0xFF, r["pair"] >> 32, r["count"], r["best"]) for r in got} == {(1, 7, 3, 1), (2, 7, 3, 1), (3, 7, 2, 0), (3, 8, 1, 1)}


def test_scratch_is_shared(spark):
    """Nothing is kept in folders of one machine."""
    assert Scratch(spark, "x").base.startswith(spark.sparkContext.getCheckpointDir())
