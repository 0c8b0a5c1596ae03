import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from featureforge.llm import catalog, kneserney, toxicity
from tests.llm.conftest import ODD, SF


def discounts(counts):
    n = [sum(1 for c in counts if c == k) for k in (1, 2, 3, 4)]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    return [0.0] + [min(max(k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else y, 0), k) for k in (1, 2, 3)]


def brute_scores(rows, held):
    """(held, tokens, known, N, base, score) per document by dictionaries."""
    docs = [(k, held(k), [*(t or "").encode().lower().split(), None]) for k, t in rows]
    one, two = Counter(), Counter()
    for _, h, w in docs:
        if not h:
            one.update(w)
            two.update(zip(["<s>", *w[:-1]], w))
    total, size = sum(one.values()), len(one)
    context, before = defaultdict(lambda: [0, 0, 0, 0]), Counter()
    for (v, w), c in two.items():
        context[v][0] += c
        context[v][min(c, 3)] += 1
        before[w] += 1
    d2, d1, pairs = discounts(list(two.values())), discounts(list(before.values())), sum(before.values())
    rest = sum(d1[min(c, 3)] for c in before.values()) / pairs if pairs else 1.0

    def low(w):
        return (max(before[w] - d1[min(before[w], 3)], 0) / pairs if pairs else 0) + rest / (size + 1)

    def p(v, w):
        if v not in context:
            return low(w)
        c, *n = context[v]
        return (max(two[v, w] - d2[min(two[v, w], 3)], 0) + sum(a * b for a, b in zip(d2[1:], n)) * low(w)) / c

    out = []
    for k, h, w in docs:
        out.append((k, h, len(w), sum(one[x] > 0 for x in w), total,
                    sum(math.log10((one[x] + 1) / (total + size + 1)) for x in w),
                    sum(math.log10(p(v, x)) for v, x in zip(["<s>", *w[:-1]], w))))
    if context:
        v = max(context, key=lambda x: context[x][0])
        unknown = sum(a * b for a, b in zip(d2[1:], context[v][1:])) / context[v][0] * rest / (size + 1)
        assert sum(p(v, w) for w in one) + unknown == pytest.approx(1)
    return out


def same(got, want):
    got, want = sorted(map(tuple, got), key=str), sorted(want, key=str)
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], abs=1e-7)


def held(k):
    return zlib.crc32(str(k).encode()) % 7 == 2


def test_language_scores(spark, rows):
    got = catalog.op8_language_scores(spark, SF).collect()
    same(got, brute_scores(rows, held))
    mine = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in mine) > sum(r["base_score"] for r in mine)


def test_language_scores_in_many_chunks_and_shards(spark, rows, monkeypatch):
    monkeypatch.setattr(kneserney, "CHUNK_TOKENS", 4000)
    monkeypatch.setattr(kneserney, "SHARD_BYTES", 40_000)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = kneserney.language_scores(df, F.crc32(F.col("doc_id").cast("string")) % 7 == 2)
    same(out.collect(), brute_scores(rows, held))


def test_language_scores_of_odd_rows(odd, empty):
    same(kneserney.language_scores(odd, F.lit(False)).collect(), brute_scores(ODD, lambda k: False))
    same(kneserney.language_scores(odd, F.lit(True)).collect(), brute_scores(ODD, lambda k: True))
    assert kneserney.language_scores(empty, F.lit(False)).collect() == []


def brute_kernel(a, b):
    """Gap-weighted common triples of two coded words, normalised by length."""
    def features(word):
        code = [toxicity.OPEN, *(int(c) for c in toxicity.CODES[np.frombuffer(word, np.uint8)] if c), toxicity.CLOSE]
        out, norm = Counter(), 0.0
        for i in range(len(code)):
            for j in range(i + 1, len(code)):
                for k in range(j + 1, min(len(code), i + toxicity.SPAN + 1)):
                    w = toxicity.DECAY ** (k - i + 1)
                    out[code[i], code[j], code[k]] += w
                    norm += w * w
        return out, max(norm, toxicity.DECAY ** 6) ** 0.5

    (x, n), (y, m) = features(a), features(b)
    return sum(x[f] * y[f] for f in x) / n / m


def test_kernel_against_definition():
    words = [b"idiot", b"id-i0t", b"the", b"a", b"", "été".encode(), b"clown"]
    got = toxicity.kernel(toxicity.units_of(words), toxicity.units_of(words))
    want = [[brute_kernel(a, b) for b in words] for a in words]
    assert np.allclose(got, want)


def corpus(n=600):
    rng = np.random.default_rng(2)
    plain = ["".join(rng.choice(list("aeioutnrslmd"), rng.integers(2, 8))) for _ in range(400)]
    bad = ["grobnak", "blixor", "snurgle"]
    rows, labels = [], []
    for k in range(n):
        w = list(rng.choice(plain, 30))
        toxic = int(k % 4 == 0)
        if toxic:
            for i in rng.integers(0, 30, 2):
                w[i] = str(rng.choice(bad))
        rows.append((k, " ".join(w)))
        labels.append((k, toxic))
    return rows, labels


def test_toxicity_learns_and_tolerates_insertions(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels + [(None, 1), (5, None), (4, 1)], "doc_id long, toxic int")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = toxicity.fit(docs, marks, held_out)
    truth = dict(labels)
    got = toxicity.score(docs, model).collect()
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]) > 0.95
    near = spark.createDataFrame([(0, "tana gro-bnak lemi blixxor"), (1, "tana lemi"), (2, None), (3, "")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.score(near, model).collect()}
    assert [got[k]["predicted"] for k in range(4)] == [1, 0, 0, 0]
    assert all(0 <= r["score"] <= 1 for r in got.values())


@pytest.fixture(scope="module")
def toxic_model(spark):
    rows, labels = corpus()
    return toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"),
                        spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(False))


def test_insults_inside_long_tokens(toxic_model):
    filler = "tanalemidosuler"
    texts = [f"tana {(filler * 7)[:100 - len(x)]}{x} lemi" for x in ("grobnak", "blixor", "snurgle")]
    texts += [f"tana http://tana.lemi/{filler}/{filler}/{filler}/grobnak,blixor", "tana " + "/".join([filler] * 6), "tana " + "-" * 100]
    tokens = toxicity.Tokens(pa.array(texts + [None, ""]))
    assert tokens.n_docs == 8 and tokens.counts()[-2:].tolist() == [0, 0] and tokens.counts()[5] == 1
    assert {b"grobnak", b"blixor"} <= set(tokens.distinct.to_pylist())
    best = toxicity.document_values(pa.array(texts), toxic_model.machine)[0]
    assert (best[:4] > 0).all() and (best[4:] < 0).all()
    assert (toxic_model.scores(pa.array(texts))[3:] >= 0.5).tolist() == [True, False, False]


def test_spaced_insults(toxic_model):
    texts = ["tana g r o b n a k lemi sudo", "tana lemi grob nak suda b l i x o r", "tana lemi a d r o m i s suda lemi", "a", ""]
    best, second, positive = toxicity.document_values(pa.array(texts), toxic_model.machine)
    assert (best[:2] > 0).all() and (best[2:] < 0).all() and positive.tolist() == [1, 2, 0, 0, 0]
    assert (toxic_model.scores(pa.array(texts))[1:] >= 0.5).tolist() == [True, False, False, False]


def test_phrases_of_ordinary_words(spark):
    """Two words that clean documents have apart are toxic in a row."""
    rows, labels = corpus()
    rng = np.random.default_rng(3)
    said = [(k, t.replace("grobnak", "x").replace("blixor", "x").replace("snurgle", "x").split()) for k, t in rows]
    out = []
    for (k, w), (_, toxic) in zip(said, labels):
        w = [x for x in w if x != "x"]
        for phrase in (["melano", "tidur"], ["sorima", "lutedo"]):
            at = sorted(rng.choice(len(w) - 2, 2, replace=False) + 1)
            w = [*w[:at[0]], *phrase, *w[at[0]:]] if toxic else [*w[:at[0]], phrase[0], *w[at[0]:at[1]], phrase[1], *w[at[1]:]]
        out.append((k, " ".join(w)))
    model = toxicity.fit(spark.createDataFrame(out, "doc_id long, text string"),
                         spark.createDataFrame(labels, "doc_id long, toxic int"), F.col("doc_id") % 5 == 0)
    mine = [(t, y) for (k, t), (_, y) in zip(out, labels) if k % 5 == 0]
    got = model.scores(pa.array([t for t, _ in mine])) >= 0.5
    assert np.mean([bool(y) == g for (_, y), g in zip(mine, got)]) > 0.95


def test_toxicity_of_odd_rows_and_without_labels(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(1, 0), (5, 0)], "doc_id long, toxic int")
    for docs, labels in ((odd, none), (odd, one), (empty, none)):
        model = toxicity.fit(docs, labels, F.lit(False))
        assert all(r["score"] == 0 for r in toxicity.score(docs, model).collect())
    assert toxicity.without_toxic(odd, model).count() == len(ODD)


def test_toxicity_on_the_tables(spark):
    """Held-out accuracy where labels allow it (some labels there are noise)."""
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = catalog.op7_toxicity(spark, sf).join(labels, "doc_id").collect()
    assert len(got) == labels.count()
    clean = [r for r in got if r["toxic"] == 0]
    assert np.mean([r["predicted"] for r in clean]) < 0.05
    assert np.mean([r["predicted"] for r in got if r["toxic"] == 1]) > 0.6


def test_runs_of_words_are_scored_from_running_sums():
    """The value of a run is that of its bytes read as one unit, wherever it lies."""
    machine = toxicity.Machine([b"idiot", b"stupid", b"mor\xc3\xb6n"], [b"table", b"the", b"a", b"weather"],
                               [b"idiot", b"mor\xc3\xb6n", b"table", b"the"])
    texts = ["you st upid id.iot a the", "--- ... st upid", "", "i d i o t " * 3, "mor ön ?? weather " + "x" * 60 + " st upid id.iot", "ab", None]
    words = toxicity.Tokens(pa.array(texts, pa.large_string()))
    windows = toxicity.Windows(words)
    stream = toxicity.Stream(windows.data, windows.bounds, machine)
    want = machine.values(toxicity.Units(*windows.units(np.arange(len(windows.first)))))
    got = stream.values(windows.first, windows.size)
    assert len(got) > 40 and np.allclose(got, want, atol=1e-6)
    same = {}
    for key, value in zip(windows.key.tolist(), got.tolist()):
        assert same.setdefault(key, value) == value  # exactly, so that equal windows tie
    assert len(same) < len(got)
    single = machine.values(toxicity.units_of(words.distinct.to_pylist()))[words.index]
    assert np.allclose(stream.values(np.arange(len(words.index)), 1), single, atol=1e-6)
