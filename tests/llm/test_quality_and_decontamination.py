from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from featureforge.llm import decontaminate, fmindex, quality
from tests.llm.conftest import ODD


def brute_quality(text):
    text = text or ""
    words = text.encode().split()
    grams = Counter(zip(words, words[1:], words[2:]))
    again = {j for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (len(words), sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(again), len(words) < 50 or 2 * len(again) > len(words))


def test_quality_of_odd_rows(odd, empty, spark):
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = quality.quality_filter(odd).select(*cols).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((k, *brute_quality(t)) for k, t in ODD), key=str)
    assert quality.quality_filter(empty).collect() == []
    texts = ["a b a b a b", "x\nx\n \nx", "a b c a b c", "# * <b> |", "a\x0bb\x0cc\r\nd"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = quality.quality_filter(df).select(*cols).collect()
    assert sorted(map(tuple, got)) == [(k, *brute_quality(t)) for k, t in enumerate(texts)]


def test_quality_runs_without_python(spark, rows):
    df = quality.quality_filter(spark.createDataFrame(rows, "doc_id long, text string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.lists(st.lists(st.integers(0, 4), min_size=1, max_size=4), min_size=1, max_size=5))
def test_index_finds_every_occurrence(text, phrases):
    index = fmindex.FMIndex(np.array(text, np.int64), sample=4)
    size = max(map(len, phrases))
    table = np.array([p + [0] * (size - len(p)) for p in phrases])
    lo, hi = index.search(table, np.array([len(p) for p in phrases]))
    for k, p in enumerate(phrases):
        want = [i for i in range(len(text) - len(p) + 1) if text[i:i + len(p)] == p]
        assert sorted(index.locate(np.arange(lo[k], hi[k])).tolist()) == want


def brute_contamination(docs, items, size):
    def split(text):
        out = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32
                    for c in (text or "").encode())
        return out.split()

    windows = {}
    for item, text in items:
        w = split(text)
        for i in range(max(len(w) - size + 1, 1) if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add(item)
    out = []
    for k, text in docs:
        w = split(text)
        hit, found = set(), set()
        for g, who in windows.items():
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i:i + len(g)]) == g:
                    hit.update(range(i, i + len(g)))
                    found |= {str(x) for x in who if x is not None}
        out.append((k, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def test_contamination_of_odd_rows(spark, odd, empty, monkeypatch):
    items = [(1, "a b c"), (2, None), (3, ""), (None, "g h i j k"), (1, "B, c! d"), (4, "l m n o p l m"), (10, "l m n o p"), (5, "...")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    cols = ["doc_id", "n_words", "n_hit", "items", "contaminated"]
    docs = [(k, t) for k, t in ODD if t is None or len(t) < 1000]
    few = odd.where("text IS NULL OR length(text) < 1000")
    for block in (1 << 20, 8):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
        got = decontaminate.with_verdict(decontaminate.contamination(few, bench, size=4)).select(*cols).collect()
        assert sorted(map(tuple, got), key=str) == brute_contamination(docs, items, 4)
    assert decontaminate.contamination(empty, bench).collect() == []
    none = decontaminate.contamination(odd, bench.limit(0)).collect()
    assert len(none) == len(ODD) and all(r["n_hit"] == 0 for r in none)


def test_spans_merge(spark):
    docs = spark.createDataFrame([(1, "x a b c d e y a b c z")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d e"), (2, "a b c")], "item_id long, text string")
    row = decontaminate.contamination(docs, bench, size=3).collect()[0]
    assert [(s["first"], s["last"]) for s in row["spans"]] == [(1, 5), (7, 9)] and row["n_hit"] == 8
