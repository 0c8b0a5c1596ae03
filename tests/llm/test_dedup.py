import hashlib

import numpy as np
import pyarrow as pa

from featureforge.llm import neardup, substrings
from tests.llm.conftest import ODD


def split(text):
    return (text or "").encode().split()


def brute_substrings(rows, size=13):
    first = {}
    for k, t in rows:
        w = split(t)
        for i in range(len(w) - size + 1 if k is not None else 0):
            g = tuple(w[i:i + size])
            first[g] = min(first.get(g, k), k)
    out = []
    for k, t in rows:
        w = split(t)
        gone = set()
        for i in range(len(w) - size + 1 if k is not None else 0):
            if first[tuple(w[i:i + size])] < k:
                gone.update(range(i, i + size))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((k, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run_substrings(df):
    return sorted(map(tuple, substrings.deduplicate_substrings(df).selectExpr(
        "doc_id", "n_words", "n_removed", "sha2(kept_text, 256)").collect()), key=str)


def test_substrings_in_small_chunks_and_cells(spark, rows, monkeypatch):
    """Chunks, partitions, sketch width and join strategy change nothing."""
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    monkeypatch.setattr(substrings, "CHUNK_WINDOWS", 3000)
    monkeypatch.setattr(substrings, "BROADCAST_RUNS", 0)
    monkeypatch.setattr(substrings, "MAX_CELLS", substrings.BLOCK_CELLS)
    assert run_substrings(df) == brute_substrings(rows)


def test_substrings_of_odd_rows(odd, empty):
    assert run_substrings(odd) == brute_substrings(ODD)
    assert run_substrings(empty) == []


def test_cell_codes_round_trip():
    cells = np.sort(np.random.default_rng(3).integers(0, 1 << 18, 5000))
    assert (substrings.decode_cells(substrings.encode_cells(cells)) == cells).all()


def brute_components(rows, size=5):
    sets = {}
    for k, t in rows:
        w = (t or "").encode().lower().split()
        if k is not None:
            sets[k] = {tuple(w[i:i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set()
    comp = {k: k for k in sets}

    def find(k):
        while comp[k] != k:
            k = comp[k]
        return k

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                comp[y] = x
    return {k: (len(s), find(k), find(k) == k) for k, s in sets.items()}


def test_odd_rows_components(odd, empty):
    want = brute_components(ODD)
    got = neardup.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    for r in got:
        if r["doc_id"] is None:
            assert (r["component_id"], r["kept"]) == (None, True)
        else:
            assert (r["n_shingles"], r["component_id"], r["kept"]) == want[r["doc_id"]]
    assert neardup.near_duplicates(empty).collect() == []


def test_group_with_borderline_links(spark, monkeypatch):
    """A large group around one text, many pairs near the threshold, compared in
    small blocks: no link is lost."""
    rng = np.random.default_rng(7)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(150):
        w = list(base)
        for i in rng.integers(0, 120, rng.integers(0, 7)):
            w[i] = f"x{rng.integers(0, 40)}"
        rows.append((k, " ".join(w)))
    monkeypatch.setattr(neardup, "BLOCK_BYTES", 16_000)
    want = brute_components(rows)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == want
    assert len({c for _, c, _ in want.values()}) > 1


def test_registers_agree_as_often_as_sets_do():
    """Register agreement estimates similarity for small and large sets."""
    rng = np.random.default_rng(1)
    for n in (4, 40, 2000):
        errors = []
        for _ in range(30):
            h = np.sort(rng.integers(1, 1 << 63, n + n // 4, dtype=np.int64).view(np.uint64))
            a, b = h[:n], h[n // 4:]
            regs = neardup.registers(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
            j = len(set(a.tolist()) & set(b.tolist())) / len(h)
            errors.append(float(neardup.estimate((regs[0] == regs[1]).sum(), len(a), len(b))) - j)
        assert abs(np.mean(errors)) < 0.05


def test_short_texts_are_one_shingle():
    h, bounds = neardup.shingle_sets(pa.array(["a b", "A b", "a b c d e", "", None]), 5)
    assert np.diff(bounds).tolist() == [1, 1, 1, 0, 0] and h[0] == h[1] != h[2]
