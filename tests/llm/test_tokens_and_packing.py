import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from featureforge.llm import catalog, packing, tokens
from tests.llm.conftest import ODD, SF

PIECE = public_tokenizers.path("piece_bpe_32k.model")
BYTE = public_tokenizers.path("byte_bpe_50k.json")


def test_counts_of_whole_texts(spark, rows):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    got = {r["doc_id"]: r for r in catalog.op1_token_counts(spark, SF).collect()}
    for k, t in rows:
        n = len(sp.encode(t or ""))
        assert (got[k]["n_bytes"], got[k]["n_tokens"], got[k]["over_limit"]) == (len((t or "").encode()), n, n > 4096)


def test_counts_of_odd_rows(odd, empty):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    got = tokens.token_counts(odd, PIECE).select("doc_id", "n_tokens").collect()
    assert sorted(map(tuple, got), key=str) == sorted(((k, len(sp.encode(t or ""))) for k, t in ODD), key=str)
    assert tokens.token_counts(empty, PIECE).collect() == []


def test_part_boundaries_are_safe():
    """Random mixtures of white space, signs and special strings encode as the library does."""
    letters = [*"ab'sdtlm .,!\n\n  \t19é…ñ  \u0085😀A-_`~|▁\x1c", "<|endoftext|>", "'ll", "<s>"]
    rng = random.Random(5)
    whole, encoder = Tokenizer.from_file(BYTE), packing.PartEncoder(BYTE)
    sp, counter = sentencepiece.SentencePieceProcessor(model_file=PIECE), tokens.SentencePieceCounter(PIECE)
    assert counter.safe
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(30))) for _ in range(3000)]
    ids, bounds = encoder.encode(pa.array(texts))
    _, n = tokens.count_block(pa.array(texts), counter)
    for k, t in enumerate(texts):
        assert ids[bounds[k]:bounds[k + 1]].tolist() == whole.encode(t, add_special_tokens=False).ids
        assert n[k] == len(sp.encode(t))


def check_packed(rows, out):
    whole = Tokenizer.from_file(BYTE)
    pieces, sequences = {}, {}
    for r in out:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    copies = {}
    for k, t in rows:
        copies.setdefault(k, []).append(t)
    for k, texts in copies.items():
        ids = np.array(whole.encode(texts[0] or "", add_special_tokens=False).ids + [0], "<u4")
        want = sorted([(a, min(1024, len(ids) - a), zlib.crc32(ids[a:a + 1024].tobytes()), len(ids))
                       for a in range(0, len(ids), 1024)] * len(texts))
        assert sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in pieces[k]) == want
    for own in sequences.values():
        end = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == end
            end += r["length"]
        assert end <= 1024
    return len(sequences)


def test_packing_round_trip(spark, rows):
    out = catalog.op2_packing(spark, SF).collect()
    n = check_packed(rows, out)
    assert sum(r["length"] for r in out) / 1024 / n > 0.98


def test_packing_odd_rows(odd, empty):
    check_packed(ODD, packing.pack(odd, BYTE, carry="crc32", group_pieces=3).collect())
    assert packing.pack(empty, BYTE).collect() == []


def test_sequences_hold_all_ids(spark):
    df = spark.createDataFrame([(i, "word " * (i * 37 % 400)) for i in range(40)], "doc_id long, text string")
    packed = packing.pack(df, BYTE)
    whole = Tokenizer.from_file(BYTE)
    got = sorted(x for r in packing.sequences(packed).collect() for x in r["ids"])
    want = sorted(x for i in range(40) for x in whole.encode("word " * (i * 37 % 400), add_special_tokens=False).ids + [0])
    assert got == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=40))
def test_first_fit_decreasing(lengths):
    lengths = sorted(lengths, reverse=True)
    bins, offsets = packing.first_fit_decreasing(lengths, 20)
    room, want = [], []
    for n in lengths:
        b = next((i for i, r in enumerate(room) if r >= n), len(room))
        if b == len(room):
            room.append(20)
        want.append((b, 20 - room[b]))
        room[b] -= n
    assert list(zip(bins, offsets)) == want
