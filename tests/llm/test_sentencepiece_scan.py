"""Operator 10 against the library, whole and in chunks."""

import json
import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from bellwether.llm import sentencepiece_scan as S


@pytest.fixture(scope="module")
def lib():
    return sentencepiece.SentencePieceProcessor(model_file=S.MODEL)


@pytest.fixture(scope="module")
def enc():
    return S.Encoder(S.Vocabulary())


def strange(enc, n=3000):
    rng = random.Random(7)
    some = list("aaabbeeeettt  hhinorsé.,!-\n\t ▁中国😀\x0001AT")
    pieces = [p.replace("▁", " ") for p in enc.v.ids]
    out = ["".join(rng.choices(some, k=rng.randint(0, 60))) for _ in range(n)]
    out += ["".join(rng.choices(pieces, k=rng.randint(1, 8))) for _ in range(n)]
    return out + [" " * k + c for k in range(40) for c in ("", "x", "\n", "1")] + ["a" * k for k in range(60)]


def test_encoding_equals_the_library(enc, lib):
    texts = strange(enc)
    for got, want in zip(enc.encode(texts), lib.encode(texts)):
        assert got.tolist() == want


def test_decoding_is_exact(enc, lib):
    for t, ids in zip(strange(enc), enc.encode(strange(enc))):
        assert S.decode(enc.v, ids) == t.replace("▁", " ")


@settings(max_examples=100, deadline=None)
@given(st.text(st.sampled_from("athernsoi  ▁\n中é"), max_size=300), st.sampled_from([17, 40]), st.sampled_from([1, 8]))
def test_chunks_give_the_same_pieces(text, chunk, near):
    e, p = test_chunks_give_the_same_pieces.pair
    split = S.Splitter(e.v.joining, e.v.longest, chunk, near)
    norm = S.normal(text)
    parts = [S.Chunk(e, split, a, b, low, x, len(norm)) for a, b, low, x in split.chunks(norm)]
    if parts:
        states = S.choose([S._load(json.loads(json.dumps(S._dump(c.matrix())))) for c in parts])
        ids = np.concatenate([c.pieces(a, b) for c, (a, b) in zip(parts, states)])
        assert ids.tolist() == p.encode(text)


@pytest.fixture(autouse=True)
def _pair(enc, lib):
    test_chunks_give_the_same_pieces.pair = (enc, lib)


def test_matrices_combine_associatively(enc):
    split = S.Splitter(enc.v.joining, enc.v.longest, 20, 1)
    norm = S.normal("internationalisation" * 8)
    a, b, c = [S.Chunk(enc, split, *x, len(norm)).matrix() for x in split.chunks(norm)][1:4]
    left, right = S.combine(S.combine(a, b), c), S.combine(a, S.combine(b, c))
    assert left.keys() == right.keys()
    for i in left:
        assert left[i] == pytest.approx(right[i])


def test_documents_and_giants(spark, lib):
    long = "the internationalisation of words " * 30 + "unbrokenstretch" * 40 + " end\n  x"
    rows = [(1, None, 0), (2, "", 0), (3, "short one", 0), (3, "short one", 0), (4, long, 0), (None, long[::-1], 0), (6, "  \n", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    out = S.round_trip(docs, chunk=100, near=10)
    assert out.columns == ["doc_id", "text", "ids", "ids_", "decoded"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["ids_"] == lib.encode(r["text"] or "") and r["decoded"] == (r["text"] or "")
    assert all(r["exact"] for r in S.query(spark, docs).collect())
    assert S.query(spark, docs.limit(0)).count() == 0
