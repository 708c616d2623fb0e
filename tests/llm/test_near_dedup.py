"""Operator 1 against all-pairs brute force."""

import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from bellwether.llm import near_dedup as N
from bellwether.llm.text import HashCache, words


def brute_similarity(a, b):
    """Probability Jaccard by its definition, on shingle tuples."""
    def weigh(text):
        ws = words(text)
        k = min(5, len(ws))
        out = {}
        for i in range(len(ws) - k + 1 if k else 0):
            out[tuple(ws[i:i + k])] = out.get(tuple(ws[i:i + k]), 0) + 1
        return {s: 1 + np.log(n) for s, n in out.items()}
    x, y = weigh(a), weigh(b)
    total = 0.0
    for i in x.keys() & y.keys():
        total += 1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in x.keys() | y.keys())
    return total


def brute_classes(rows, least=0.8):
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if words(rows[i][1]) and words(rows[j][1]) and brute_similarity(rows[i][1], rows[j][1]) >= least:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(find(i), []).append(r[0])
    return {i: min(g) for g in groups.values() for i in g}


def corpus(seed=0, families=12, extra=25):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    rows, k = [], 0
    for _ in range(families):
        text = rng.choices(vocab, k=rng.randint(30, 120))
        for _ in range(rng.randint(1, 9)):
            rows.append((k, " ".join(text)))
            k += 1
            text = list(text)                     # a chain of edits: far copies are linked through near ones
            for _ in range(rng.randint(0, 2)):
                text[rng.randrange(len(text))] = rng.choice(vocab)
    for _ in range(extra):
        rows.append((k, " ".join(rng.choices(vocab, k=rng.randint(1, 60)))))
        k += 1
    rows += [(k, None), (k + 1, ""), (k + 2, "!!"), (k + 3, "!!"), (k + 4, "one two"), (k + 5, "ONE, two."),
             (k + 6, "rep rep rep rep rep rep rep rep a b c d"), (k + 7, "rep rep rep rep rep rep rep rep e f g h")]
    return rows


@pytest.mark.parametrize("block", [N.BLOCK, 3])
def test_classes_equal_brute_force(spark, block):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["class_id"] for r in N.classes(docs, block=block).collect()}
    assert got == brute_classes(rows)


def test_similarity_is_probability_jaccard():
    rows = corpus(5, families=4, extra=4)
    cache = HashCache()
    sets = [N.shingles(N._hashes(words(t), cache)) for _, t in rows]
    for i in range(0, len(rows), 3):
        for j in range(len(rows)):
            want = brute_similarity(rows[i][1], rows[j][1])
            assert N.similarity(sets[i], sets[j]) == pytest.approx(want, abs=1e-9)


def test_signatures_estimate_it():
    rng = np.random.default_rng(1)
    a = (np.arange(400, dtype=np.uint64) * np.uint64(7919) + np.uint64(11), rng.uniform(0.5, 3, 400))
    b = (a[0][80:], a[1][80:] * rng.uniform(0.8, 1.2, 320))
    sig = N.signatures([a, b, (a[0][:1], np.ones(1))], 4096)
    assert (sig[0] == sig[1]).mean() == pytest.approx(N.similarity(a, b), abs=0.04)
    assert (sig[2] == a[0][0]).all()


def test_signature_is_that_of_the_full_processes():
    """Early termination changes nothing: the same first arrivals as with a very late horizon."""
    rng = np.random.default_rng(2)
    sets = [(np.unique(rng.integers(1, 2**60, n).astype(np.uint64)), None) for n in (1, 3, 40, 700)]
    sets = [(s, 1 + rng.random(len(s))) for s, _ in sets]
    early = N.signatures(sets, 64)
    late = np.concatenate([N.signatures([s], 64) for s in sets])
    assert (early == late).all()


def test_keep_one_and_edges(spark):
    rows = [(3, "a b c d e f g", "x"), (1, "A b c d e f g!", "y"), (9, "other text", "z"), (None, "a b c d e f g", "n"),
            (9, "other text", "z"), (12, None, None), (13, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    kept = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["node"]) for r in N.keep_one(docs).collect())
    assert kept == [(False, 1, "y"), (False, 9, "z"), (False, 9, "z"), (False, 12, None), (False, 13, None), (True, 0, "n")]
    assert N.classes(docs.limit(0).select("doc_id", "text")).count() == 0


@pytest.mark.parametrize("shared, each", [(12, 15), (80, 100), (48, 60)])
def test_pairs_at_exactly_the_threshold_are_linked(spark, shared, each):
    """Rational numbers say 4/5, where the sum of floats may fall short of it."""
    a = [f"s{k}" for k in range(shared + 4)] + [f"a{k}" for k in range(each - shared)]
    b = a[:shared + 4]
    grams = [{tuple(t[i:i + 5]) for i in range(len(t) - 4)} for t in (a, b)]
    assert Fraction(len(grams[0] & grams[1]), len(grams[0] | grams[1])) == Fraction(4, 5)
    below = a[:shared + 3]
    assert Fraction(shared - 1, each) < Fraction(4, 5)
    docs = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(b))], "doc_id long, text string")
    assert {r["class_id"] for r in N.classes(docs).collect()} == {1}
    sets = [N.shingles(N._hashes(words(" ".join(t)), HashCache())) for t in (a, below)]
    assert N.similarity(*sets) < 0.8 - N.ROUNDING


def test_ids_are_joined_without_a_broadcast_of_this_module(spark, monkeypatch):
    class Functions:
        def __getattr__(self, name):
            assert name != "broadcast"
            return getattr(F, name)
    monkeypatch.setattr(N, "F", Functions())
    docs = spark.createDataFrame([(1, "a b c d e f g"), (2, "h i j k l m"), (3, "A b c d e f g!")], "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in N.classes(docs).collect()} == {1: 1, 2: 2, 3: 1}


@pytest.mark.parametrize("block", [N.BLOCK, 64])
@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_leave_about_as_many_links(spark, monkeypatch, block, seed):
    """n near copies in any row order: about n links go to the components, not one star for every bucket."""
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(300):
        text = list(base)
        text[rng.randrange(300)] = f"x{k}"
        rows.append((k, " ".join(text)))
    rng.shuffle(rows)
    seen = []
    whole = N.connected_components

    def counted(edges):
        seen.append(edges.count())
        return whole(edges)
    monkeypatch.setattr(N, "connected_components", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert {r["class_id"] for r in N.classes(docs, block=block).collect()} == {0}
    assert all(n <= 1.5 * len(rows) for n in seen), seen


def test_slim_keeps_components(spark):
    rng = random.Random(5)
    pairs = sorted({tuple(sorted(rng.sample(range(60), 2))) for _ in range(45)})
    edges = spark.createDataFrame(pairs, "a long, b long")
    got = {tuple(r) for r in N.connected_components(N.slim(edges)).collect()}
    assert got == {tuple(r) for r in N.connected_components(edges).collect()}
    assert N.slim(edges).where("a >= b").count() == 0


def test_very_long_texts(spark):
    long = " ".join(f"w{k}" for k in range(60_000))
    rows = [(1, long), (2, long + " end"), (3, " ".join(f"v{k}" for k in range(50_000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in N.classes(docs).collect()} == {1: 1, 2: 1, 3: 3}
