"""Operator 8: the automaton against edit distance, held-out accuracy, edge cases."""

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from bellwether.llm import toxicity as T


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute(terms, word):
    best = 99
    for term, stem, most in terms:
        ends = range(len(word) + 1) if stem else [len(word)]
        for k in ends:
            d = edit_distance(term, word[:k])
            if d <= most:
                best = min(best, d)
    return best


term = st.text("abc", min_size=3, max_size=10)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(term, st.booleans(), st.integers(0, 2)), min_size=1, max_size=6), st.lists(st.text("abcd", max_size=12), max_size=8))
def test_matcher_equals_edit_distance(terms, words):
    m = T.Matcher(terms)
    for w in words:
        assert m.distance(w) == brute(terms, w)
        near = {k for k, t in enumerate(terms) if brute([t], w) < 99}
        assert m.misspelled(w) == (set() if m.distance(w) in (0, 99) else near)


def test_matcher_starts_afresh_when_full(monkeypatch):
    monkeypatch.setattr(T, "STATES", 3)
    m = T.Matcher([("stupid", False, 1), ("worthless", False, 2)])
    assert [m.distance(w) for w in ("stupid", "stupd", "worhtless", "clean", "stu")] == [0, 1, 2, 99, 99]


def test_quotation_is_told_from_abuse():
    h = T.Hits([("idiot", False, 1)])
    abuse, quote = h.features("you are an idiot and that is all"), h.features('he said "idiot" to them')
    assert abuse[0] > 0 and abuse[5] == 0 and quote[0] == 0 and quote[5] > 0


def test_held_out_on_driver_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    some = labels.join(docs, "doc_id")
    rows = T.query(spark, some.select("doc_id", "text"), labels).join(labels, "doc_id").where("held_out").collect()
    y = np.array([r["toxic"] for r in rows])
    p = np.array([r["predicted"] for r in rows])
    assert (p == y).mean() > 0.98 and p[y == 1].mean() > 0.85 and p[y == 0].mean() < 0.01


def test_misspelled_terms_are_caught(spark):
    clean = ["the cat sat on the mat", "a dog ran in the park", "rain fell on the town", "they read a long book"]
    bad = ["you are a pathetic fool", "what a pathetic mess", "so pathetic of you", "pathetic and sad"]
    rows = [(i, t) for i, t in enumerate((clean + bad) * 12)]
    docs = spark.createDataFrame([*rows, (1000, "such a pathetik one"), (1001, "the town"), (1002, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int("pathetic" in t)) for i, t in rows], "doc_id long, toxic int")
    got = {r["doc_id"]: r["score"] for r in T.query(spark, docs, labels).collect()}
    assert got[1000] > 0.5 > got[1001] == got[1002]


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (2, "", "x"), (None, "text", "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(1, 0), (2, None)], "doc_id long, toxic int")
    got = T.query(spark, docs, labels).collect()
    assert len(got) == 4 and all(r["score"] < 0.01 and r["predicted"] == 0 for r in got)
    assert T.query(spark, docs.limit(0), labels).count() == 0
    assert T.query(spark, docs, labels.limit(0)).count() == 4


def test_a_thousand_rare_terms_are_learned(spark):
    """Each term in 0.3 % of the toxic texts: significant, though rare."""
    rng = random.Random(3)
    word = lambda n: "".join(rng.choices("bcdfghjklmnpqrstvwxz", k=n))
    terms, common = [word(9) for _ in range(1000)], [word(6) for _ in range(200)]
    rows = []
    for i in range(20_000):
        bad = [terms[(i // 2 * 3 + k) % 1000] for k in range(3)] if i % 2 else []
        rows.append((i, " ".join(rng.sample(common, 7) + bad), i % 2))
    sample = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    learned = T.learn_terms(sample, 10_000, 10_000)
    assert len(learned) < 1100
    assert sum(any(t == w or (stem and w.startswith(t)) for t, stem, _ in learned) for w in terms) > 990
    common_hits = [t for t, stem, _ in learned if any(w.startswith(t) if stem else w == t for w in common)]
    assert not common_hits


def test_contractions_are_no_quotation():
    h = T.Hits([("idiot", False, 1)])
    for text in ("I don't care you idiot you can't read", "it's me, idiot, isn't it", "the dogs' idiot and the cats' home",
                 'a 5" idiot', "no idiot\n\"put elsewhere\"", '"cat" idiot "dog"'):
        x = h.features(text)
        assert x[0] > 0 and x[5] == 0, text
    for text in ("they shout 'you don't see, idiot' and go", "„Idiot“ steht da", "« idiot »", "‘an idiot’", '"a long line of an idiot too"',
                 'the "idiot", again', "“idiot”"):
        x = h.features(text)
        assert x[0] == 0 and x[5] > 0, text


def test_repeated_labels_and_rows_are_learned_once(spark, monkeypatch):
    rows = [(i % 40, f"word{i % 7} {'pathetic' if i % 2 else 'fine'}") for i in range(40)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] * 5 + [(None, 1)] * 9, "doc_id long, toxic int")
    seen = []
    real = T.train
    monkeypatch.setattr(T, "train", lambda x, y: seen.append(len(x)) or real(x, y))
    T.fit(docs, labels, F_true())
    assert seen == [40]


def F_true():
    from pyspark.sql import functions as F
    return F.lit(True)


def test_very_long_text(spark):
    docs = spark.createDataFrame([(1, "pathetic " + "word " * 200_000), (2, "word " * 10)], "doc_id long, text string")
    model = T.Model([("pathetic", False, 0)], __import__("numpy").ones(8), -3.0)
    got = {r["doc_id"]: r["score"] for r in T.classify(docs, model).collect()}
    assert got[1] > got[2]
