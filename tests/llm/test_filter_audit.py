"""Operator 12: the transducer against plain Python, the audit against its SQL and a brute force over all orders."""

import random
import re
from itertools import permutations

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from bellwether.llm import filter_audit as A
from bellwether.llm.oracle import OP12

ALPHABET = [" ", "\t", "\n", "\x0b", "\x0c", "\r", "A", "b", "é", "😀", "#", "|", " ", " ", "Z", "0", "\x1c", "\x85", "\x00"]


def plain(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [len(ws), len(set(ws)), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text))]


@pytest.mark.parametrize("block", [A.BLOCK_BYTES, 64, 7])
def test_counts(monkeypatch, block):
    monkeypatch.setattr(A, "BLOCK_BYTES", block)
    rng = random.Random(1)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 60))) for _ in range(1500)]
    texts += [None, "", " ", "x", "ab " * 3, "a" * 300, "word " * 500]
    want = np.array([plain(t) for t in texts])
    assert (A.count_texts(pa.array(texts), A.Powers()) == want).all()
    assert (A.count_texts(pa.array(["zz", *texts])[1:], A.Powers()) == want).all()
    assert A.count_texts(pa.array([], pa.string()), A.Powers()).shape == (0, 5)


def test_words_with_one_hash_stay_apart():
    """Every hash the same: the bytes alone decide, the slots are tried one after the other."""
    words = [b"ab", b"cd", b"ab", b"abc", b"cd", b"x"]
    data = np.frombuffer(b"".join(words), np.uint8)
    end = np.cumsum([len(w) for w in words])
    begin = end - [len(w) for w in words]
    owner = np.array([0, 0, 0, 0, 1, 1])
    new = A.first_of_kind(data, owner, begin, end, np.zeros(6, np.uint64))
    kinds = {(o, w) for o, w in zip(owner.tolist(), words)}
    assert new.sum() == len(kinds) and {(o, w) for o, w, n in zip(owner.tolist(), words, new) if n} == kinds


def corpus():
    rng = random.Random(4)
    rows = []
    for k in range(300):
        n = rng.choice([0, 5, 99, 100, 101, 150])
        kinds = rng.choice([3, 60, 400])
        ws = [f"w{rng.randrange(kinds)}" for _ in range(n)]
        if rng.random() < .3:
            ws = [w.upper() for w in ws]
        if rng.random() < .3:
            ws.append("#")
        rows.append((k, " ".join(ws), rng.choice(["en", "de", None, ""]), "clash"))
    rows += [(rng.randrange(1000), t, lang, s) for _, t, lang, s in rng.choices(rows, k=150)]
    rows += [(None, rows[1][1], "en", ""), (None, None, "en", ""), (7, None, None, ""), (900, "", "fr", "")] + rows[:5]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1])) for k in range(0, 1000, 2)] + [(2, 1, 1), (None, 1, 1)]
    return rows, labels


def test_equals_the_sql_and_brute_force(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, part string")
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = A.query(spark, docs, known)
    got = sorted((r.asDict() for r in out.collect()), key=str)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, part VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    con.execute("CREATE TABLE labels (doc_id BIGINT, quality INT, toxic INT)")
    con.executemany("INSERT INTO labels VALUES (?, ?, ?)", labels)
    found = con.execute(OP12)
    names = [d[0] for d in found.description]
    assert got == sorted((dict(zip(names, r)) for r in found.fetchall()), key=str)

    good, toxic = ({k for k, *v in labels if k is not None and v[j] == 1} for j in (0, 1))
    least = {}
    for k, t, *_ in rows:
        if k is not None:
            least[t or ""] = min(least.get(t or "", k), k)
    by = {}
    for k, t, lang, _ in rows:
        w, d, c, p, s = plain(t)
        fails = {f for f, x in zip("ABCDE", (w < 100, 100 * d < 80 * w, 100 * c > 10 * p, s > 0,
                                              k is not None and k > least[t or ""])) if x}
        by.setdefault(lang or "", []).append((k, fails))
    keyed = {(r["part"], r["filter_order"], r["step"]): r for r in got}
    assert len(keyed) == len(got) == len(by) * 600
    for part, docs_ in by.items():
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            alive = docs_
            for step, f in enumerate(order, 1):
                hit = [x for x in alive if f in x[1]]
                gone = len([x for x in docs_ if f in x[1]]) - len(hit)
                alive = [x for x in alive if f not in x[1]]
                shapley[f] += len(hit)
                r = keyed[part, "".join(order), step]
                assert [r[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")] == [
                    len(alive), len(hit), gone, sum(x[1] == {f} for x in docs_), sum(x[0] in good for x in hit),
                    sum(x[0] in toxic for x in hit)]
        assert all(keyed[part, "ABCDE", i + 1]["shapley"] == shapley[f] for i, f in enumerate("ABCDE"))


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert A.query(spark, docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0
    one = spark.createDataFrame([(1, "a", "en")], docs.schema)
    assert A.query(spark, one, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 600
