"""Operator 6 against a brute-force Katz model."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from bellwether.llm import katz

WORDS = ["the", "a", "of", "Cat", "dog", "sat", "mat", "é", "zig", "zag", "x1", "x2", "x3", "x4"]


def corpus(n, seed=3):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choices(WORDS, [40, 30, 20, 9, 8, 7, 6, 5, 4, 3, 1, 1, 1, 1], k=rng.randint(0, 25))))
            for i in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, "unknown words only here"), (None, "the cat sat"), (5, rows[5][1]),
             (n + 3, "new word the  \n CAT " * 30)]
    return rows


def toks(text):
    return (text or "").encode().lower().split() + ["</s>"]


def discounts(counts):
    n = [0] + [sum(c == r for c in counts.values()) for r in range(1, 7)]
    rest = 6 * n[6] / n[1] if n[1] else 1.0
    out = {}
    for r in range(1, 6):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - rest) / (1 - rest) if n[r] and rest < 1 else 0
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return lambda c: out.get(c, (c - 0.5) / c)


class Brute:
    def __init__(self, texts):
        self.c1, self.c2 = Counter(), Counter()
        for t in texts:
            ws = toks(t)
            self.c1.update(ws)
            self.c2.update(zip(["<s>", *ws], ws))
        self.n, self.v = sum(self.c1.values()), len(self.c1)
        self.d1, self.d2 = discounts(self.c1), discounts(self.c2)
        self.unknown = 1 - sum(self.d1(c) * c / self.n for c in self.c1.values()) if self.n else 1.0
        self.ch = Counter()
        self.after = defaultdict(list)
        for (h, w), c in self.c2.items():
            self.ch[h] += c
            self.after[h].append(w)

    def p1(self, w):
        return self.d1(self.c1[w]) * self.c1[w] / self.n if self.c1[w] else self.unknown

    def p(self, h, w):
        c = self.c2[h, w]
        if c:
            return self.d2(c) * c / self.ch[h]
        if not self.ch[h]:
            return self.p1(w)
        left = 1 - sum(self.d2(self.c2[h, x]) * self.c2[h, x] / self.ch[h] for x in self.after[h])
        return left / (1 - sum(self.p1(x) for x in self.after[h])) * self.p1(w)

    def score(self, text):
        ws = toks(text)
        return sum(math.log10(self.p(h, w)) for h, w in zip(["<s>", *ws], ws))

    def base(self, text):
        return sum(math.log10((self.c1[w] + 1) / (self.n + self.v + 1)) for w in toks(text))


@pytest.mark.parametrize("settings", [
    {}, {"head_words": 3, "hot_share": 0.05, "block_tokens": 60, "bucket_postings": 100},
    {"head_words": 6, "hot_share": 1.0, "block_tokens": 7, "bucket_postings": 5000}])
def test_scores_equal_brute_force(spark, settings):
    rows = corpus(150)
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("held", F.lit("clash"))
    got = katz.score(docs, F.coalesce(F.col("doc_id") % 3 == 1, F.lit(False)), **settings).collect()
    model = Brute([t for i, t in rows if i is None or i % 3 != 1])
    want = sorted((i if i is not None else -1, i is not None and i % 3 == 1, len(toks(t)),
                   sum(model.c1[w] > 0 for w in toks(t)), model.n, round(model.base(t), 6), round(model.score(t), 6))
                  for i, t in rows)
    assert len(got) == len(want)
    have = sorted((r[0] if r[0] is not None else -1, *r[1:5], round(r[5], 6), round(r[6], 6)) for r in got)
    for a, b in zip(have, want):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], abs=2e-6)


def test_brute_force_model_is_normalised():
    model = Brute([t for _, t in corpus(80)])
    for h in ["<s>", b"the", b"zig"]:
        assert sum(model.p(h, w) for w in model.c1) + model.p(h, b"never seen") == pytest.approx(1.0)


def test_no_training_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in katz.score(docs, F.lit(True)).collect()}
    assert got[1]["n_tokens"] == 3 and got[1]["n_known"] == 0 and got[1]["train_tokens"] == 0
    assert got[1]["base_score"] == 0 and got[1]["score"] == 0
    assert katz.score(docs.limit(0), F.lit(False)).count() == 0


def test_pack_round_trip():
    import numpy as np
    arrays = [np.arange(5, dtype=np.uint64), np.zeros(0, np.uint32), np.array([1.5, -2.0]), np.array([3], np.uint8)]
    for a, b in zip(arrays, katz.unpack(katz.pack(*arrays))):
        assert a.dtype == b.dtype and a.tolist() == b.tolist()
