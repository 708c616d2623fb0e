"""Operator 6, the stored model: scores of unseen texts against a brute-force model of any order."""

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from bellwether.llm import katz
from bellwether.llm import katz_model as M
from test_katz import corpus, discounts, toks


class Brute:
    """Katz backoff by its recursive definition."""

    def __init__(self, texts, order):
        self.order = order
        self.c = {k: Counter() for k in range(1, order + 1)}
        for t in texts:
            ws = toks(t)
            for k in self.c:
                padded = ["<s>"] * (k - 1) + ws
                self.c[k].update(tuple(padded[i:i + k]) for i in range(len(ws)))
        self.d = {k: discounts(c) for k, c in self.c.items()}
        self.n = sum(self.c[1].values())
        self.total, self.after = defaultdict(int), defaultdict(list)
        for c in self.c.values():
            for g, n in c.items():
                self.total[g[:-1]] += n
                self.after[g[:-1]].append(g[-1])

    def p(self, h, w):
        k = len(h) + 1
        c = self.c[k][h + (w,)]
        if c:
            return self.d[k](c) * c / self.total[h]
        if k == 1:
            return 1 - sum(self.d[1](x) * x / self.n for x in self.c[1].values()) if self.n else 1.0
        if not self.total[h]:
            return self.p(h[1:], w)
        left = 1 - sum(self.d[k](x) * x / self.total[h] for x in (self.c[k][h + (v,)] for v in self.after[h]))
        return left / (1 - sum(self.p(h[1:], v) for v in self.after[h])) * self.p(h[1:], w)

    def score(self, text):
        ws = toks(text)
        padded = ["<s>"] * (self.order - 1) + ws
        return sum(math.log10(self.p(tuple(padded[i:i + self.order - 1]), w)) for i, w in enumerate(ws))


@pytest.mark.parametrize("order", [1, 2, 4])
def test_unseen_texts_equal_brute_force(spark, tmp_path, order):
    rows = corpus(80)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = M.train(docs, str(tmp_path / "model"), order)
    new = [(1, "the cat sat on a mat"), (2, None), (2, None), (None, "wholly new words"), (3, "THE the of dog dog zig x1 x4 é"),
           (4, "the " * 300)]
    got = M.score(spark.createDataFrame(new, "score long, text string"), model)
    assert got.columns == ["score", "text", "score_"]
    brute = Brute([t for _, t in rows], order)
    have = sorted(((r["text"] or ""), r["score_"]) for r in got.collect())
    want = sorted(((t or ""), brute.score(t)) for _, t in new)
    assert [h[0] for h in have] == [w[0] for w in want]
    assert [h[1] for h in have] == pytest.approx([w[1] for w in want], abs=1e-6)


def test_order_two_equals_the_bulk_path(spark, tmp_path):
    docs = spark.createDataFrame([r for r in corpus(60) if r[0] is not None], "doc_id long, text string").dropDuplicates(["doc_id"])
    held = F.col("doc_id") % 3 == 1
    model = M.train(docs.where(~held), str(tmp_path / "model"), 2)
    mine = {r["doc_id"]: r["score"] for r in M.score(docs, model).collect()}
    bulk = {r["doc_id"]: r["score"] for r in katz.score(docs, held).collect()}
    assert mine == pytest.approx(bulk, abs=1e-6)


def test_empty(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    model = M.train(docs, str(tmp_path / "model"), 2)
    assert M.score(docs, model).count() == 0
    assert M.score(spark.createDataFrame([(1, "a b")], docs.schema), model).first()["score"] == 0
