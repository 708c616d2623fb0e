"""Operator 7: held-out accuracy, the risk, edge cases."""

import numpy as np
from pyspark.sql import functions as F

from bellwether.llm import quality as Q


def auc(score, y):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    pos = y == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() - 1) / 2) / (pos.sum() * (~pos).sum())


def test_held_out_on_driver_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = Q.query(spark, docs, labels).join(labels, "doc_id").where("held_out").collect()
    s, y = np.array([r["score"] for r in rows]), np.array([r["quality"] for r in rows])
    assert auc(s, y) > 0.97
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.9


def test_positive_unlabelled_training_finds_the_negatives():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(0, 1, (3000, 4)), rng.normal(2.5, 1, (1000, 4))
    m = Q.train(good[:1000], np.concatenate([good[1000:], bad]), 2000 / 3000)
    assert (Q.score(m, good[1000:]) >= 0.5).mean() > 0.9 and (Q.score(m, bad) < 0.5).mean() > 0.9


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 0.1), (2, "", 0.2), (3, "Some text. More text.", 0.3), (3, "x " * 90, 0.4),
                                  (None, "null id", 0.5), (5, "y\n" * 60_000, 0.6)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, 1, None), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = Q.query(spark, docs, labels).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    none = labels.withColumn("quality", F.lit(None).cast("int"))
    assert {r["score"] for r in Q.query(spark, docs, none).collect()} == {0.5}
    assert Q.query(spark, docs.limit(0), labels).count() == 0
    assert Q.query(spark, docs, labels.limit(0)).count() == 6


def test_prior_of_known_mixtures():
    """Positives and unlabelled mixtures whose share of positives is known."""
    rng = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.8):
        n = 6000
        good, bad = rng.normal(0, 1, (3000 + int(share * n), 4)), rng.normal(2.5, 1, (n - int(share * n), 4))
        got = Q.estimate_prior(good[:3000], rng.permutation(np.concatenate([good[3000:], bad])))
        assert abs(got - share) < 0.06, (share, got)


def test_risk_and_gradient_equal_plain_versions():
    rng = np.random.default_rng(2)
    loss = lambda z, y: float(np.log(1 + np.exp(-y * z)))
    for prior in (0.3, 0.9):
        for shift in (0.0, -3.0):                      # with the shift the negative part falls below zero
            zp, zu = rng.normal(1, 1, 7), rng.normal(shift, 1, 9)
            plus = prior * sum(loss(z, 1) for z in zp) / 7
            minus = sum(loss(z, -1) for z in zu) / 9 - prior * sum(loss(z, -1) for z in zp) / 7
            assert np.allclose(Q.risk(zp, zu, prior), (plus, minus))

            def target(a, b):
                p, m = Q.risk(a, b, prior)
                return p + m if minus >= 0 else -m
            gp, gu = Q.gradient(zp, zu, prior)
            for z, g, first in ((zp, gp, True), (zu, gu, False)):
                for k in range(len(z)):
                    step = np.zeros(len(z))
                    step[k] = 1e-5
                    ends = [target(*((z + s, zu) if first else (zp, z + s))) for s in (step, -step)]
                    assert abs((ends[0] - ends[1]) / 2e-5 - g[k]) < 1e-6


def test_other_labels_are_never_read(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    only = Q.query(spark, docs, labels.where("quality = 1"))
    assert sorted(map(tuple, only.collect()), key=str) == sorted(map(tuple, Q.query(spark, docs, labels).collect()), key=str)
