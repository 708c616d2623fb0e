"""Operator 7, quality classifier: positive-unlabelled learning.

A text is described by shape statistics (letters, symbols, repetition,
lines).  Each statistic is cut into quantile bins, and a logistic model over
the bins is trained with the non-negative unbiased PU risk: trusted
positives, unlabelled texts and an estimated class prior, never negatives.

The class prior is estimated from positives and unlabelled texts alone
(best bin estimation): a model tells positives from unlabelled texts on one
half of the sample; on the other half, the share of unlabelled texts that
score above a threshold, over that of the positives, bounds the prior from
above at every threshold, and the threshold is chosen where the bound, with
its sampling error, is least.  Labels other than positive are never read.

Training uses a bounded sample, chosen by a hash of the id: at most about
``MAX_POSITIVE`` trusted positives and ``MAX_UNLABELLED`` unlabelled ids,
one row of each.

Defined cases: null text is empty text; empty texts get a score too;
without trusted positives every score is 0.5; null labels and labels of null
ids are no labels; several labels of one id are one, positive if any is; of
several rows of an id the least text is learned from; unlabelled rows with a
null id are scored but not learned from; repeated rows are scored each; very
long texts are read whole; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bellwether.llm.common import id_split, map_rows

MAX_POSITIVE = 20_000
MAX_UNLABELLED = 40_000
BINS = 12
STEPS = 400
L2 = 1e-4
CONFIDENCE = 0.1             # chance that the bound on the prior fails, in its sampling error
_MARKS = b"|#%&$*!"


def stats(text: str | None) -> list[float]:
    """Shape statistics of a whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = max(len(raw), 1)
    by = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower, digit = int(by[65:91].sum()), int(by[97:123].sum()), int(by[48:58].sum())
    high, white = int(by[128:].sum()), int(by[32] + by[9] + by[10] + by[13])
    marks = [int(by[c]) for c in _MARKS]
    words = raw.split()
    nw = max(len(words), 1)
    distinct = len(set(words))
    pairs = len(set(zip(words, words[1:])))
    again = sum(map(bytes.__eq__, words, words[1:]))
    lines = raw.split(b"\n")
    return [
        np.log1p(n), np.log1p(len(words)), upper / max(upper + lower, 1), digit / n, high / n, white / n,
        (n - upper - lower - digit - high - white) / n, sum(marks) / n, *(m / n for m in marks),
        int(by[46]) / nw, int(by[44]) / nw, (n - white) / nw, distinct / nw, pairs / max(nw - 1, 1), again / nw,
        np.log1p(len(lines)), len(set(lines)) / len(lines), nw / len(lines), np.log1p(nw - distinct)]


def features(df: DataFrame) -> DataFrame:
    """``doc_id, x`` for every row of ``df`` (doc_id, text)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = [stats(t.as_py()) for t in batch.column(1)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"])

    kind = df.schema["doc_id"].dataType.simpleString()
    return map_rows(df.select("doc_id", "text"), run, f"doc_id {kind}, x array<double>")


@dataclass
class Model:
    edges: np.ndarray          # statistics x (BINS - 1)
    weights: np.ndarray        # statistics x BINS
    bias: float
    prior: float


def cells(edges: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Bin of each statistic, as an index into the flattened weights."""
    out = np.empty(x.shape, np.int64)
    for j in range(x.shape[1]):
        out[:, j] = np.searchsorted(edges[j], x[:, j], side="right") + j * BINS
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def bin_edges(x: np.ndarray) -> np.ndarray:
    return np.quantile(x, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T


def risk(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[float, float]:
    """The two parts of the unbiased risk with the logistic loss, from the decision values of positives and unlabelled
    texts: that of positives taken as positive, and that of negatives, R_u(-) - prior * R_p(-)."""
    positive = prior * np.logaddexp(0, -zp).mean()
    return float(positive), float(np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean())


def gradient(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """By the decision values: of the whole risk, or, where the part of negatives is below zero, of minus that part."""
    sp, su = sigmoid(zp), sigmoid(zu)
    negative_p, negative_u = -prior * sp / len(sp), su / len(su)
    if risk(zp, zu, prior)[1] >= 0:
        return prior * (sp - 1) / len(sp) + negative_p, negative_u
    return -negative_p, -negative_u


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives among the unlabelled texts, from samples of both (best bin estimation)."""
    halves = [(x[0::2], x[1::2]) for x in (positive, unlabelled)]
    (fit_p, test_p), (fit_u, test_u) = halves
    if not (len(test_p) and len(test_u)):
        return 0.5
    # positives against unlabelled texts: the order of the scores is that of the density ratio
    model = _descend(fit_p, fit_u, lambda zp, zu: (-sigmoid(-zp) / (2 * len(zp)), sigmoid(zu) / (2 * len(zu))), 0.5)
    zp, zu = np.sort(score(model, test_p)), np.sort(score(model, test_u))
    cuts = np.unique(zp)
    above_p = 1 - np.searchsorted(zp, cuts, side="left") / len(zp)
    above_u = 1 - np.searchsorted(zu, cuts, side="left") / len(zu)
    error = np.sqrt(np.log(4 / CONFIDENCE) / (2 * len(zp))) + np.sqrt(np.log(4 / CONFIDENCE) / (2 * len(zu)))
    best = int(np.argmin((above_u + 2 * error) / above_p))
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Model:
    """Minimise prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)) with the logistic loss.

    Where the estimated negative risk falls below zero, the step goes the
    other way on that part, as the non-negative estimator prescribes.  The
    decision at one half is where the same risk with the zero-one loss is
    least, on texts that a model of the other half of the sample scores.
    """
    def fit(p: np.ndarray, u: np.ndarray) -> Model:
        return _descend(p, u, lambda zp, zu: gradient(zp, zu, prior), prior)

    model = fit(positive, unlabelled)
    if min(len(positive), len(unlabelled)) >= 20:
        half = fit(positive[0::2], unlabelled[0::2])
        model.bias -= threshold(decide(half, positive[1::2]), decide(half, unlabelled[1::2]), prior)
    return model


def threshold(zp: np.ndarray, zu: np.ndarray, prior: float) -> float:
    """Where the non-negative risk with the zero-one loss is least (the middle, where it is so for a range)."""
    cuts = np.unique(np.concatenate([zp, zu]))
    missed = np.searchsorted(np.sort(zp), cuts, side="left") / len(zp)
    taken = 1 - np.searchsorted(np.sort(zu), cuts, side="left") / len(zu)
    loss = prior * missed + np.maximum(0.0, taken - prior * (1 - missed))
    best = np.flatnonzero(loss <= loss.min() + 1e-12)
    return float((cuts[best[0]] + cuts[best[-1]]) / 2)


def decide(model: Model, x: np.ndarray) -> np.ndarray:
    """Decision values: the log odds of being positive."""
    return model.weights.ravel()[cells(model.edges, x)].sum(axis=1) + model.bias


def _descend(positive: np.ndarray, unlabelled: np.ndarray, slope, prior: float) -> Model:
    """Adam steps along ``slope``, the gradient by the decision values of positives and unlabelled texts."""
    both = np.concatenate([positive, unlabelled])
    edges = bin_edges(both)
    cp, cu = cells(edges, positive), cells(edges, unlabelled)
    size = both.shape[1] * BINS
    w, b = np.zeros(size), 0.0
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    for t in range(1, STEPS + 1):
        gp, gun = slope(w[cp].sum(axis=1) + b, w[cu].sum(axis=1) + b)
        g = np.bincount(cp.ravel(), np.repeat(gp, cp.shape[1]), size) \
            + np.bincount(cu.ravel(), np.repeat(gun, cu.shape[1]), size) + L2 * w
        gb = gp.sum() + gun.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        rate = 0.05 / (1 + t / 200)
        w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        b -= rate * (mb / (1 - 0.9 ** t)) / (np.sqrt(vb / (1 - 0.999 ** t)) + 1e-8)
    return Model(edges, w.reshape(-1, BINS), float(b), prior)


def score(model: Model, x: np.ndarray) -> np.ndarray:
    if not len(model.edges):
        return np.full(len(x), model.prior)
    return sigmoid(decide(model, x))


def fit(docs: DataFrame, labels: DataFrame, usable: Column, max_positive: int = MAX_POSITIVE,
        max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """Train on labels of the rows that are ``usable`` and on unlabelled texts."""
    known = labels.where(usable & (F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    n_known, n_docs = known.count(), docs.where(F.col("doc_id").isNotNull()).count()
    nothing = Model(np.zeros((0, 0)), np.zeros((0, 0)), 0.0, 0.5)
    if not n_known:
        return nothing
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("quality")), F.lit(1_000_000)) / F.lit(1_000_000.0)
    trusted = known.where(draw < max_positive / n_known)
    slim = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")

    def one_row(rows: DataFrame) -> DataFrame:
        return rows.groupBy("doc_id").agg(F.min("text").alias("text"))

    # few ids are drawn, so they go to the texts and not the texts to them
    pos = features(one_row(slim.join(F.broadcast(trusted), "doc_id")))
    unl = features(one_row(slim.where(draw < max_unlabelled / max(n_docs, 1))))
    x_pos = np.array([r[0] for r in pos.select("x").collect()])     # bounded by max_positive
    x_unl = np.array([r[0] for r in unl.select("x").collect()])     # bounded by max_unlabelled
    if not len(x_pos) or not len(x_unl):
        return nothing
    return train(x_pos, x_unl, estimate_prior(x_pos, x_unl))


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row of ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.array([stats(t.as_py()) for t in batch.column(1)])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(score(model, x), pa.float64())],
                                          ["doc_id", "score"])

    return map_rows(docs.select("doc_id", "text"), run, f"doc_id {kind}, score double")


def held_out() -> Column:
    return id_split("doc_id", 3, 1)


def query(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The result of the contract."""
    out = classify(docs, fit(docs, labels, ~held_out()))
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
