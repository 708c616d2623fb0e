"""Operator 4, language ID: interpolated Kneser-Ney character models.

Per language a character n-gram model with interpolated Kneser-Ney
smoothing is trained and stored in sorted hash arrays (one sorted array of
64-bit n-gram hashes per order, one column of probabilities and of
interpolation weights per language).  A text gets the language of the
lowest cross-entropy per character.  Rejection is calibrated by length:
held-back training texts are cut to pieces of the lengths ``CUTS``, and a
language's limit for a length is what all but a share ``reject_share`` of its
pieces stay under, plus ``MARGIN`` of the way from there to the cost of a
character about which nothing is known.  A text above the limit for its
length, or of which the best model does not know more than ``MAX_UNKNOWN``
of the characters, is not accepted; the score falls with that share.

Texts are read as letters (lower-cased) with single spaces between runs of
them; all else is a space.  A batch's n-grams are numbered order by order,
so every distinct n-gram is looked up once per block of texts.

Training uses a bounded sample: about ``sample_rows`` whole texts per
language, chosen by a hash of id and text, of the languages that hold at
least ``MIN_SHARE`` of the labelled rows (so there are at most 1 /
``MIN_SHARE`` of them, however dirty ``lang`` is).  Everything else covers
all rows.

Defined cases: null text and text without letters give ``und`` with score
0 and are rejected; without any training text all rows do; ties between
languages go to the first in alphabetical order; very long texts are read
whole: those longer than ``SEGMENT`` characters are scored in segments whose
sums are added; a language without held-back pieces of some length has the
cost of an unknown character as its limit there; repeated rows are scored
each; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bellwether.llm.common import id_split, map_rows

UND = "und"
ORDER = 4
SAMPLE_ROWS = 2_000          # whole texts per language for training and calibration
SHARPNESS = 8.0              # score: softmax of minus the cross-entropies times this
MIN_SHARE = 1e-4             # of the labelled rows, that a language to be learned holds at least
REJECT_SHARE = 1e-4
MARGIN = 0.25                # for clean texts unlike any in the sample; more where there are under 40 pieces
MAX_UNKNOWN = 0.25           # share of characters that the best model has never seen
CUTS = (5, 10, 20, 40, 80, 160, 320, 640)     # lengths in letters at which rejection is calibrated
PIECES = 4                   # of a held-back text, for each of these lengths
SEGMENT = 200_000
BLOCK_CHARS = 400_000
_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _extend_hash(h: np.ndarray, cp: np.ndarray) -> np.ndarray:
    """Hash of an n-gram from the hash of its first n-1 characters and its last."""
    with np.errstate(over="ignore"):
        x = (h ^ (cp.astype(np.uint64) + np.uint64(1))) * _MUL
        x = (x ^ (x >> np.uint64(31))) * _MIX
        return x ^ (x >> np.uint64(29))


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased letters with single spaces, of all texts in a row; and each text's length."""
    if not texts:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    joined = "".join(texts)
    cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) for t in texts])
    seen = np.zeros(0x110000, bool)
    seen[cps] = True
    table = np.full(0x110000, 32, np.uint32)
    for cp in np.flatnonzero(seen):
        ch = chr(cp)
        if ch.isalpha():
            table[cp] = ord(ch.lower()[0])
    low = table[cps]
    space = low == 32
    keep = np.empty(len(low), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    first = np.concatenate(([0], ends[:-1]))
    at = first[first < ends]                       # starts of texts that are not empty
    keep[at] = ~space[at]
    total = np.concatenate(([0], np.cumsum(keep)))
    return low[keep], total[ends] - total[first]


@dataclass
class Grams:
    """Numbered n-grams of one order in a block: per position, and per distinct one."""

    ids: np.ndarray           # at every position of the padded block
    hashes: np.ndarray        # of each distinct n-gram
    context: np.ndarray       # number of its first n-1 characters, one order lower
    suffix: np.ndarray        # number of its last n-1 characters, one order lower


def number_grams(chars: np.ndarray, lengths: np.ndarray, order: int) -> tuple[list[Grams], np.ndarray]:
    """N-grams of orders 1..order of all texts, each padded by order-1 spaces; and the scored positions."""
    pad = order - 1
    n = len(chars)
    text_of = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(n) + (text_of + 1) * pad
    block = np.full(n + len(lengths) * pad, 32, np.uint32)
    block[place] = chars
    alphabet, ids = np.unique(block, return_inverse=True)
    ids = ids.astype(np.int64)
    single = ids
    hashes = _extend_hash(np.zeros(len(alphabet), np.uint64), alphabet)
    none = np.zeros(len(alphabet), np.int64)
    grams = [Grams(ids, hashes, none, none)]
    size = len(alphabet)
    for _ in range(1, order):
        low = grams[-1]
        key = np.empty(len(block), np.int64)
        key[1:] = low.ids[:-1] * size + single[1:]
        key[0] = low.ids[0] * size + single[0]
        if len(low.hashes) * size <= 1 << 22:
            where = np.full(len(low.hashes) * size, -1, np.int64)
            where[key] = np.arange(len(key))
            distinct = np.flatnonzero(where >= 0)
            pos = where[distinct]
            where[distinct] = np.arange(len(distinct))
            ids = where[key]
        else:
            distinct, pos, ids = np.unique(key, return_index=True, return_inverse=True)
        grams.append(Grams(ids, _extend_hash(low.hashes[distinct // size], alphabet[distinct % size]),
                           distinct // size, low.ids[pos]))
    return grams, place


@dataclass
class Model:
    """Sorted hash arrays by order; one column per language."""

    langs: list[str]
    order: int
    keys: list[np.ndarray]        # n-gram hashes of order k+1
    probs: list[np.ndarray]       # probability per language, 0: unseen
    ctx_keys: list[np.ndarray]    # context hashes, for n-grams of order k+2
    weights: list[np.ndarray]     # interpolation weight per language, 1: unseen
    floor: float                  # probability of any one character below order 1
    limits: np.ndarray | None = None      # cross-entropy a text may have, by length (CUTS) and language


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return at, (keys[at] == wanted) if len(keys) else np.zeros(len(wanted), bool)


def train(counts: dict[str, tuple[np.ndarray, np.ndarray]], order: int = ORDER) -> Model:
    """Kneser-Ney models from top-order n-gram counts per language.

    ``counts[lang]``: codepoints (n x order) of the distinct n-grams, and
    their counts.  Lower orders use continuation counts; each order has its
    own absolute discount n1 / (n1 + 2 n2).
    """
    langs = sorted(counts)
    alphabet = {int(c) for g, _ in counts.values() for c in np.unique(g)}
    floor = 1.0 / (len(alphabet) + 1)
    tables: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(order)]
    contexts: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(order)]
    for lang in langs:
        grams, n = counts[lang]
        levels: list[tuple[np.ndarray, np.ndarray]] = [(grams, n.astype(np.float64))]
        for _ in range(order - 1):
            lower, cont = np.unique(levels[-1][0][:, 1:], axis=0, return_counts=True)
            levels.append((lower, cont.astype(np.float64)))
        levels.reverse()
        below = {}
        for k, (g, c) in enumerate(levels):
            h = np.zeros(len(g), np.uint64)
            ctx = h
            for j in range(g.shape[1]):
                ctx, h = h, _extend_hash(h, g[:, j])
            suffix = np.zeros(len(g), np.uint64)
            for j in range(1, g.shape[1]):
                suffix = _extend_hash(suffix, g[:, j])
            n1, n2 = (c == 1).sum(), (c == 2).sum()
            d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
            ctx_keys, inv = np.unique(ctx, return_inverse=True)
            total = np.bincount(inv, c)
            kinds = np.bincount(inv)
            weight = d * kinds / total
            if k == 0:
                lower = np.full(len(g), floor)
            else:
                at, _ = _find(below["keys"], suffix)
                lower = below["probs"][at]
            p = np.maximum(c - d, 0) / total[inv] + weight[inv] * lower
            sort = np.argsort(h)
            below = {"keys": h[sort], "probs": p[sort]}
            tables[k].append((below["keys"], below["probs"]))
            contexts[k].append((ctx_keys, weight))
    keys, probs, ctx_keys, weights = [], [], [], []
    for k in range(order):
        for parts, out_keys, out_values, rest in ((tables, keys, probs, 0.0), (contexts, ctx_keys, weights, 1.0)):
            every = np.unique(np.concatenate([p[0] for p in parts[k]]))
            values = np.full((len(every), len(langs)), rest, np.float32)
            for j, (own, v) in enumerate(parts[k]):
                values[np.searchsorted(every, own), j] = v
            out_keys.append(every)
            out_values.append(values)
    return Model(langs, order, keys, probs, ctx_keys, weights, floor)


def _add_up(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Summed negative log probabilities and unknown characters (texts x languages), and characters scored."""
    chars, lengths = letters(texts)
    sums = np.zeros((len(texts), len(model.langs)))
    strange = np.zeros((len(texts), len(model.langs)))
    if not len(chars):
        return sums, lengths, strange
    grams, place = number_grams(chars, lengths, model.order)
    p = np.full((1, len(model.langs)), model.floor, np.float32)
    for k, g in enumerate(grams):
        at, known = _find(model.keys[k], g.hashes)
        ctx = np.zeros(1, np.uint64) if k == 0 else grams[k - 1].hashes
        ctx_at, ctx_known = _find(model.ctx_keys[k], ctx)
        weight = np.where(ctx_known[:, None], model.weights[k][ctx_at], np.float32(1))
        own = np.where(known[:, None], model.probs[k][at], np.float32(0))
        lower = weight[g.context] * p[g.suffix]
        p = np.where(own > 0, own, lower)
        if k == 0:
            unknown = own == 0
    at = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    full = lengths > 0
    for out, value, ids in ((sums, -np.log(p), grams[-1].ids), (strange, unknown, grams[0].ids)):
        out[full] = np.add.reduceat(value[ids[place]], at[full], axis=0, dtype=np.float64)
    return sums, lengths, strange


def cross_entropy(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Summed negative log probabilities (texts x languages) and numbers of characters scored."""
    return _add_up(model, texts)[:2]


def _blocks(texts: list[str]) -> list[tuple[list[int], list[str]]]:
    """Segments of texts, in blocks of bounded size, with the text each belongs to."""
    blocks: list[tuple[list[int], list[str]]] = [([], [])]
    size = 0
    for i, t in enumerate(texts):
        at = 0
        while True:
            end = len(t) if len(t) - at <= SEGMENT else (t.rfind(" ", at + 1, at + SEGMENT) + 1 or at + SEGMENT)
            if size and size + end - at > BLOCK_CHARS:
                blocks.append(([], []))
                size = 0
            blocks[-1][0].append(i)
            blocks[-1][1].append(t[at:end])
            size += end - at
            at = end
            if at >= len(t):
                break
    return blocks


def survey(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per whole text: cross-entropy per character and share of unknown characters, by language; characters scored."""
    sums, strange = (np.zeros((len(texts), len(model.langs))) for _ in range(2))
    lengths = np.zeros(len(texts))
    for owner, parts in _blocks([t or "" for t in texts]):
        s, m, u = _add_up(model, parts)
        np.add.at(sums, owner, s)
        np.add.at(lengths, owner, m)
        np.add.at(strange, owner, u)
    n = np.maximum(lengths, 1)[:, None]
    return sums / n, strange / n, lengths


def measure(model: Model, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Cross-entropy per character (texts x languages) and characters scored, of whole texts."""
    h, _, lengths = survey(model, texts)
    return h, lengths


def limit_for(model: Model, n: np.ndarray, lang: np.ndarray) -> np.ndarray:
    """The limit for texts of ``n`` letters: between two calibrated lengths, on the line in log n."""
    x, at = np.log2(np.maximum(n, 1)), np.log2(CUTS)
    return np.array([np.interp(a, at, model.limits[:, k]) for a, k in zip(x, lang)])


def predict(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and acceptance of every text."""
    if not model.langs:
        return [UND] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
    h, strange, m = survey(model, texts)
    best = h.argmin(axis=1)
    rows = np.arange(len(texts))
    low, unknown = h[rows, best], strange[rows, best]
    score = (1.0 - unknown) / np.exp(-SHARPNESS * (h - low[:, None])).sum(axis=1)
    some = m > 0
    accepted = some & (unknown <= MAX_UNKNOWN)
    if model.limits is not None:
        accepted &= low <= limit_for(model, m, best)
    return [model.langs[b] if s else UND for b, s in zip(best, some)], np.where(some, score, 0.0), accepted


def top_grams(texts: list[str], order: int) -> tuple[list[str], np.ndarray]:
    """Distinct top-order n-grams of texts, with counts."""
    chars, lengths = letters(texts)
    if not len(chars):
        return [], np.zeros(0, np.int64)
    pad = order - 1
    place = np.arange(len(chars)) + (np.repeat(np.arange(len(lengths)), lengths) + 1) * pad
    block = np.full(len(chars) + len(lengths) * pad, 32, np.uint32)
    block[place] = chars
    windows = np.lib.stride_tricks.sliding_window_view(block, order)[place - pad]
    raw = np.ascontiguousarray(windows).view(f"V{4 * order}").ravel()
    distinct, n = np.unique(raw, return_counts=True)
    return [d.tobytes().decode("utf-32-le", "surrogatepass") for d in distinct], n


def _sample(docs: DataFrame, usable, sample_rows: int) -> DataFrame:
    """About ``sample_rows`` rows per language: ``lang, text, calibrate``."""
    pool = docs.where(usable & F.col("lang").isNotNull()).select("doc_id", "lang", "text")
    sizes = pool.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    total = pool.count()
    # at most 1 / MIN_SHARE rows, so their broadcast is bounded
    shares = sizes.where(F.col("n") >= F.lit(MIN_SHARE * total)).select(
        "lang", F.least(F.lit(1.0), F.lit(float(sample_rows)) / F.col("n")).alias("share"))
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.col("text"), F.lit("langid")), F.lit(1_000_000))
    return pool.join(F.broadcast(shares), "lang").where(draw < F.col("share") * F.lit(1_000_000)).select(
        "lang", F.coalesce("text", F.lit("")).alias("text"), (F.pmod(draw, F.lit(5)) == 0).alias("calibrate"))


def fit(docs: DataFrame, usable=None, order: int = ORDER, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Train and calibrate on a bounded sample of the rows that are ``usable`` (all by default)."""
    usable = F.lit(True) if usable is None else usable
    sample = _sample(docs, usable, sample_rows)

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs = batch.column(0).to_pylist()
        texts = batch.column(1).to_pylist()
        out_lang, out_gram, out_n = [], [], []
        for lang in sorted(set(langs)):
            for _, part in _blocks([t for t, x in zip(texts, langs) if x == lang]):
                grams, n = top_grams(part, order)
                out_lang += [lang] * len(grams)
                out_gram += grams
                out_n += n.tolist()
        return pa.RecordBatch.from_arrays(
            [pa.array(out_lang, pa.string()), pa.array(out_gram, pa.string()), pa.array(out_n, pa.int64())],
            ["lang", "gram", "n"])

    counted = map_rows(sample.where(~F.col("calibrate")).select("lang", "text"), count,
                       "lang string, gram string, n long")
    table = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()   # bounded by the sample
    if table.empty:
        return Model([], order, [], [], [], [], 1.0)
    counts = {}
    for lang, own in table.sort_values(["lang", "gram"]).groupby("lang"):
        cps = np.frombuffer("".join(own["gram"]).encode("utf-32-le", "surrogatepass"), np.uint32)
        counts[lang] = (cps.reshape(-1, order), own["n"].to_numpy())
    model = train(counts, order)
    return calibrate(model, sample.where("calibrate"))


def pieces(text: str) -> list[tuple[int, str]]:
    """Up to ``PIECES`` pieces of each of the lengths ``CUTS``, spread over the letters of a text."""
    chars, _ = letters([text])
    line = chars.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    out = []
    for c, size in enumerate(CUTS):
        n = min(PIECES, len(line) // size)
        out += [(c, line[at:at + size]) for at in (np.arange(n) * (len(line) // max(n, 1))).tolist()]
    return out


def calibrate(model: Model, sample: DataFrame, reject_share: float = REJECT_SHARE) -> Model:
    """The limits of acceptance, from the held-back texts ``sample`` (lang, text)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        got = [(model.langs.index(lang), c, piece)
               for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
               if lang in model.langs for c, piece in pieces(text)]
        if not got:                                  # no text of the batch is long enough for a piece
            return None
        own = np.array([g[0] for g in got], np.int64)
        h, n = measure(model, [g[2] for g in got])
        ok = n > 0
        return pa.RecordBatch.from_arrays(
            [pa.array(own[ok], pa.int32()), pa.array(np.array([g[1] for g in got], np.int64)[ok], pa.int32()),
             pa.array(h[ok, own[ok]], pa.float64())], ["lang", "cut", "h"])

    found = map_rows(sample.select("lang", "text"), run, "lang int, cut int, h double").toPandas()
    blank = -np.log(model.floor)
    model.limits = np.full((len(CUTS), len(model.langs)), blank)
    for (lang, cut), own in found.groupby(["lang", "cut"])["h"]:
        usual = float(np.quantile(own, 1 - reject_share))
        model.limits[cut, lang] = usual + max(MARGIN, min(1.0, 10 / len(own))) * max(blank - usual, 0.0)
    return model


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score, accepted`` of every row of ``docs`` (doc_id, text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lang, score, ok = predict(model, batch.column(1).to_pylist())
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(ok, pa.bool_())],
            ["doc_id", "lang_pred", "score", "accepted"])

    return map_rows(docs.select("doc_id", "text"), run,
                    f"doc_id {kind}, lang_pred string, score double, accepted boolean")


def keep_accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose language is accepted, with all their columns.

    Only the text goes to Python, and one truth value comes back.
    """
    def run(text: pd.Series) -> pd.Series:
        return pd.Series(predict(model, [None if t is None else t for t in text])[2])

    return docs.where(F.pandas_udf(run, T.BooleanType())("text"))


def held_out():
    return id_split("doc_id", 4, 2)


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The result of the contract, with ``accepted``."""
    model = fit(docs, ~held_out())
    return classify(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "accepted")
