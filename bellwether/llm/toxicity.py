"""Operator 8, toxicity: Levenshtein automata over a lexicon trie.

Abusive terms are learned from labelled texts: words, and stems (beginnings
shared by several words), that are significantly more frequent in toxic texts.
They form one trie.  A word runs through the product of the trie with the
Levenshtein automata of its terms, whose states are sets of (trie node,
edits so far); the product is made deterministic as it is used, so a word
costs one table step per character and most words die after a few.  Terms
of up to 4 characters must match exactly, up to 8 with one edit, longer ones
with two; a term whose misspellings turn up in clean training texts must
match exactly too, whatever its length.

A hit counts for its distance and for its context: in a window around it,
quotation marks or words of reporting separate quotation from abuse.  A
logistic model over the counted hits, fitted on the same labelled texts,
gives the score.

Training uses a bounded sample, chosen by a hash of the id: at most about
``MAX_ROWS`` toxic and as many clean ids, one row of each.  A term is chosen by the
significance of its counts in them, corrected for the number of candidates;
the lexicon has no other bound.

Defined cases: null text is empty text and scores as a text without hits;
without toxic labels every score is 0, without clean ones 1; null labels and
labels of null ids are no labels; several labels of an id are one, toxic if
any is; of several rows of a labelled id the least text is learned from;
repeated rows are scored each; very long texts are read whole; quotation
marks pair within a line; ties in a term's rank go to the alphabet; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bellwether.llm.common import id_split, map_rows, materialize

MAX_ROWS = 20_000
ALPHA = 0.05                 # chance that any term of the lexicon is there by accident
MAX_STRAY = 0.002            # share of clean texts that may have a misspelling of a term
MIN_RATIO = 20.0             # smoothed ratio of its rates in toxic and clean texts
STEM = (4, 12)               # lengths of stems
MIN_ENDINGS = 3              # different words a stem must begin
WINDOW = 6                   # words of context to either side
STATES = 200_000             # product states kept before starting afresh
STEPS = 300
_STRIP = re.compile(r"^[\W_]+|[\W_]+$")
# Paired marks around at most a line; an apostrophe between letters is no mark.
_QUOTED = re.compile(
    r'"[^"\n]{1,600}"|“[^“”\n]{1,600}”|„[^„“”\n]{1,600}[“”]|«[^«»\n]{1,600}»|»[^«»\n]{1,600}«|‹[^‹›\n]{1,600}›'
    r"|(?<!\w)'(?!\s)(?:[^'\n]|(?<=\w)'(?=\w)){1,600}'(?!\w)|‘(?:[^‘’\n]|(?<=\w)’(?=\w)){1,600}’(?!\w)")
_MARK = re.compile("[\"“„«»‹'‘]")      # what a quotation may begin with
_TOKEN = re.compile(r"\S+")
#: Words that report what somebody else said.
REPORTING = frozenset(
    "said says wrote writes called quoted quote word term insult shouted sagte schrieb genannt wort "
    "dit écrit appelé mot dijo escribió llamó palabra".split())


def plain(token: str) -> str:
    return _STRIP.sub("", token).lower()


def edits_allowed(length: int) -> int:
    return 0 if length <= 4 else 1 if length <= 8 else 2


#: A term, whether it is a stem, and the edits it allows.
Term = tuple[str, bool, int]


class Matcher:
    """The product of the lexicon trie and the Levenshtein automata, made deterministic on demand."""

    def __init__(self, terms: list[Term]):
        self.children: list[dict[str, int]] = [{}]
        self.budget = [0]                        # most edits any term below a node allows
        self.ends: list[list[int]] = [[]]        # terms that end at a node
        self.terms = terms
        for k, (term, _, most) in enumerate(terms):
            node = 0
            self.budget[0] = max(self.budget[0], most)
            for ch in term:
                if ch not in self.children[node]:
                    self.children[node][ch] = len(self.children)
                    self.children.append({})
                    self.budget.append(0)
                    self.ends.append([])
                node = self.children[node][ch]
                self.budget[node] = max(self.budget[node], most)
            self.ends[node].append(k)
        self.reset()

    def reset(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.final: list[tuple[int, int]] = []   # least edits of a term ending here; of a stem passed here
        self.start = self.number({(0, 0)})

    def number(self, pairs: set[tuple[int, int]]) -> int:
        """State of the set, closed under skipping term characters, with dominated pairs left out."""
        best: dict[int, int] = {}
        todo = sorted(pairs, key=lambda p: p[1], reverse=True)
        while todo:
            node, e = todo.pop()
            if e > self.budget[node] or best.get(node, 99) <= e:
                continue
            best[node] = e
            todo += [(child, e + 1) for child in self.children[node].values()]
        key = frozenset(best.items())
        state = self.states.get(key)
        if state is None:
            state = self.states[key] = len(self.sets)
            self.sets.append(key)
            self.moves.append({})
            word = stem = 99
            for node, e in best.items():
                for k in self.ends[node]:
                    _, is_stem, most = self.terms[k]
                    if e <= most:
                        word = min(word, e)
                        if is_stem:
                            stem = min(stem, e)
            self.final.append((word, stem))
        return state

    def step(self, state: int, ch: str) -> int:
        out: set[tuple[int, int]] = set()
        for node, e in self.sets[state]:
            out.add((node, e + 1))                                        # an extra character
            for c, child in self.children[node].items():
                out.add((child, e if c == ch else e + 1))                 # the same, or another
        nxt = self.number(out)
        self.moves[state][ch] = nxt
        return nxt

    def distance(self, word: str) -> int:
        """Least edits by which ``word`` is a term or begins with a stem; 99 if none allows it."""
        if len(self.sets) > STATES:
            self.reset()
        state, best = self.start, 99
        moves, final = self.moves, self.final
        for ch in word:
            nxt = moves[state].get(ch)
            state = self.step(state, ch) if nxt is None else nxt
            if not self.sets[state]:
                return best
            if final[state][1] < best:
                best = final[state][1]
        return min(best, final[state][0])


    def misspelled(self, word: str) -> set[int]:
        """Terms of which ``word`` is (or begins with) a misspelling, if it is no term itself."""
        if self.distance(word) in (0, 99):
            return set()
        found: set[int] = set()
        state = self.start
        for i, ch in enumerate(word, 1):
            nxt = self.moves[state].get(ch)
            state = self.step(state, ch) if nxt is None else nxt
            for node, e in self.sets[state]:
                found.update(k for k in self.ends[node]
                             if e <= self.terms[k][2] and (self.terms[k][1] or i == len(word)))
        return found


def quoted_words(text: str, at: list[int]) -> list[bool]:
    """For each of the words numbered ``at`` (ascending): does it lie between paired quotation marks?"""
    spans, place = [], 0
    while (mark := _MARK.search(text, place)) is not None:
        found = _QUOTED.match(text, mark.start())
        place = found.end() if found else mark.end()
        if found:
            spans.append(found.span())
    if not spans:
        return [False] * len(at)
    wanted, out, k = set(at), [], 0
    for i, m in enumerate(_TOKEN.finditer(text)):
        if i in wanted:
            while k < len(spans) and spans[k][1] <= m.start():
                k += 1
            out.append(k < len(spans) and spans[k][0] < m.end())
    return out


def reported(words: list[str], i: int) -> bool:
    """Is word ``i`` near a word of reporting?"""
    return any(plain(w) in REPORTING for w in words[max(0, i - WINDOW): i + WINDOW + 1])


class Hits:
    """Hits of a text by distance and context; remembers the words it has seen."""

    def __init__(self, terms: list[Term]):
        self.matcher = Matcher(terms)
        self.seen: dict[str, int] = {}

    def distance(self, token: str) -> int:
        d = self.seen.get(token)
        if d is None:
            if len(self.seen) > 1_000_000:
                self.seen.clear()
            word = plain(token)
            d = self.seen[token] = self.matcher.distance(word) if word else 99
        return d

    def features(self, text: str | None) -> list[float]:
        words = (text or "").split()
        seen = self.seen
        n = [[0, 0, 0], [0, 0, 0]]
        found = []
        for i, w in enumerate(words):
            d = seen.get(w)
            if d is None:
                d = self.distance(w)
            if d < 3:
                found.append((i, d))
        inside = quoted_words(text, [i for i, _ in found]) if found else []
        for (i, d), q in zip(found, inside):
            n[q or reported(words, i)][d] += 1
        # a misspelled hit counts as a hit; training finds what it is worth less
        (n0, n1, n2), quote = n[0], sum(n[1])
        hits = n0 + n1 + n2
        return [np.log1p(hits), float(hits > 0), np.log1p(n1), np.log1p(n2), float(hits > 0 and not n0),
                np.log1p(quote), float(quote > 0), np.log1p(1000 * hits / max(len(words), 1))]


def candidates(text: str) -> set[tuple[str, bool]]:
    """Words of a text, and the stems they begin with."""
    out: set[tuple[str, bool]] = set()
    for w in {plain(t) for t in set(text.split())}:
        if len(w) >= 3:
            out.add((w, False))
            for k in range(STEM[0], min(STEM[1], len(w)) + 1):
                out.add((w[:k], True))
    return out


def _counts(sample: DataFrame) -> DataFrame:
    """``term, stem, n, other``: toxic and clean texts that have each candidate term."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n: tuple[Counter, Counter] = Counter(), Counter()
        for t, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
            n[toxic == 1].update(candidates(t.as_py() or ""))
        keys = list(n[0] | n[1])
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_()),
             pa.array([n[1][k] for k in keys], pa.int64()), pa.array([n[0][k] for k in keys], pa.int64())],
            ["term", "stem", "n", "other"])

    return map_rows(sample.select("text", "toxic"), run, "term string, stem boolean, n long, other long").groupBy(
        "term", "stem").agg(F.sum("n").alias("n"), F.sum("other").alias("other"))


def _surprise(n: Column, other: Column, share: float) -> Column:
    """Chernoff bound, as -ln p, of ``n`` toxic texts among ``n + other`` if toxic texts were a ``share`` of them."""
    total = n + other
    rate = n / total
    apart = rate * F.log(rate / F.lit(share)) + F.when(other > 0, (other / total) * F.log(
        (other / total) / F.lit(1 - share))).otherwise(F.lit(0.0))
    return F.when(rate > F.lit(share), total * apart).otherwise(F.lit(0.0))


def learn_terms(sample: DataFrame, n_toxic: int, n_clean: int) -> list[Term]:
    """Terms that are significantly more frequent in toxic than in clean texts; a stem replaces the words it begins."""
    counts = materialize(_counts(sample).where("n > 0"), "term-counts")
    least = float(np.log(max(counts.count(), 1) / ALPHA))
    ratio = ((F.col("n") + 0.5) / (n_toxic + 1)) / ((F.col("other") + 0.5) / (n_clean + 1))
    chosen = counts.where((ratio >= MIN_RATIO) & (_surprise(
        F.col("n"), F.col("other"), n_toxic / (n_toxic + n_clean)) >= least)).select("term", "stem", "n").collect()
    in_toxic = {(r["term"], r["stem"]): r["n"] for r in chosen}
    good = set(in_toxic)
    kinds: Counter = Counter()
    for term, stem in good:
        if not stem:
            kinds.update(term[:k] for k in range(STEM[0], len(term)))
    stems: list[str] = []
    for term in sorted((t for t, stem in good if stem and kinds[t] >= MIN_ENDINGS), key=lambda t: (len(t), t)):
        if not any(term.startswith(s) for s in stems):
            stems.append(term)
    words = [t for t, stem in good if not stem and not any(t.startswith(s) for s in stems)]
    ranked = sorted([(t, True) for t in stems] + [(t, False) for t in words],
                    key=lambda k: (-in_toxic.get(k, 0), k))
    terms = [(t, stem, edits_allowed(len(t))) for t, stem in ranked]
    clean = sample.where("toxic = 0")
    stray = {r["k"] for r in _strays(clean, terms).where(F.col("n") > MAX_STRAY * n_clean).collect()}
    return [(t, stem, 0 if k in stray else most) for k, (t, stem, most) in enumerate(terms)]


def _strays(clean: DataFrame, terms: list[Term]) -> DataFrame:
    """``k, n``: in how many clean texts a misspelling of term k occurs."""
    def run(batches):
        matcher = Matcher(terms)
        known: dict[str, set[int]] = {}
        for batch in batches:
            n: Counter = Counter()
            for t in batch.column(0):
                found: set[int] = set()
                for w in {plain(x) for x in (t.as_py() or "").split()}:
                    if w not in known:
                        if len(known) > 1_000_000:
                            known.clear()
                        known[w] = matcher.misspelled(w)
                    found |= known[w]
                n.update(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(n), pa.int64()), pa.array(list(n.values()), pa.int64())], ["k", "n"])

    return clean.select("text").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))


class Model:
    def __init__(self, terms: list[Term], weights: np.ndarray, bias: float):
        self.terms, self.weights, self.bias = terms, weights, bias


def train(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps with a small ridge."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (p - y) + 0.1 * w
        hess = (a * (p * (1 - p))[:, None]).T @ a + 0.1 * np.eye(a.shape[1])
        w -= np.linalg.solve(hess, grad)
    return w[:-1], float(w[-1])


def extract(docs: DataFrame, terms: list[Term], out: Callable[[np.ndarray], pa.Array],
            name: str, kind: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, the columns ``keep`` and ``out(features)`` of every row of ``docs`` (doc_id, text)."""
    id_kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        hits = Hits(terms)                       # one automaton per task, grown as words come
        for batch in batches:
            if batch.num_rows:
                x = np.array([hits.features(t.as_py()) for t in batch.column(1)])
                yield pa.RecordBatch.from_arrays([batch.column(0), *batch.columns[2:], out(x)], ["doc_id", *keep, name])

    kept = "".join(f"{c} {docs.schema[c].dataType.simpleString()}, " for c in keep)
    return docs.select("doc_id", "text", *keep).mapInArrow(run, f"doc_id {id_kind}, {kept}{name} {kind}")


def fit(docs: DataFrame, labels: DataFrame, usable: Column, max_rows: int = MAX_ROWS) -> Model:
    """Learn terms and weights from the labels of the rows that are ``usable``."""
    known = labels.where(usable & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").alias("toxic"))
    n_all, n_tox = known.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    if not n_tox or n_tox == n_all:
        return Model([], np.zeros(8), -30.0 if not n_tox else 30.0)
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("toxicity")), F.lit(1_000_000)) / F.lit(1_000_000.0)
    limit = F.when(F.col("toxic") == 1, F.lit(max_rows / n_tox)).otherwise(F.lit(max_rows / (n_all - n_tox)))
    drawn = known.where(draw < limit)
    # the drawn ids are bounded by max_rows: the texts stay where they are, and are read out once
    drawn = materialize(drawn, "drawn")
    found = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    sample = materialize(found.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")), "labelled")
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return Model([], np.zeros(8), -30.0 if 1 not in sizes else 30.0)
    terms = learn_terms(sample, sizes.get(1, 0), sizes.get(0, 0))
    got = extract(sample, terms, lambda x: pa.array(x.tolist(), pa.list_(pa.float64())), "x", "array<double>", ("toxic",))
    rows = got.select("x", "toxic").collect()                                        # bounded by max_rows
    x, y = np.array([r["x"] for r in rows]), np.array([r["toxic"] for r in rows], float)
    weights, bias = train(x, y)
    return Model(terms, weights, bias)


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row of ``docs``."""
    weights, bias = model.weights, model.bias

    def score(x: np.ndarray) -> pa.Array:
        return pa.array(1 / (1 + np.exp(-np.clip(x @ weights + bias, -30, 30))), pa.float64())

    return extract(docs, model.terms, score, "score", "double")


def held_out() -> Column:
    return id_split("doc_id", 5, 0)


def query(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The result of the contract."""
    out = classify(docs, fit(docs, labels, ~held_out()))
    return out.select("doc_id", held_out().alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
