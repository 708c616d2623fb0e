"""Operator 12, filter interaction audit: a table-driven byte transducer.

One pass over the UTF-8 bytes of a text drives a finite automaton by two
tables, ``NEXT`` (state and byte class to state) and ``ACTION`` (state and
byte class to what is emitted: word begins, word ends, code point, capital,
symbol).  The state after a byte depends on that byte's class alone, so a
block of bytes is stepped at once: the states are ``NEXT`` of the class one
byte before, and the actions one look-up.  Word spans go into an open-
addressing hash table; a span that meets one with its hash is compared byte
by byte (verified), so a collision of hashes never merges two words.

From the counts follow the filters A to D of every text; E (a repeat of a
text with a smaller id) follows from the least id of each text digest.  The
rows are then counted by part, failed filters and labels, which is all that
any order of the filters needs: what a prefix of an order keeps is the
number of rows that fail none of its filters.  Every row is shuffled as
counts only, and hot texts, ids and parts are counted before each shuffle.

Defined cases: null text is empty (no words: it fails A alone of A to D);
null lang is the part ``''``; a row with a null id neither fails E nor makes
others fail it; rows that repeat in id and text all pass or all fail; very
long texts are read in segments cut at white space; several labels of an id
count as 1 if any is 1; an empty table has no parts and an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bellwether.llm.common import materialize

FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT = 80             # percent of the words
MAX_CAPITALS = 10             # percent of the code points
SYMBOLS = b"#$%&*|"
SPACES = b" \t\n\v\f\r"
BLOCK_BYTES = 1 << 20

# classes of bytes, states and actions of the transducer
SPACE, CAPITAL, SYMBOL, PLAIN, INNER = range(5)        # INNER: a byte inside a UTF-8 sequence
BETWEEN, WORD = range(2)
BEGINS, ENDS, POINT, IS_CAPITAL, IS_SYMBOL = 1, 2, 4, 8, 16
CLASS = np.full(256, PLAIN, np.uint8)
CLASS[0x80:0xC0] = INNER
CLASS[ord("A"):ord("Z") + 1] = CAPITAL
CLASS[list(SYMBOLS)] = SYMBOL
CLASS[list(SPACES)] = SPACE
NEXT = np.array([[BETWEEN, WORD, WORD, WORD, WORD]] * 2, np.uint8)
_SAID = np.array([POINT, POINT | IS_CAPITAL, POINT | IS_SYMBOL, POINT, 0], np.uint8)
ACTION = np.stack([_SAID | np.array([0, BEGINS, BEGINS, BEGINS, BEGINS], np.uint8),
                   _SAID | np.array([ENDS, 0, 0, 0, 0], np.uint8)])

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class Powers:
    """Powers of the hash's base and of its inverse, modulo 2^64, for blocks of up to the longest length seen."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(n + 1, BLOCK_BYTES + 1)
            self.up, self.down = (np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(size - 1, base, np.uint64))))
                                  for base in (_BASE, _INVERSE))
        return self.up, self.down


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, powers: Powers) -> np.ndarray:
    """64-bit hashes of the byte spans, from one running sum over the block."""
    up, down = powers.upto(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    return _mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))


def equal_spans(data: np.ndarray, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Are the spans of ``n`` bytes at ``a`` and ``b`` the same, byte by byte?"""
    if not len(n):
        return np.zeros(0, bool)
    first = np.concatenate(([0], np.cumsum(n)[:-1]))
    step = np.arange(int(n.sum())) - np.repeat(first, n)
    same = data[np.repeat(a, n) + step] == data[np.repeat(b, n) + step]
    return np.logical_and.reduceat(same, first)


def first_of_kind(data: np.ndarray, owner: np.ndarray, begin: np.ndarray, end: np.ndarray,
                  hashes: np.ndarray) -> np.ndarray:
    """Is each span the one of its bytes that its owner (text) has in the table?

    All spans are inserted at once: a free slot goes to one of the spans that
    ask for it, a span that meets its like is a repeat, and every other one
    moves on to the next slot.
    """
    size = 1 << max(4, int(2 * len(begin)).bit_length())
    table = np.full(size, -1, np.int64)
    key = _mix(hashes + owner.astype(np.uint64) * np.uint64(_BASE))
    slot = (key & np.uint64(size - 1)).astype(np.int64)
    n = end - begin
    new = np.zeros(len(begin), bool)
    waiting = np.arange(len(begin))
    while len(waiting):
        at = slot[waiting]
        free = table[at] < 0
        table[at[free]] = waiting[free]
        held = table[at]
        mine = held == waiting
        new[waiting[mine]] = True
        rest, other = waiting[~mine], held[~mine]
        alike = (key[rest] == key[other]) & (owner[rest] == owner[other]) & (n[rest] == n[other])
        where = np.flatnonzero(alike)
        alike[where] = equal_spans(data, begin[rest[where]], begin[other[where]], n[rest[where]])
        waiting = rest[~alike]
        slot[waiting] = (slot[waiting] + 1) & (size - 1)
    return new


def transduce(data: np.ndarray, starts: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One pass over the texts that begin at ``starts`` (none empty): counts per text, and the spans of new words.

    The counts are columns: words, distinct words, capitals, code points, symbols.
    """
    kind = CLASS[data]
    state = np.empty(len(data), np.uint8)
    state[1:] = NEXT[0][kind[:-1]]                      # the rows of NEXT are equal: the state before plays no part
    state[starts] = BETWEEN
    said = ACTION[state, kind]
    begin = np.flatnonzero(said & BEGINS)
    # a word ends at the white space after it, or with its text
    last = np.concatenate((starts[1:], [len(data)]))
    end = np.sort(np.concatenate((np.flatnonzero(said & ENDS), last[NEXT[0][kind[last - 1]] == WORD])))
    owner = np.searchsorted(starts, begin, side="right") - 1
    with np.errstate(over="ignore"):
        new = first_of_kind(data, owner, begin, end, span_hashes(data, begin, end, powers))
    counts = [np.bincount(owner, minlength=len(starts)), np.bincount(owner[new], minlength=len(starts))]
    counts += [np.add.reduceat((said & bit > 0).astype(np.int64), starts) for bit in (IS_CAPITAL, POINT, IS_SYMBOL)]
    return np.stack(counts, axis=1), begin[new], end[new]


def _cut(data: np.ndarray) -> Iterator[np.ndarray]:
    """A very long text in segments of about ``BLOCK_BYTES``, cut after white space only."""
    at = 0
    while at < len(data):
        end = at + BLOCK_BYTES
        while end < len(data):
            gaps = np.flatnonzero(CLASS[data[end - 1:end - 1 + BLOCK_BYTES]] == SPACE)
            if len(gaps):
                end += int(gaps[0])
                break
            end += BLOCK_BYTES
        yield data[at:end]
        at = end


def count_texts(texts: pa.Array, powers: Powers) -> np.ndarray:
    """Words, distinct words, capitals, code points and symbols of every text (null is empty)."""
    col = texts.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    out = np.zeros((len(col), 5), np.int64)
    row = 0
    while row < len(col):
        upto = max(row + 1, int(np.searchsorted(ends, ends[row] + BLOCK_BYTES, side="right")) - 1)
        if ends[upto] - ends[row] > BLOCK_BYTES:                # one very long text
            kinds: set[bytes] = set()
            for part in _cut(data[ends[row]:ends[upto]]):
                counts, begin, end = transduce(part, np.zeros(1, np.int64), powers)
                out[row] += counts[0]
                held = part.tobytes()
                kinds.update(held[a:b] for a, b in zip(begin.tolist(), end.tolist()))
            out[row, 1] = len(kinds)
        else:
            some = row + np.flatnonzero(ends[row + 1:upto + 1] > ends[row:upto])
            if len(some):
                out[some] = transduce(data[ends[row]:ends[upto]], ends[some] - ends[row], powers)[0]
        row = upto
    return out


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id, part, digest, n_words, n_distinct, n_capitals, n_points, n_symbols`` of every row of ``docs``."""
    names = ["n_words", "n_distinct", "n_capitals", "n_points", "n_symbols"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            found = count_texts(batch.column(3), powers)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *[pa.array(found[:, k], pa.int64()) for k in range(5)]],
                ["doc_id", "part", "digest", *names])

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"),
                       F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, part string, digest binary, " + ", ".join(f"{n} long" for n in names))


def failures(measured: DataFrame) -> DataFrame:
    """Rows counted: ``doc_id, part, fails, n``; bit k of ``fails`` is set if the filter ``FILTERS[k]`` fails."""
    tests = [F.col("n_words") < MIN_WORDS,
             F.col("n_distinct") * 100 < F.col("n_words") * MIN_DISTINCT,
             F.col("n_capitals") * 100 > F.col("n_points") * MAX_CAPITALS,
             F.col("n_symbols") > 0]
    bits = sum((F.when(t, F.lit(1 << k)).otherwise(F.lit(0)) for k, t in enumerate(tests[1:], 1)),
               F.when(tests[0], F.lit(1)).otherwise(F.lit(0)))
    rows = materialize(measured.groupBy("digest", "doc_id", "part", bits.alias("bits")).agg(
        F.count(F.lit(1)).alias("n")), "audit-rows")
    first = rows.where(F.col("doc_id").isNotNull()).groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    marked = rows.join(first.withColumn("first", F.lit(True)), ["digest", "doc_id"], "left")
    repeat = F.col("doc_id").isNotNull() & F.col("first").isNull()
    fails = F.col("bits") + F.when(repeat, F.lit(16)).otherwise(F.lit(0))
    return marked.groupBy("doc_id", "part", fails.alias("fails")).agg(F.sum("n").alias("n"))


def tally(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, fails, n, good, toxic``: rows, and those of them labelled good or toxic."""
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    failed = materialize(failed, "audit-failed")
    marked = failed.where(F.col("doc_id").isNotNull()).join(known, "doc_id", "left")
    without = failed.where(F.col("doc_id").isNull()).select(
        "*", F.lit(False).alias("good"), F.lit(False).alias("toxic"))     # null ids are never shuffled as a key
    rows = marked.unionByName(without)
    return rows.groupBy("part", "fails").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"))


def orders(counts: DataFrame) -> DataFrame:
    """Every order and step of every part, from ``part, fails, n, good, toxic``."""
    free = F.explode(F.filter(F.sequence(F.lit(0), F.lit(31)), lambda s: s.bitwiseAND(F.col("fails")) == 0))
    kept = counts.withColumn("s", free).groupBy("part", "s").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    by = F.map_from_entries(F.collect_list(F.struct("s", F.struct("n", "good", "toxic"))))
    table = kept.groupBy("part").agg(by.alias("by"))            # at most 32 entries a part
    for c in ("n", "good", "toxic"):
        table = table.withColumn(c, F.expr(
            f"transform(sequence(0, 31), s -> CAST(coalesce(try_element_at(by, s).{c}, 0) AS BIGINT))"))

    steps = []
    for order in permutations(range(5)):
        done = 0
        for step, k in enumerate(order, 1):
            steps.append(f"('{''.join(FILTERS[j] for j in order)}', {step}, {1 << k}, {done})")
            done |= 1 << k
    plan = counts.sparkSession.sql(f"SELECT * FROM VALUES {', '.join(steps)} AS t(filter_order, step, f, done)")
    # a filter's removals over all orders: a set of others comes first in |set|! (4 - |set|)! of them
    weights = "array(" + ", ".join(f"{factorial(b := s.bit_count()) * factorial(max(4 - b, 0))}L" for s in range(32)) + ")"
    shapley = (f"aggregate(filter(sequence(0, 31), s -> s & f = 0), 0L, "
               f"(x, s) -> x + get({weights}, s) * (get(n, s) - get(n, s | f)))")
    rows = table.drop("by").crossJoin(F.broadcast(plan))         # 600 constant rows
    return rows.selectExpr(
        "part", "filter_order", "step", "get(n, done | f) AS kept", "get(n, done) - get(n, done | f) AS removed",
        "get(n, 0) - get(n, f) - (get(n, done) - get(n, done | f)) AS redundant",
        "get(n, 31 ^ f) - get(n, 31) AS unique_fails",
        "get(good, done) - get(good, done | f) AS good_lost", "get(toxic, done) - get(toxic, done | f) AS toxic_lost",
        f"{shapley} AS shapley")


def query(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The result of the contract."""
    return orders(tally(failures(measure(docs)), labels))
