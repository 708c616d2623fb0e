"""Operator 6, language-model scoring: Katz backoff of order two.

P(w | h) = d(c) c(h, w) / c(h) for pairs that the training texts have, else
a(h) P(w); P(w) = d(c) c(w) / N for known words, and the mass that is left
for unknown ones.  The discounts d are Good-Turing's for counts up to 5; a
larger count loses half a count, so that every history keeps some mass.  The
backoff weight a(h) is exactly what makes the probabilities of all words
after h sum to one: (what the discounts left) / (1 - P of the words seen).

The model is gathered from all training texts and kept in tables that are
partitioned by hash: words (hash, count), pairs met as *postings* (history,
word, text, count) in buckets, and histories with their backoff weight.
Nothing that grows with the texts is broadcast or collected; only the
``HEAD_WORDS`` most frequent words are, whose number is bounded.

How a text's score gets to it, per token and recursively:

* Postings are packed by block of texts and bucket.  A posting whose word is
  frequent goes to its history's bucket (histories that make more than
  ``HOT_SHARE`` of the tokens are spread over the buckets by the word),
  every other posting to its word's bucket.  So a bucket has all postings of
  its pairs, and the count of each word: from the frequent words, or by its
  own sum.  Where c(h, w) > 0 the text gets log c(h, w), else log P(w) and a
  request for a(h).
* Buckets return sums per text, the discounted mass of each history, and the
  requests.  Requests for frequent histories are answered from a broadcast,
  the others in the history's bucket.
* The discounts of pairs need the counts of all buckets.  They enter at the
  end: a text carries how many of its tokens have a pair of count 1 to 5.

Defined cases: null text is an empty text, which has one token, its end;
without training texts the base is that of the empty table and the score
log10 1 for each token; rows are scored one by one, whatever their ids, so
repeated rows and null ids do no harm; very long texts are scored whole;
words of equal count are frequent together or not at all; other columns are
ignored; an empty table gives an empty result.  The input must give the same
rows in the same order when it is read again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bellwether.llm.common import id_split, materialize
from bellwether.llm.text import HashCache, tokens
from bellwether.session import checkpoint_root, scratch_path

HEAD_WORDS = 400_000
HOT_SHARE = 1e-3
BLOCK_TOKENS = 500_000
BUCKET_POSTINGS = 1_500_000
KATZ = 5                     # counts up to this get a Good-Turing discount
LARGE = 0.5                  # what a larger count loses
END_TEXT = b" end"           # no token has a space
START = np.uint64(1 << 32)   # code of the history before the first word
_TAIL = np.uint64(1 << 63)   # codes of words that are not frequent have this bit
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(32))) * _A
        x = (x ^ (x >> np.uint64(29))) * _B
        return x ^ (x >> np.uint64(32))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string, each by its byte planes."""
    raw = b"".join(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() for a in arrays)
    head = np.array([len(raw), len(arrays), *(len(a) for a in arrays)], np.int64).tobytes()
    kinds = "".join(a.dtype.str.ljust(4) for a in arrays).encode()
    return head + kinds + pa.Codec("zstd").compress(raw, asbytes=True)


def unpack(blob: bytes) -> list[np.ndarray]:
    size, k = np.frombuffer(blob, np.int64, 2)
    lengths = np.frombuffer(blob, np.int64, k, 16)
    at = 16 + 8 * int(k)
    kinds = [np.dtype(blob[at + 4 * i: at + 4 * i + 4].decode().strip()) for i in range(k)]
    raw = np.frombuffer(pa.Codec("zstd").decompress(blob[at + 4 * int(k):], int(size)), np.uint8)
    out, at = [], 0
    for n, kind in zip(lengths.tolist(), kinds):
        planes = raw[at: at + n * kind.itemsize].reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(n))
        at += n * kind.itemsize
    return out


def good_turing(n: list[int]) -> list[float]:
    """Discounts of the counts 1..KATZ, from ``n[r]``, the numbers of kinds seen r times (to KATZ + 1).

    Where the estimate is not between 0 and 1, the count loses ``LARGE``.
    """
    out = [1.0]
    rest = (KATZ + 1) * n[KATZ + 1] / n[1] if n[1] else 1.0
    for r in range(1, KATZ + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - rest) / (1 - rest) if n[r] and rest < 1 else 0.0
        out.append(d if 0 < d < 1 else (r - LARGE) / r)
    return out


@dataclass
class Words:
    """What tasks know of the words: totals, discounts and the frequent words."""

    total: int                # training tokens
    kinds: int                # distinct ones
    texts: int                # training texts
    discount: list[float]
    unknown: float            # probability of any word that training texts lack
    hashes: np.ndarray        # of the frequent words, sorted
    counts: np.ndarray
    end: int                  # the code of the end token

    def probability(self, count: np.ndarray) -> np.ndarray:
        small = np.array(self.discount) * np.arange(KATZ + 1)
        kept = np.where(count <= KATZ, small[np.minimum(count, KATZ)], count - LARGE)
        return np.where(count > 0, kept / max(self.total, 1), self.unknown)


def _blocks(batch: pa.RecordBatch, at: int, size: int) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Tokens of the texts of a batch, in blocks of about ``size``, each with the row it begins at."""
    first, held, n = 0, [], 0
    for row, text in enumerate(batch.column(at)):
        ws = tokens(text.as_py())
        if held and n + len(ws) >= size:
            yield first, held
            first, held, n = row, [], 0
        held.append(ws)
        n += len(ws) + 1
    if held:
        yield first, held


def _hash_all(texts: list[list[bytes]], cache: HashCache) -> np.ndarray:
    n = sum(map(len, texts))
    return np.fromiter((cache[w] for ws in texts for w in ws), np.uint64, n)


def word_counts(train: DataFrame, flush: int = 1_000_000, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``h, c``: hash and count of every token of ``train`` (text), ends included."""
    end = HashCache()[END_TEXT]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = HashCache()
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            h, inv = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
            return h, np.bincount(inv, np.concatenate([x[1] for x in held])).astype(np.int64)

        def out(h: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], ["h", "c"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append((np.array([end], np.uint64), np.array([batch.num_rows])))
            for _, texts in _blocks(batch, 0, block_tokens):
                held.append(np.unique(_hash_all(texts, cache), return_counts=True))
            if sum(len(x[0]) for x in held) > flush:
                h, c = merged()
                held = [(h, c)]
                if len(h) > flush // 2:
                    yield out(h, c)
                    held = []
        if held:
            yield out(*merged())

    return train.select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def word_model(train: DataFrame, head_words: int = HEAD_WORDS) -> tuple[Words, DataFrame]:
    """Count the words; return what tasks need, and the table of all words."""
    table = materialize(word_counts(train), "lm-words")
    # the sizes of the counts: about the square root of the tokens at most
    sizes = {r["c"]: r["n"] for r in table.groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
    total, kinds = sum(c * n for c, n in sizes.items()), sum(sizes.values())
    n_r = [0] + [sizes.get(r, 0) for r in range(1, KATZ + 2)]
    discount = good_turing(n_r)
    left = sum((1 - discount[r]) * r * n_r[r] for r in range(1, KATZ + 1))
    left += LARGE * sum(n for c, n in sizes.items() if c > KATZ)
    least, taken = 1, 0
    for c in sorted(sizes, reverse=True):
        if taken + sizes[c] > head_words:
            least = c + 1
            break
        taken += sizes[c]
    end = HashCache()[END_TEXT]
    head = table.where(F.col("c") >= least).toPandas()            # at most head_words rows
    known = dict(zip(head["h"].to_numpy().view(np.uint64).tolist(), head["c"].tolist()))
    if end not in known:
        row = table.where(F.col("h") == F.lit(int(np.array([end], np.uint64).view(np.int64)[0]))).first()
        known[end] = row["c"] if row else 0
    hashes = np.array(sorted(known), np.uint64)
    counts = np.array([known[h] for h in hashes.tolist()], np.int64)
    return Words(total, kinds, int(known[end]), discount, left / total if total else 1.0, hashes, counts,
                 int(np.searchsorted(hashes, np.uint64(end)))), table


ROW = "kind string, key long, blob binary, t array<long>"


def _rows(rows: list[tuple[str, int, bytes, list[int] | None]]) -> dict:
    return {"kind": pa.array([r[0] for r in rows], pa.string()), "key": pa.array([r[1] for r in rows], pa.int64()),
            "blob": pa.array([r[2] for r in rows], pa.binary()), "t": pa.array([r[3] for r in rows], pa.list_(pa.int64()))}


def postings(docs: DataFrame, w: Words, buckets: int, hot_share: float, block_tokens: int) -> DataFrame:
    """Packed postings (kind p, key: bucket) and the texts' own sums (kind m), of ``doc_id, held, text``."""
    log_count = np.log10(np.maximum(w.counts, 1))
    hot = w.counts >= max(hot_share * w.total, 1)

    def block(batch: pa.RecordBatch, first: int, texts: list[list[bytes]], number: int, cache: HashCache) -> list:
        n = len(texts)
        hashes = _hash_all(texts, cache)
        distinct, inv = np.unique(hashes, return_inverse=True)
        at = np.minimum(np.searchsorted(w.hashes, distinct), len(w.hashes) - 1)
        code = np.where(w.hashes[at] == distinct, at.astype(np.uint64), distinct | _TAIL)
        lengths = np.fromiter(map(len, texts), np.int64, n)
        ends = np.cumsum(lengths + 1) - 1
        size = int(ends[-1]) + 1
        is_end = np.zeros(size, bool)
        is_end[ends] = True
        word = np.full(size, np.uint64(w.end))
        word[~is_end] = code[inv]
        history = np.empty(size, np.uint64)
        history[1:] = word[:-1]
        history[0] = START
        history[ends[:-1] + 1] = START
        doc = np.repeat(np.arange(n), lengths + 1)
        held = np.array(batch.column(1).slice(first, n).to_pylist(), bool)
        ids = batch.column(0).slice(first, n)
        # sums over frequent words, whose counts are known here
        frequent = word < _TAIL
        k = word[frequent].astype(np.int64)
        d = doc[frequent]
        seen = w.counts[k] > 0
        n_known = np.bincount(d, seen, n).astype(np.int64)
        base = np.bincount(d, np.log10(w.counts[k] + 1.0), n)
        own = np.bincount(d, -log_count[k] * (k != w.end), n) - np.log10(max(w.texts, 1))
        rows = [("m", number, pack(ids.fill_null(0).to_numpy(), np.array([x.is_valid for x in ids], np.uint8),
                                   held.view(np.uint8), lengths + 1, n_known, base, own), None)]
        # postings: history, word and text in one number, sorted and counted
        codes = np.unique(np.concatenate([code, np.array([START, w.end], np.uint64)]))
        bits = np.uint64(int(len(codes)).bit_length())
        doc_bits = np.uint64(int(n).bit_length())
        key = (np.searchsorted(codes, history).astype(np.uint64) << (bits + doc_bits)) \
            | (np.searchsorted(codes, word).astype(np.uint64) << doc_bits) | doc.astype(np.uint64)
        key.sort()
        new = np.concatenate(([True], key[1:] != key[:-1]))
        start = np.flatnonzero(new)
        times = np.diff(np.append(start, size)).astype(np.uint32)
        key = key[start]
        text = (key & ((np.uint64(1) << doc_bits) - np.uint64(1))).astype(np.uint32)
        word = codes[((key >> doc_bits) & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)]
        history = codes[(key >> (bits + doc_bits)).astype(np.int64)]
        by_word = word >= _TAIL
        spread = (history == START) | ((history < START) & hot[np.minimum(history, len(hot) - 1).astype(np.int64)])
        with np.errstate(over="ignore"):
            bucket = mix(np.where(by_word, word, np.where(spread, history * _A + word, history))) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
        train = (~held).view(np.uint8)
        for b in range(buckets):
            o = order[bounds[b]: bounds[b + 1]]
            if len(o):
                rows.append(("p", b, pack(np.array([number]), train, np.diff(history[o], prepend=np.uint64(0)),
                                          word[o], text[o], times[o]), None))
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, number = HashCache(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for first, texts in _blocks(batch, 2, block_tokens):
                yield pa.RecordBatch.from_pydict(_rows(block(batch, first, texts, number, cache)))
                number += 1

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held", "text").mapInArrow(run, ROW)


def _by(values: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Indexes of the values 0..n-1 that occur, in order."""
    order = np.argsort(values, kind="stable")
    bounds = np.searchsorted(values[order], np.arange(n + 1))
    for v in range(n):
        if bounds[v] < bounds[v + 1]:
            yield v, order[bounds[v]: bounds[v + 1]]


def sums(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sum of ``values`` by index, as floats (also of none)."""
    return np.bincount(index, values, n).astype(np.float64)


def count_bucket(w: Words, buckets: int):
    """Group function of a bucket: kinds d (sums per block of texts), c (histories), u and h (requests), t."""
    def run(table: pa.Table) -> pa.Table:
        blocks = [unpack(b.as_py()) for b in table.column("blob")]
        offsets = np.concatenate(([0], np.cumsum([len(b[1]) for b in blocks])))
        history = np.concatenate([np.cumsum(b[2], dtype=np.uint64) for b in blocks])
        word = np.concatenate([b[3] for b in blocks])
        text = np.concatenate([b[4].astype(np.int64) + o for b, o in zip(blocks, offsets)])
        times = np.concatenate([b[5] for b in blocks]).astype(np.int64)
        train = np.concatenate([b[1] for b in blocks]).astype(bool)
        numbers = [int(b[0][0]) for b in blocks]
        del blocks                               # a bucket's arrays are what a task's memory goes to
        trained = np.where(train[text], times, 0)
        n_texts = int(offsets[-1])

        # counts of words: known for frequent ones, the bucket's own sum for the others
        tail = word >= _TAIL
        count = np.zeros(len(word), np.int64)
        count[~tail] = w.counts[word[~tail].astype(np.int64)]
        _, inv = np.unique(word[tail], return_inverse=True)
        count[tail] = np.bincount(inv, trained[tail])[inv] if len(inv) else 0
        p = w.probability(count)
        own_text, own_n, own_c = text[tail], times[tail], count[tail]
        n_known = sums(own_text, own_n * (own_c > 0), n_texts).astype(np.int64)
        base = sums(own_text, own_n * np.log10(own_c + 1.0), n_texts)
        own = sums(own_text, -own_n * np.log10(np.maximum(own_c, 1)), n_texts)

        # counts of pairs
        with np.errstate(over="ignore"):
            pair = mix(history * _A + word)
        order = np.argsort(pair, kind="stable")
        start = np.flatnonzero(np.concatenate(([True], pair[order][1:] != pair[order][:-1])))
        of_pair = np.add.reduceat(trained[order], start)
        del pair
        both = np.empty(len(word), np.int64)
        both[order] = np.repeat(of_pair, np.diff(np.append(start, len(order))))
        seen, large = both > 0, both > KATZ
        own += sums(text[large], times[large] * np.log10(both[large] - LARGE), n_texts)
        own += sums(text[~seen], times[~seen] * np.log10(p[~seen]), n_texts)
        small = [sums(text[both == r], times[both == r], n_texts).astype(np.uint32) for r in range(1, KATZ + 1)]

        rows: list[tuple] = []
        for k, number in enumerate(numbers):
            part = slice(int(offsets[k]), int(offsets[k + 1]))
            rows.append(("d", number, pack(n_known[part], base[part], own[part], *(s[part] for s in small)), None))

        # discounted mass of histories, from one posting of each pair that training texts have
        first = order[start][of_pair > 0]
        h, inv = np.unique(history[first], return_inverse=True)
        kind = np.minimum(of_pair[of_pair > 0], KATZ + 1)
        mass = np.bincount(inv, p[first], len(h)) if len(h) else np.zeros(0)
        counts = [np.bincount(inv[kind == r], minlength=len(h)).astype(np.uint32) for r in range(1, KATZ + 2)]
        place = (mix(h) % np.uint64(buckets)).astype(np.int64)
        for b, o in _by(place, buckets):
            rows.append(("c", b, pack(np.diff(h[o], prepend=np.uint64(0)), mass[o], *(c[o] for c in counts)), None))
        rows.append(("t", 0, b"", [int((of_pair == r).sum()) for r in range(1, KATZ + 2)]))

        # requests for backoff weights
        block_of = np.searchsorted(offsets, text[~seen], side="right") - 1
        ask_h, ask_n = history[~seen], times[~seen].astype(np.uint32)
        ask_text = (text[~seen] - offsets[block_of]).astype(np.uint32)
        ask_block = np.array(numbers, np.int64)[block_of]
        place = np.where(ask_h >= _TAIL, (mix(ask_h) % np.uint64(buckets)).astype(np.int64), buckets)
        for b, o in _by(place, buckets + 1):
            o = o[np.argsort(ask_h[o], kind="stable")]
            rows.append(("u" if b < buckets else "h", b, pack(
                np.diff(ask_h[o], prepend=np.uint64(0)), ask_block[o], ask_text[o], ask_n[o]), None))
        return pa.table(_rows(rows))
    return run


def _answers(blobs: list[bytes], h: np.ndarray, weight: np.ndarray) -> Iterator[tuple[str, int, bytes, None]]:
    """Kind a: log backoff weights that requests get, summed per text, by block of texts."""
    for blob in blobs:
        ask, block, text, times = unpack(blob)
        ask = np.cumsum(ask, dtype=np.uint64)
        at = np.minimum(np.searchsorted(h, ask), max(len(h) - 1, 0))
        known = h[at] == ask if len(h) else np.zeros(len(ask), bool)
        if not known.any():
            continue
        value = times[known] * weight[at[known]]
        block, text = block[known], text[known]
        numbers, inv = np.unique(block, return_inverse=True)
        for b, o in _by(inv, len(numbers)):
            t, k = np.unique(text[o], return_inverse=True)
            yield "a", int(numbers[b]), pack(t, np.bincount(k, value[o])), None


def backoff_bucket(discount: list[float]):
    """Group function of a bucket of histories: kinds w (backoff weights), v (of frequent ones) and a."""
    def run(table: pa.Table) -> pa.Table:
        kinds, blobs = table.column("kind").to_pylist(), table.column("blob").to_pylist()
        parts = [unpack(b) for k, b in zip(kinds, blobs) if k == "c"]
        rows: list[tuple] = []
        if parts:
            h, inv = np.unique(np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts]), return_inverse=True)
            seen = np.bincount(inv, np.concatenate([p[1] for p in parts]))
            left = LARGE * np.bincount(inv, np.concatenate([p[1 + KATZ + 1] for p in parts]))
            for r in range(1, KATZ + 1):
                left += (1 - discount[r]) * r * np.bincount(inv, np.concatenate([p[1 + r] for p in parts]))
            weight = np.log10(left / np.maximum(1.0 - seen, 1e-300))     # times the history's count
            rows.append(("w", 0, pack(h, weight), None))
            often = h < _TAIL
            if often.any():
                rows.append(("v", 0, pack(h[often], weight[often]), None))
            rows += _answers([b for k, b in zip(kinds, blobs) if k == "u"], h, weight)
        return pa.table(_rows(rows))
    return run


def finish(w: Words, discount: list[float]):
    """Group function of a block of texts: its rows of the result."""
    log_small = [np.log10(discount[r] * r) for r in range(1, KATZ + 1)]

    def run(table: pa.Table) -> pa.Table:
        kinds, blobs = table.column("kind").to_pylist(), table.column("blob").to_pylist()
        ids, valid, held, n_tokens, n_known, base, own = unpack(blobs[kinds.index("m")])
        score = own.copy()
        for kind, blob in zip(kinds, blobs):
            if kind == "d":
                more_known, more_base, more, *small = unpack(blob)
                n_known, base, score = n_known + more_known, base + more_base, score + more
                for r, s in enumerate(small):
                    score = score + s * log_small[r]
            elif kind == "a":
                text, value = unpack(blob)
                score[text] += value
        base = base - n_tokens * np.log10(w.total + w.kinds + 1)
        return pa.table({
            "doc_id": pa.array(ids, mask=valid == 0), "held_out": pa.array(held.astype(bool)),
            "n_tokens": pa.array(n_tokens), "n_known": pa.array(n_known),
            "train_tokens": pa.array(np.full(len(ids), w.total)), "base_score": pa.array(base),
            "score": pa.array(score)})
    return run


RESULT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")


def _kept(df: DataFrame, name: str) -> DataFrame:
    """Write rows by kind to the shared folder; each reader then reads its kinds alone."""
    spark = df.sparkSession
    checkpoint_root(spark)
    path = scratch_path(spark, name)
    df.write.partitionBy("kind").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def score(docs: DataFrame, held: Column, head_words: int = HEAD_WORDS, hot_share: float = HOT_SHARE,
          block_tokens: int = BLOCK_TOKENS, bucket_postings: int = BUCKET_POSTINGS) -> DataFrame:
    """Train on the rows that are not ``held`` and score every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", held.alias("held"), "text")
    w, _ = word_model(rows.where(~F.col("held")), head_words)
    buckets = max(-(-w.total // bucket_postings), int(spark.conf.get("spark.sql.shuffle.partitions")))
    packed = postings(rows, w, buckets, hot_share, block_tokens)
    # the sums of frequent words ride along with the postings of some bucket
    by_bucket = packed.withColumn("at", F.when(F.col("kind") == "p", F.col("key")).otherwise(
        F.pmod(F.xxhash64("key"), F.lit(buckets))))
    count = count_bucket(w, buckets)

    def bucket(table: pa.Table) -> pa.Table:
        is_post = pa.array([k == "p" for k in table.column("kind").to_pylist()])
        own = table.select(["kind", "key", "blob", "t"])
        meta = own.filter(pa.array([not x.as_py() for x in is_post]))
        if meta.num_rows == own.num_rows:
            return meta
        return pa.concat_tables([meta, count(own.filter(is_post)).cast(meta.schema)])

    counted = _kept(by_bucket.groupBy("at").applyInArrow(bucket, ROW), "lm-buckets")
    sums = counted.where("kind = 't'").select(
        *(F.sum(F.get("t", F.lit(r))).alias(f"n{r}") for r in range(KATZ + 1))).first()
    discount = good_turing([0, *(int(x or 0) for x in sums)])
    backoff = _kept(counted.where("kind in ('c', 'u')").groupBy("key").applyInArrow(
        backoff_bucket(discount), ROW), "lm-backoff")
    # frequent histories: at most as many as frequent words, and the start
    often = [unpack(r["blob"]) for r in backoff.where("kind = 'v'").select("blob").toLocalIterator()]
    h = np.concatenate([x[0] for x in often]) if often else np.zeros(0, np.uint64)
    order = np.argsort(h)
    h, weight = h[order], (np.concatenate([x[1] for x in often]) if often else np.zeros(0))[order]

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = list(_answers([b.as_py() for b in batch.column(0)], h, weight))
            if out:
                yield pa.RecordBatch.from_pydict(_rows(out))

    answered = counted.where("kind = 'h'").select("blob").mapInArrow(answer, ROW)
    parts = counted.where("kind in ('m', 'd')").unionByName(backoff.where("kind = 'a'")).unionByName(answered)
    return parts.groupBy("key").applyInArrow(finish(w, discount), RESULT)


def held_out() -> Column:
    return id_split("doc_id", 7, 2)


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The result of the contract."""
    return score(docs, held_out())
