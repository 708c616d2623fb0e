"""Operator 2, benchmark decontamination: a generalised suffix automaton.

The normalised words of the benchmark items are put into one suffix
automaton (per block of items).  Training words stream through it; the
length of the longest item passage that ends at each word is tracked, and a
word is hit when it lies in an occurrence of a window: ``window``
consecutive item words, or the whole of a shorter item.  Hit runs longer
than ``max_span`` words are removed, and a document whose share of hit
words exceeds ``max_coverage`` goes.

The automaton is broadcast, so the benchmark's size is counted first.  A
benchmark of more than ``block_words`` words is dealt into blocks; each block
is a pass of its own over the documents, which adds its hits to those found
before, so a task holds one block's automaton at a time.

Defined cases: null, empty and wordless texts have no words and no hits;
an item without words has no window; repeated items hit alike; repeated
rows of ``docs`` are each decided by themselves; very long texts are read
whole; where matches tie, all of them count; empty tables give empty
results; clashing extra columns are neither read nor renamed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bellwether.llm.common import fresh_name, map_rows, materialize
from bellwether.llm.text import WORD_PATTERN, WORD_TABLE, words

WINDOW = 10
BLOCK_WORDS = 2_000_000
MAX_COVERAGE = 0.5
_WORD = re.compile(WORD_PATTERN.replace("A-Z", ""))


def build_automaton(items: list[tuple[str, str | None]], window: int) -> dict:
    """Suffix automaton of all items' words, with the items of each window.

    ``next``: transitions; ``link`` and ``length`` as usual; ``full[s]``: the
    state that holds the last ``window`` words of state s, or -1;
    ``items[full[s]]``: the items with that window; ``short[s]``: the shorter
    items that end state s, as (length, item).
    """
    vocab: dict[bytes, int] = {}
    seqs = [[vocab.setdefault(w, len(vocab)) for w in words(t)] for _, t in items]
    nxt: list[dict[int, int]] = [{}]
    link, length = [-1], [0]

    def add_state(trans: dict[int, int], ln: int, lk: int) -> int:
        nxt.append(trans)
        length.append(ln)
        link.append(lk)
        return len(nxt) - 1

    def split(p: int, c: int, q: int) -> int:
        clone = add_state(dict(nxt[q]), length[p] + 1, link[q])
        link[q] = clone
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = clone
            p = link[p]
        return clone

    for seq in seqs:
        last = 0
        for c in seq:
            q = nxt[last].get(c)
            if q is not None:                       # the passage is there already
                last = q if length[q] == length[last] + 1 else split(last, c, q)
                continue
            cur, p = add_state({}, length[last] + 1, 0), last
            while p != -1 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p != -1:
                q = nxt[p][c]
                link[cur] = q if length[q] == length[p] + 1 else split(p, c, q)
            last = cur

    by_length = sorted(range(len(nxt)), key=length.__getitem__)
    full = [-1] * len(nxt)
    for s in by_length:
        if length[s] >= window:
            full[s] = s if length[link[s]] < window else full[link[s]]
    found: dict[int, set[int]] = {}
    short_here: dict[int, set[tuple[int, int]]] = {}
    for k, seq in enumerate(seqs):
        s = 0
        for i, c in enumerate(seq):
            s = nxt[s][c]
            if i + 1 >= window:
                found.setdefault(full[s], set()).add(k)
        if 0 < len(seq) < window:
            while length[link[s]] >= len(seq):
                s = link[s]
            short_here.setdefault(s, set()).add((len(seq), k))
    short: list[tuple[tuple[int, int], ...]] = [()] * len(nxt)
    for s in by_length[1:]:
        short[s] = (*sorted(short_here.get(s, ())), *short[link[s]])
    return {"vocab": vocab, "next": nxt, "link": link, "length": length, "full": full, "short": short,
            "items": {s: sorted(v) for s, v in found.items()}, "ids": [i for i, _ in items],
            "window": window, "least": min((min(len(q), window) for q in seqs if q), default=0)}


def scan(auto: dict, ws: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
    """Hit runs (start, end) of a document's words, merged, and the items hit."""
    if not ws or not auto["least"]:
        return [], set()
    get, nxt, link, length = auto["vocab"].get, auto["next"], auto["link"], auto["length"]
    full, short, items, window, least = auto["full"], auto["short"], auto["items"], auto["window"], auto["least"]
    codes = [get(w, -1) for w in ws]
    runs: list[tuple[int, int]] = []
    hit: set[int] = set()

    def mark(start: int, end: int) -> None:
        while runs and runs[-1][1] >= start:
            start = min(start, runs.pop()[0])
        runs.append((start, end))

    n, i = len(codes), 0
    while i < n:
        if codes[i] < 0:
            i += 1
            continue
        j = i
        while j < n and codes[j] >= 0:
            j += 1
        if j - i >= least:                           # an unknown word ends every match
            state = matched = 0
            for k in range(i, j):
                c = codes[k]
                while state and c not in nxt[state]:
                    state = link[state]
                    matched = length[state]
                if c in nxt[state]:
                    state = nxt[state][c]
                    matched += 1
                if matched >= window:
                    mark(k + 1 - window, k + 1)
                    hit.update(items[full[state]])
                for size, item in short[state]:
                    if size <= matched:
                        mark(k + 1 - size, k + 1)
                        hit.add(item)
        i = j
    return runs, hit


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[str, str | None]]]:
    """Items in blocks of at most about ``block_words`` words, by a size measured first."""
    size = F.size(F.split(F.coalesce(F.col("text"), F.lit("")), "[^0-9A-Za-z\\x80-\\x{10FFFF}]+"))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    total = items.agg(F.sum(size)).first()[0] or 0
    n = int(total // block_words) + 1
    if n == 1:
        yield [(r[0], r[1]) for r in items.collect()]
        return
    dealt = items.withColumn("__b", F.pmod(F.xxhash64("item_id", "text"), F.lit(2 * n)))
    for b in range(2 * n):
        yield [(r[0], r[1]) for r in dealt.where(F.col("__b") == b).select("item_id", "text").collect()]


HIT_FIELDS = {"n_words": T.LongType(), "starts": T.ArrayType(T.IntegerType()),
              "ends": T.ArrayType(T.IntegerType()), "items": T.ArrayType(T.StringType())}


def with_hits(docs: DataFrame, benchmark: DataFrame, names: list[str], window: int = WINDOW,
              block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with its words, hit runs and hit items, in new columns called ``names``."""
    width, at = len(docs.columns), docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, *map(T.StructField, names, HIT_FIELDS.values())])

    def scanner(auto, first: bool):
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            n_words, starts, ends, items = [], [], [], []
            for row, text in enumerate(batch.column(at)):
                ws = words(text.as_py())
                runs, hit = scan(auto.value, ws)
                ids = {auto.value["ids"][k] for k in hit} - {None}
                if not first:
                    old = [batch.column(width + k)[row].as_py() for k in (1, 2, 3)]
                    runs += list(zip(old[0], old[1]))
                    ids |= set(old[2])
                runs = merge_runs(runs)
                n_words.append(len(ws))
                starts.append([r[0] for r in runs])
                ends.append([r[1] for r in runs])
                items.append(sorted(ids))
            return pa.RecordBatch.from_arrays(
                [*batch.columns[:width], pa.array(n_words, pa.int64()), pa.array(starts, pa.list_(pa.int32())),
                 pa.array(ends, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
                [*batch.schema.names[:width], *names])
        return run

    found = docs
    for k, block in enumerate(_blocks(benchmark, block_words)):
        if k:
            found = materialize(found, "hits")
        auto = docs.sparkSession.sparkContext.broadcast(build_automaton(block, window))
        found = map_rows(found, scanner(auto, k == 0), schema)
    return found


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
              block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): ``doc_id, n_words, starts, ends, items``."""
    found = with_hits(docs.select("doc_id", "text"), benchmark, list(HIT_FIELDS), window, block_words)
    return found.drop("text")


def merge_runs(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def word_spans(text: str) -> list[tuple[int, int]]:
    """Character spans of the words of ``words(text)``."""
    return [m.span() for m in _WORD.finditer(lower_ascii(text))]


def lower_ascii(text: str) -> str:
    return text.translate({c: c + 32 for c in range(0x41, 0x5B)})


def cut(text: str, runs: list[tuple[int, int]]) -> str:
    """The text without the words of ``runs`` and what stands between them."""
    spans, out, at = word_spans(text), [], 0
    for start, end in runs:
        out.append(text[at:spans[start][0]])
        at = spans[end - 1][1]
    return "".join(out) + text[at:]


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_span: int = 0,
                 max_coverage: float = MAX_COVERAGE) -> DataFrame:
    """``docs`` without benchmark passages: the decisions take effect.

    A document of which more than ``max_coverage`` of the words are hit is
    dropped; of the others, hit runs longer than ``max_span`` words are cut
    out and ``n_chars`` (if there is such a column) is counted again.
    """
    names = docs.columns
    extra = [fresh_name(docs, f) for f in HIT_FIELDS]
    found = with_hits(docs, benchmark, extra, window)
    at, width = names.index("text"), len(names)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep, texts, cut_here = [], [], []
        n_words, starts, ends = (batch.column(width + k).to_pylist() for k in range(3))
        for x, n, a, b in zip(batch.column(at), n_words, starts, ends):
            runs = list(zip(a, b))
            keep.append(sum(e - s for s, e in runs) <= max_coverage * n)
            long = [r for r in runs if r[1] - r[0] > max_span]
            texts.append(cut(x.as_py(), long) if long else x.as_py())
            cut_here.append(bool(long))
        cols = batch.columns[:width]
        cols[at] = pa.array(texts, batch.schema.field(at).type)
        if "n_chars" in names:
            k = names.index("n_chars")
            cols[k] = pa.array([len(t) if c else v.as_py() for t, c, v in zip(texts, cut_here, cols[k])],
                               batch.schema.field(k).type)
        return pa.RecordBatch.from_arrays(cols, names).filter(pa.array(keep))

    return map_rows(found, run, docs.schema)


def query(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The result of the contract, with the hit runs as extra columns."""
    found = find_hits(docs, benchmark)
    n_hit = F.aggregate(F.zip_with("ends", "starts", lambda e, s: (e - s).cast("long")),
                        F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))
