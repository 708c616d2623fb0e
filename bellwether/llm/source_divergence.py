"""Operator 13, source divergence audit: single-pass in-memory indexing.

How far do the sources of a language differ in their use of words?

1. Blocks: a task reads its documents once and counts their terms in memory
   (occurrences and documents per language, source and term) until the block
   is full; then it spills the block as a term-sorted run and starts anew.
2. Merge: runs are dealt to hash shards of (language, source, term) and
   merged there in the order of a 64-bit hash of the key by Spark's external
   sort, a heap merge of sorted runs that spills to disk; one streaming pass
   adds up the entries that are now neighbours, and compares whole keys, so
   keys that share a hash stay apart.  What it holds does not grow with the
   shard.
3. Kept terms: those in ``min_docs`` documents of their language.  All
   arithmetic on shares is exact (integers, decimals).
4. Pairs: a source that never uses a term has the same small share for all
   such terms, so a pair of sources starts from that value times the number
   of kept terms.  Corrections follow: for the terms that one of the two
   uses from histograms of its shares, and for the terms that both use from
   a stream over the postings, which adds up sums per pair and hands on its
   partial sums when their table is full.  No pair is emitted per term.

A posting list has one entry per source of the language at most, which is
less than the square root of the rows that the pairs themselves are.

Defined cases: null text, lang and source are read as ``''``; a text without
terms still makes its (lang, source) occur; very long texts are counted in
segments cut between terms; a language without kept terms has the value 0
for every pair; ties in value are ranked by the item's UTF-8 bytes; repeated
rows are documents each; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bellwether.llm.common import lookup_join, materialize

#: Bytes of a term are ASCII letters and all bytes of non-ASCII characters; A-Z are lower-cased.
TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))
MIN_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
BLOCK_ENTRIES = 1_000_000     # terms of a block in memory
BLOCK_BYTES = 1 << 26         # bytes of the texts that a block has read, a bound on those of its terms
SPILL_ROWS = 20_000           # entries of a run that are handed on at once
MERGE_ROWS = 50_000           # entries that the merge adds up at once
SEGMENT = 1 << 20             # bytes of a text whose terms are held at once
PAIR_CHUNK = 1 << 20          # pairs worked on at once
PAIR_ENTRIES = 200_000        # sums per pair that a task holds
SALT = 64                     # parts that a language's sources are dealt into for joins within the language

RUN = "lang string, source string, term binary, n long, df long"


def terms(text: bytes) -> Counter:
    """The terms of a text with their counts."""
    if len(text) <= SEGMENT:
        return Counter(text.translate(TERM_BYTES).split())
    found: Counter = Counter()
    line = text.translate(TERM_BYTES)
    at = 0
    while at < len(line):
        end = len(line) if len(line) - at <= SEGMENT else line.rfind(b" ", at, at + SEGMENT) + 1
        if end <= at:                                  # one term longer than a segment
            end = line.find(b" ", at + SEGMENT) + 1 or len(line)
        found.update(line[at:end].split())
        at = end
    return found


class Block:
    """The postings of a block: per ``(lang, source)`` the occurrences and the documents of each term."""

    def __init__(self) -> None:
        self.groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        self.entries = self.bytes = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        n, df = self.groups.setdefault((lang, source), (Counter(), Counter()))
        before = len(n)
        if len(text) <= SEGMENT:
            found = text.translate(TERM_BYTES).split()
            n.update(found)
            df.update(set(found))
        else:
            whole = terms(text)
            n.update(whole)
            df.update(whole.keys())
        self.entries += len(n) - before
        self.bytes += len(text)

    def full(self) -> bool:
        return self.entries >= BLOCK_ENTRIES or self.bytes >= BLOCK_BYTES

    def run(self) -> Iterator[pa.RecordBatch]:
        """The block as a run, sorted by language, source and term."""
        held: list[pa.RecordBatch] = []
        for (lang, source), (n, df) in sorted(self.groups.items()):
            names = [pa.repeat(x, len(n)) for x in (lang, source)]
            counts = [pa.array(x, pa.int64()) for x in (list(n.values()), list(map(df.__getitem__, n)))]
            table = pa.RecordBatch.from_arrays([*names, pa.array(list(n), pa.binary()), *counts],
                                               ["lang", "source", "term", "n", "df"])
            held.append(table.take(pc.sort_indices(table.column(2))))
            if sum(map(len, held)) >= SPILL_ROWS:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches(SPILL_ROWS)
                held = []
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches(SPILL_ROWS)


def runs(docs: DataFrame) -> DataFrame:
    """The term-sorted runs of all blocks of ``docs`` (lang, source, text without nulls)."""
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block()
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                block.add(lang, source, text.as_py())
                if block.full():
                    yield from block.run()
                    block = Block()
        yield from block.run()

    return docs.select("lang", "source", "text").mapInArrow(index, RUN)


def _differs(a: pa.Array) -> np.ndarray:
    """For all rows but the first: is it unlike the row before?"""
    return pc.not_equal(a.slice(1), a.slice(0, len(a) - 1)).to_numpy(zero_copy_only=False)


def shard_key() -> Column:
    """64-bit hash of an entry's key, by which runs are dealt and merged."""
    return F.xxhash64("lang", "source", "term")


def merge(spilled: DataFrame) -> DataFrame:
    """Frequencies ``lang, source, term, n, df``: the runs merged shard by shard, neighbours added up."""
    key = ["lang", "source", "term"]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []                       # the entries of the last hash, which may go on, and what follows
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_arrays(batch.columns, batch.schema.names))
            size += batch.num_rows
            if size < MERGE_ROWS:
                continue
            table = _neighbours(pa.concat_tables(held).combine_chunks())
            h = table.column("h").to_numpy()
            cut = int(np.searchsorted(h, h[-1], side="left"))
            held, size = [table.slice(cut)], 0
            if cut:
                yield from table.slice(0, cut).select([*key, "n", "df"]).to_batches()
        if held:
            yield from _neighbours(pa.concat_tables(held).combine_chunks()).select([*key, "n", "df"]).to_batches()

    dealt = spilled.withColumn("h", shard_key())
    return dealt.repartition("h").sortWithinPartitions("h").mapInArrow(add_up, RUN)


def _neighbours(table: pa.Table) -> pa.Table:
    """``table`` (sorted by ``h``) with the entries of each key added up."""
    cols = [table.column(c).combine_chunks() for c in ("lang", "source", "term", "n", "df", "h")]
    cols = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in cols]
    change = np.zeros(len(table) - 1, bool)
    for c in (*cols[:3], cols[5]):
        change |= _differs(c)
    first = np.concatenate(([0], np.flatnonzero(change) + 1))
    at = pa.array(first)
    heads = [c.take(at) for c in cols]
    heads[3:5] = [pa.array(np.add.reduceat(c.to_numpy(), first)) for c in cols[3:5]]
    out = pa.Table.from_arrays(heads, ["lang", "source", "term", "n", "df", "h"])
    h = heads[5].to_numpy()
    if (h[1:] != h[:-1]).all():
        return out
    # different keys with one hash may alternate: these are added up by their keys
    twice = np.zeros(len(h), bool)
    twice[1:] |= h[1:] == h[:-1]
    twice[:-1] |= h[1:] == h[:-1]
    sums: dict[tuple, list[int]] = {}
    for lang, source, term, n, df, x in zip(*[c.to_pylist() for c in out.filter(pa.array(twice)).columns]):
        entry = sums.setdefault((lang, source, term, x), [0, 0])
        entry[0] += n
        entry[1] += df
    mixed = pa.Table.from_arrays(
        [*[pa.array([k[j] for k in sums], heads[j].type) for j in range(3)],
         *[pa.array([v[j] for v in sums.values()], pa.int64()) for j in range(2)],
         pa.array([k[3] for k in sums], pa.int64())], out.column_names)
    return pa.concat_tables([out.filter(pa.array(~twice)), mixed]).sort_by("h")


def _share(count: str, total: str, kinds: str) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + kinds)), exactly."""
    return F.expr(f"1 + (CAST({SCALE} AS DECIMAL(10,0)) * CAST({count} + 1 AS DECIMAL(20,0))) "
                  f"div CAST({total} + {kinds} AS DECIMAL(20,0))")


def _gap(p: str, q: str) -> str:
    """floor((p - q)^2 / q), exactly."""
    return f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})"


def corrections(postings: DataFrame) -> DataFrame:
    """``lang, a, b, fix``: summed over the terms that sources a and b both use, by streaming the postings.

    ``postings``: ``lang, sources, p, p0`` with a term's entries as arrays;
    p0 is a source's share of a term that it does not use.
    """
    def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
        return (p - q) ** 2 // q

    def batch_of(sums: dict[tuple[str, str, str], int]) -> pa.RecordBatch:
        keys = list(sums)
        return pa.RecordBatch.from_arrays(
            [*[pa.array([k[j] for k in keys], pa.string()) for j in range(3)], pa.array(list(sums.values()), pa.int64())],
            ["lang", "a", "b", "fix"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, str, str], int] = {}
        for batch in batches:
            langs, lists = batch.column(0).to_pylist(), batch.column(1)
            named = lists.flatten().dictionary_encode()
            names, who = named.dictionary.to_pylist(), named.indices.to_numpy().astype(np.int64)
            p, p0 = (batch.column(k).flatten().to_numpy() for k in (2, 3))
            size = pc.list_value_length(lists).to_numpy().astype(np.int64)
            kinds = {x: i for i, x in enumerate(dict.fromkeys(langs))}
            lang = np.repeat(np.array([kinds[x] for x in langs], np.int64), size)
            kinds_of = list(kinds)
            first = np.repeat(np.cumsum(size) - size, size)      # where an entry's list begins
            mates = np.repeat(size, size)
            upto = np.cumsum(mates)
            at = 0
            while at < len(who):                                  # entries whose pairs make one chunk
                end = max(at + 1, int(np.searchsorted(upto, upto[at] - mates[at] + PAIR_CHUNK, side="right")))
                n = mates[at:end]
                left = np.repeat(np.arange(at, end), n)
                right = np.repeat(first[at:end], n) + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
                some = left != right
                left, right = left[some], right[some]
                value = (gap(p[left], p[right]) - gap(p[left], p0[right])
                         - gap(p0[left], p[right]) + gap(p0[left], p0[right]))
                pair = (lang[left] * len(names) + who[left]) * len(names) + who[right]
                distinct, inverse = np.unique(pair, return_inverse=True)
                total = np.zeros(len(distinct), np.int64)
                np.add.at(total, inverse, value)
                for key, fix in zip(distinct.tolist(), total.tolist()):
                    rest, b = divmod(key, len(names))
                    k, a = divmod(rest, len(names))
                    held = (kinds_of[k], names[a], names[b])
                    sums[held] = sums.get(held, 0) + fix
                if len(sums) >= PAIR_ENTRIES:
                    yield batch_of(sums)
                    sums = {}
                at = end
        if sums:
            yield batch_of(sums)

    return postings.select("lang", "sources", "p", "p0").mapInArrow(run, "lang string, a string, b string, fix long")


def within(left: DataFrame, right: DataFrame, spread: str) -> DataFrame:
    """Join on ``lang`` with the left rows of a language dealt over ``SALT`` parts by the column ``spread``.

    Both sides have a language's sources, and the result has a row for each
    pair of them, which is the contract's own output.
    """
    dealt = left.withColumn("salt", F.pmod(F.xxhash64(spread), F.lit(SALT)).cast("int"))
    every = right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return dealt.join(every, ["lang", "salt"]).drop("salt")


def audit(docs: DataFrame, min_docs: int = MIN_DOCS) -> tuple[DataFrame, DataFrame]:
    """``pairs`` (lang, source, item, value) and ``terms`` (lang, source, item, value), unranked."""
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    found = materialize(merge(runs(docs)), "frequencies")
    by_term = found.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.sum("n").alias("total"))
    kept = materialize(by_term.where(F.col("df") >= min_docs).select("lang", "term", "total"), "kept-terms")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    # kept terms are distinct, so a partition's hash table of them is small
    uses = materialize(found.join(kept.hint("shuffle_hash"), ["lang", "term"]).select("lang", "source", "term", "total", "n"), "postings")
    used = uses.groupBy("lang", "source").agg(F.sum("n").alias("group_n"), F.count(F.lit(1)).alias("used"))
    groups = docs.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("docs")).join(
        used, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", F.coalesce("group_n", F.lit(0)).cast("long").alias("group_n"),
        F.coalesce("used", F.lit(0)).cast("long").alias("used"),
        F.coalesce("v", F.lit(0)).cast("long").alias("v"), F.coalesce("lang_n", F.lit(0)).cast("long").alias("lang_n"))
    zero = F.when(F.col("v") > 0, _share("0", "group_n", "v"))
    groups = materialize(groups.withColumn("p0", zero), "groups")

    # every posting with its group's share; a source with a third of the postings is a hot key
    n_postings = groups.agg(F.coalesce(F.sum("used"), F.lit(0))).first()[0]
    rated = lookup_join(uses, groups.where("used > 0"), ["lang", "source"], "used", n_postings)
    rated = materialize(rated.select("lang", "source", "term", "p0", _share("n", "group_n", "v").alias("p"),
                                     _share("total", "lang_n", "v").alias("q")), "shares")
    top = rated.where("p > q").select(
        "lang", "source", F.col("term").cast("string").alias("item"), F.expr(_gap("p", "q")).alias("value"))

    both = rated.repartition("lang", "term").groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("uses")).where(
        F.size("uses") > 1)
    fixes = corrections(both.select("lang", F.col("uses.source").alias("sources"), F.col("uses.p").alias("p"),
                                    F.col("uses.p0").alias("p0")))
    fixes = fixes.groupBy("lang", "a", "b").agg(F.sum("fix").alias("fix"))

    # terms that one of the two uses: by the shares it has, and the share of the other for terms it does not use
    shares = rated.groupBy("lang", "source", "p0", "p").agg(F.count(F.lit(1)).alias("m"))
    others = groups.where("v > 0").select("lang", F.col("p0").alias("x")).distinct()
    single = within(shares, others, "source").groupBy("lang", "source", "x").agg(
        F.sum(F.expr(f"m * ({_gap('p', 'x')} - {_gap('p0', 'x')})")).alias("as_first"),
        F.sum(F.expr(f"m * ({_gap('x', 'p')} - {_gap('x', 'p0')})")).alias("as_second"))
    single = materialize(single, "one-sided")
    mine = groups.select("lang", F.col("source").alias("a"), "v", F.col("p0").alias("pa"))
    theirs = groups.select("lang", F.col("source").alias("b"), F.col("p0").alias("pb"))
    pairs = within(mine, theirs, "a").where(F.col("a") != F.col("b"))
    pairs = (pairs.join(single.select("lang", F.col("source").alias("a"), F.col("x").alias("pb"), "as_first"),
                        ["lang", "a", "pb"], "left")
             .join(single.select("lang", F.col("source").alias("b"), F.col("x").alias("pa"), "as_second"),
                   ["lang", "b", "pa"], "left")
             .join(fixes, ["lang", "a", "b"], "left"))
    base = F.when(F.col("v") > 0, F.expr(f"v * ({_gap('pa', 'pb')})"))
    value = sum((F.coalesce(c, F.lit(0)) for c in (F.col("as_first"), F.col("as_second"), F.col("fix"))),
                F.coalesce(base, F.lit(0)))
    return (pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), value.cast("long").alias("value")),
            top)


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The result of the contract."""
    pairs, top = audit(docs)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    pairs = pairs.withColumn("rank", rank).withColumn("part", F.lit("pair"))
    top = top.withColumn("rank", rank).where(F.col("rank") <= TOP_TERMS).withColumn("part", F.lit("term"))
    return pairs.unionByName(top).select("lang", "source", "part", "item", "value", "rank")
