"""Operator 1, near-dedup: ProbMinHash, banding and verification.

A text is the weighted set of its shingles of five words (a shorter text is
one shingle); a shingle that occurs n times weighs 1 + ln n.  ProbMinHash
lets every shingle arrive at random components as a Poisson process of rate
its weight; a component keeps the first arrival, and a shingle stops once its
next arrival is later than every component's.  Two signatures agree in a
component with the probability Jaccard similarity of the two texts.

1. Texts with the same words are one node, so exact copies never meet.
2. Banding: nodes that agree in a whole band share a bucket.  In a bucket,
   nodes whose signatures agree in at least ``threshold - SLACK`` of the
   components are joined into families.
3. Verification: inside a family the exact probability Jaccard similarity
   decides; nodes linked by ``threshold`` or more, directly or through
   others, are one class.

Both joinings work on groups of bounded size: a large bucket or family is
dealt into blocks, each block (with the group's first node) is joined in a
task of its own, and then the nodes outside the group's largest part are
compared with all blocks, so no pair of nodes that are still apart goes
uncompared.  Tasks return spanning links, never all pairs.

Bands are 30 of 6 components: a pair at similarity 0.8 shares a bucket with
probability 0.9999, more above.

Defined cases: null, empty and wordless texts are alone in their class;
texts whose words are equal are one class (ties and repeated rows too); very
long texts are read whole; rows with a null id are in no class of others; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bellwether.llm.common import connected_components, lookup_join, materialize
from bellwether.llm.text import HashCache, words

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 30, 6
COMPONENTS = BANDS * ROWS
SLACK = 0.15                 # four to five standard errors of a signature's estimate
ROUNDING = 1e-9              # of a sum of reciprocals, which must not cost a pair at the threshold its link
BLOCK = 1_024                # nodes compared in one task
BLOCK_BYTES = 1 << 25        # of what one task compares, unless a single node has more
BATCH_WORDS = 100_000        # words whose arrivals are drawn at once
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _B
        x = (x ^ (x >> np.uint64(27))) * _C
        return x ^ (x >> np.uint64(31))


def shingles(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a text's word hashes, sorted, and their weights."""
    k = min(SHINGLE, len(hashes))
    if not k:
        return np.zeros(0, np.uint64), np.zeros(0)
    with np.errstate(over="ignore"):
        h = np.full(len(hashes) - k + 1, np.uint64(k))
        for j in range(k):
            h = (h ^ hashes[j: len(hashes) - k + 1 + j]) * _A
            h ^= h >> np.uint64(32)
    distinct, n = np.unique(mix(h), return_counts=True)
    return distinct, 1.0 + np.log(n)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard: sum over shared i of 1 / sum over j of max(a_j / a_i, b_j / b_i)."""
    shared, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(shared):
        return 0.0
    x, y = a[1][ia], b[1][ib]
    only_a, only_b = a[1].sum() - x.sum(), b[1].sum() - y.sum()
    ratio = y / x
    order = np.argsort(ratio, kind="stable")
    x, y, ratio = x[order], y[order], ratio[order]
    # the larger of a_j / a_i and b_j / b_i is the first where b_j / a_j is at most b_i / a_i
    upto = np.searchsorted(ratio, ratio, side="right")
    xs, ys = np.concatenate(([0.0], np.cumsum(x))), np.concatenate(([0.0], np.cumsum(y)))
    total = (xs[upto] + only_a) / x + (ys[-1] - ys[upto] + only_b) / y
    return float((1.0 / total).sum())


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], m: int = COMPONENTS) -> np.ndarray:
    """ProbMinHash signatures (texts x m) of weighted sets that are not empty.

    Arrivals of all texts are drawn round by round.  A shingle whose next
    arrival is later than its text's horizon stops; the horizon is a time by
    which all components have had an arrival with high probability, and it
    is doubled for texts where some have not, so the result is exactly that
    of running every process until all components are settled.
    """
    owner = np.repeat(np.arange(len(sets)), [len(s[0]) for s in sets])
    element = np.concatenate([s[0] for s in sets])
    weight = np.concatenate([s[1] for s in sets])
    total = np.bincount(owner, weight, len(sets))
    horizon = m * (np.log(m) + 3.0) / total
    best_t = np.full(len(sets) * m, np.inf)
    best_e = np.zeros(len(sets) * m, np.uint64)
    time = np.zeros(len(element))
    drawn = np.zeros(len(element), np.uint64)
    waiting = np.full(len(element), -1.0)            # next arrival, where it was drawn but was too late
    slot = np.zeros(len(element), np.int64)
    live = np.arange(len(element))
    while len(live):
        fresh = live[waiting[live] < 0]
        with np.errstate(over="ignore"):
            drawn[fresh] += np.uint64(1)
            z = mix(element[fresh] + drawn[fresh] * _A)
        u = ((z >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0 ** -52
        waiting[fresh] = time[fresh] - np.log(u) / weight[fresh]
        slot[fresh] = owner[fresh] * m + (mix(z ^ _C) % np.uint64(m)).astype(np.int64)
        now = live[waiting[live] <= horizon[owner[live]]]
        if len(now):
            order = now[np.argsort(-waiting[now], kind="stable")]     # the earliest is written last
            s, t = slot[order], waiting[order]
            better = t < best_t[s]
            best_t[s[better]] = t[better]
            best_e[s[better]] = element[order[better]]
            time[now] = waiting[now]
            waiting[now] = -1.0
            live = now
        else:
            open_text = np.isinf(best_t.reshape(-1, m)).any(axis=1)
            horizon[open_text] *= 2.0
            live = np.flatnonzero(open_text[owner])
    return best_e.reshape(-1, m)


def _blocks(column: pa.Array, size: int = BATCH_WORDS) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Words of the texts of a column, in blocks of about ``size``, each with the row it begins at."""
    first, held, n = 0, [], 0
    for row, text in enumerate(column):
        ws = words(text.as_py())
        if held and n + len(ws) > size:
            yield first, held
            first, held, n = row, [], 0
        held.append(ws)
        n += len(ws)
    if held:
        yield first, held


def _hashes(ws: list[bytes], cache: HashCache) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, ws), np.uint64, len(ws))


def sketch(docs: DataFrame) -> DataFrame:
    """``doc_id, node, bands, marks`` of every row of ``docs`` (doc_id, text).

    ``node``: digest of the words (null without words); ``bands``: hash of
    each band; ``marks``: the signature with 16 bits a component.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = HashCache()
        for batch in batches:
            for first, texts in _blocks(batch.column(1)):
                some = [i for i, ws in enumerate(texts) if ws]
                node: list[bytes | None] = [None] * len(texts)
                bands: list[np.ndarray | None] = [None] * len(texts)
                marks: list[bytes | None] = [None] * len(texts)
                if some:
                    sig = signatures([shingles(_hashes(texts[i], cache)) for i in some])
                    with np.errstate(over="ignore"):
                        key = np.zeros((len(some), BANDS), np.uint64)
                        for r in range(ROWS):
                            key = mix(key * _A + sig.reshape(-1, BANDS, ROWS)[:, :, r])
                        key = mix(key + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
                    short = (sig >> np.uint64(48)).astype(np.uint16)
                    for j, i in enumerate(some):
                        node[i] = xxhash.xxh3_128_digest(b" ".join(texts[i]))
                        bands[i] = key[j]
                        marks[i] = short[j].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(node, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64())), pa.array(marks, pa.binary())],
                    ["doc_id", "node", "bands", "marks"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, node binary, bands array<long>, marks binary")


class Parts:
    """Which of the nodes 0..n-1 are joined: a label for each."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, i: int, j: int) -> None:
        a, b = self.label[i], self.label[j]
        if a != b:
            self.label[self.label == max(a, b)] = min(a, b)

    def apart(self, i: int, others: np.ndarray) -> np.ndarray:
        return others[self.label[others] != self.label[i]]


def link_marks(payloads: list[bytes], parts: Parts, left: np.ndarray, least: float) -> None:
    """Join nodes whose signatures agree in at least ``least`` of the components."""
    sig = np.frombuffer(b"".join(payloads), np.uint16).reshape(len(payloads), -1)
    every = np.arange(len(payloads))
    for i in left:
        others = parts.apart(i, every)
        if len(others):
            agree = (sig[others] == sig[i]).mean(axis=1)
            for j in others[agree >= least]:
                parts.join(i, j)


def link_texts(payloads: list[str], parts: Parts, left: np.ndarray, least: float) -> None:
    """Join nodes whose texts have a probability Jaccard similarity of at least ``least``.

    Signatures tell which pairs are worth the exact comparison (those within
    ``SLACK`` of the threshold), the most similar first: a link found early
    spares comparisons within the part it joins.
    """
    cache = HashCache()
    sets = [shingles(_hashes(words(t), cache)) for t in payloads]
    sig = (signatures(sets) >> np.uint64(48)).astype(np.uint16)
    every = np.arange(len(payloads))
    for i in left:
        others = parts.apart(i, every)
        agree = (sig[others] == sig[i]).mean(axis=1)
        near = others[agree >= least - SLACK]
        for j in near[np.argsort(-agree[agree >= least - SLACK], kind="stable")]:
            if parts.label[i] != parts.label[j] and similarity(sets[i], sets[j]) >= least - ROUNDING:
                parts.join(i, j)


Linker = Callable[[list, Parts, np.ndarray, float], None]


def _linking(link: Linker, least: float) -> Callable:
    """Group function: link the group's nodes, return a star for each part of more than one."""
    def run(table: pa.Table) -> pa.Table:
        first: dict[int, int] = {}
        table = table.sort_by("node")                # the head of a star is its least node
        nodes = table.column("node").to_pylist()
        keep = [k for k, v in enumerate(nodes) if first.setdefault(v, k) == k]
        minor = {v for v, m in zip(nodes, table.column("minor").to_pylist()) if m}
        ids = [nodes[k] for k in keep]
        payload = table.column("payload").take(pa.array(keep)).to_pylist()
        parts = Parts(len(ids))
        known: dict[int, int] = {}
        for k, c in enumerate(table.column("comp").take(pa.array(keep)).to_pylist()):
            if c is not None:                        # what an earlier round has joined
                parts.join(known.setdefault(c, k), k)
        link(payload, parts, np.array([k for k, v in enumerate(ids) if v in minor], np.int64), least)
        star = [(ids[h], ids[k]) for k, h in enumerate(parts.label) if h != k]
        return pa.table({"a": pa.array([s[0] for s in star], pa.int64()),
                         "b": pa.array([s[1] for s in star], pa.int64())})
    return run


def slim(edges: DataFrame) -> DataFrame:
    """The same components with fewer edges (a, b), a < b: one step of the small-star kind.

    A node that several stars hold points at one head after another; each
    node is linked to its least head only, and its other heads to that one.
    Stars have their least node as the head, so a node is the larger end of
    as many edges as it has groups (one for each band at most).
    """
    least = edges.groupBy("b").agg(F.min("a").alias("head"))
    heads = edges.join(least, "b").where(F.col("a") != F.col("head")).select(F.col("head").alias("a"), F.col("a").alias("b"))
    return least.select(F.col("head").alias("a"), "b").unionByName(heads).distinct()


def link_groups(members: DataFrame, link: Linker, least: float, block: int = BLOCK) -> DataFrame:
    """Components of the nodes that ``link`` joins within groups: ``id, comp``.

    ``members``: ``grp, node, payload``; a node may be in several groups.
    Nodes that are joined with no other are missing from the result.
    """
    members = materialize(members, "members")
    sizes = members.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("first"),
                                       F.sum(F.octet_length("payload")).alias("bytes")).where("n > 1")
    # blocks that a group is dealt into, by its nodes or by its bytes
    fill = F.greatest(F.col("n") / F.lit(block), F.col("bytes") / F.lit(BLOCK_BYTES))
    sizes = materialize(sizes.select("grp", "first", fill.alias("fill"), F.ceil(fill).cast("int").alias("blocks")),
                        "group-sizes")
    inside = members.join(sizes, "grp")
    dealt = inside.withColumn("blk", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # the first node of a large group joins every block of it
    firsts = inside.where((F.col("node") == F.col("first")) & (F.col("blocks") > 1)).withColumn(
        "blk", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = dealt.unionByName(firsts).select(
        "grp", "blk", "node", "payload", F.lit(None).cast("long").alias("comp"), F.lit(True).alias("minor"))
    edges = rows.groupBy("grp", "blk").applyInArrow(_linking(link, least), "a long, b long")
    edges = materialize(edges.distinct(), "links")
    comps = connected_components(slim(edges))

    large = sizes.where("blocks > 1")
    if large.limit(1).count() == 0:
        return comps
    # groups of several blocks: compare what lies outside the largest part with everything
    own = F.coalesce("comp", "node")
    mine = members.join(large.select("grp", "fill"), "grp").join(
        comps.select(F.col("id").alias("node"), "comp"), "node", "left").withColumn("comp", own)
    parts = materialize(mine.groupBy("grp", "comp").agg(F.count(F.lit(1)).alias("count"), F.max("fill").alias("fill")),
                        "group-parts")
    top = parts.groupBy("grp").agg(F.max_by("comp", F.struct("count", "comp")).alias("top"), F.max("fill").alias("fill"),
                                   F.sum("count").alias("n"), F.max("count").alias("most"))
    top = top.where(F.col("n") > F.col("most")).select(
        "grp", "top", F.ceil((F.col("n") - F.col("most")) / F.col("n") * F.col("fill") * 2).cast("long").alias("small"),
        F.ceil(F.col("fill") * 2).cast("long").alias("all"))
    open_rows = mine.drop("fill").join(top, "grp")
    minor = F.col("comp") != F.col("top")
    of_minor = open_rows.where(minor).withColumn(
        "i", F.pmod(F.xxhash64("node", F.lit(1)), F.col("small"))).withColumn(
        "j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("all") - 1)))
    of_all = open_rows.withColumn("j", F.pmod(F.xxhash64("node", F.lit(2)), F.col("all"))).withColumn(
        "i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("small") - 1)))
    cols = ["grp", "i", "j", "node", "payload", "comp"]
    pairs = of_minor.select(*cols, F.lit(True).alias("minor")).unionByName(
        of_all.select(*cols, F.lit(False).alias("minor")))
    more = pairs.groupBy("grp", "i", "j").applyInArrow(_linking(link, least), "a long, b long")
    joined = comps.where("id != comp").select(F.col("comp").alias("a"), F.col("id").alias("b"))
    return connected_components(slim(materialize(more.unionByName(joined).distinct(), "links")))


def classes(docs: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """``doc_id, node_id, class_id`` for every row of ``docs`` (doc_id, text).

    ``node_id``: least id of the rows with the same words; ``class_id``:
    least node of the near-duplicate class.  Both are the row's own id for
    wordless texts.
    """
    sk = materialize(sketch(docs), "sketch")
    nodes = materialize(sk.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("doc_id").alias("id"), F.min_by("bands", F.coalesce("doc_id", F.lit(0))).alias("bands"),
        F.min_by("marks", F.coalesce("doc_id", F.lit(0))).alias("marks"), F.count(F.lit(1)).alias("n")), "nodes")
    entries = nodes.where(F.col("id").isNotNull()).select("id", F.explode("bands").alias("grp"))
    shared = entries.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("grp")
    crowded = materialize(entries.join(shared, "grp"), "buckets")
    members = crowded.join(nodes.select("id", "marks"), "id").select(
        "grp", F.col("id").alias("node"), F.col("marks").alias("payload"))
    families = link_groups(members, link_marks, threshold - SLACK, block)

    # exact verification inside families, on the texts of one row of each node
    wanted = families.select(F.col("id").alias("doc_id"), F.col("comp").alias("grp"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted.hint("merge"), "doc_id")
    found = link_groups(texts.select("grp", F.col("doc_id").alias("node"), F.col("text").alias("payload")),
                        link_texts, threshold, block)
    labelled = nodes.select("node", F.col("id").alias("node_id"), "n").join(
        found.select(F.col("id").alias("node_id"), "comp"), "node_id", "left").select(
        "node", "node_id", "n", F.coalesce("comp", "node_id").alias("class_id"))
    labelled = materialize(labelled, "labelled")
    worded = sk.where(F.col("node").isNotNull()).select("doc_id", "node")
    rows = lookup_join(worded, labelled, "node", "n", sk.count())
    alone = sk.where(F.col("node").isNull()).select(
        "doc_id", F.col("doc_id").alias("node_id"), F.col("doc_id").alias("class_id"))
    return rows.select("doc_id", "node_id", "class_id").unionByName(alone)


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class, that with the class's least id, with all its columns.

    Rows with a null id have no class and stay.
    """
    dropped = classes(docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text"), threshold).where(
        F.col("doc_id") != F.col("class_id")).select("doc_id").distinct()
    return docs.join(dropped, docs["doc_id"].cast("long") == dropped["doc_id"], "left_anti")


def query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: its class and whether it is the one that stays."""
    out = classes(docs)
    return out.select("doc_id", "class_id", "node_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))
