"""Operator 13 against its SQL and a dense brute force, at small block and chunk sizes too."""

import random
import re
from collections import Counter

import duckdb
import pytest

from bellwether.llm import source_divergence as S
from bellwether.llm.oracle import OP13

COLUMNS = ("lang", "source", "part", "item", "value", "rank")


def corpus():
    rng = random.Random(2)
    vocab = ["alpha", "Beta", "été", "GAMMA", "x", "日本", "zeta", "mu", "nu", "a" * 50]
    rows = []
    for k in range(120):
        words = [rng.choice(vocab[:rng.randint(2, 10)]) for _ in range(rng.randint(0, 30))]
        rows.append((k, "; ".join(words) + rng.choice(["", "1", " İ", " ß9"]), rng.choice(["en", "de", None, "fr"]),
                     rng.choice(["s1", "s2", "s3", None, "s4"]), "clash"))
    rows += [(200, None, "es", "s1", ""), (201, "12 !", "es", "s2", ""), (202, "only once", "it", "s9", ""), (203, "", None, None, "")]
    rows += [(300 + k, "common words of one hot source", "en", "s1", "") for k in range(200)] + rows[:3]
    return rows


def brute(rows):
    docs = [(lang or "", source or "", re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub(
        "[A-Z]", lambda m: m[0].lower(), text or ""))) for _, text, lang, source, _ in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t in df if df[t] >= 3)
        groups = {}
        for _, source, ts in own:
            groups.setdefault(source, Counter()).update(t for t in ts if df[t] >= 3)
        every = sum(groups.values(), Counter())

        def share(c):
            n = sum(c.values()) + len(kept)
            return {t: 1 + 10 ** 9 * (c[t] + 1) // n for t in kept}
        p = {s: share(c) for s, c in groups.items()}
        q = share(every)
        gap = lambda a, b: (a - b) ** 2 // b
        for s in groups:
            pairs = [(o, sum(gap(p[s][t], p[o][t]) for t in kept)) for o in groups if o != s]
            terms = [(t, gap(p[s][t], q[t])) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, 200)):
                order = sorted(found, key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, r) for r, (item, v) in enumerate(order[:most], 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, term string")


@pytest.mark.parametrize("block, chunk, entries, segment", [(None,) * 4, (5, 3, 2, 16)])
def test_equals_brute_force_and_sql(spark, monkeypatch, block, chunk, entries, segment):
    rows = corpus()
    if block:
        for name, value in (("BLOCK_ENTRIES", block), ("PAIR_CHUNK", chunk), ("PAIR_ENTRIES", entries), ("SEGMENT", segment),
                            ("MERGE_ROWS", block), ("SPILL_ROWS", block)):
            monkeypatch.setattr(S, name, value)
    got = sorted(tuple(r[c] for c in COLUMNS) for r in S.query(spark, frame(spark, rows)).collect())
    assert got == brute(rows)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, term VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    assert got == sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({OP13})").fetchall())


def test_runs_are_sorted_and_merge_to_the_counts(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_ENTRIES", 4)
    docs = frame(spark, corpus()).fillna("", ["lang", "source", "text"])
    spilled = S.runs(docs.coalesce(1))
    keys = [(r["lang"], r["source"], bytes(r["term"])) for r in spilled.collect()]
    assert sum(a > b for a, b in zip(keys, keys[1:])) > 10        # many runs, each of them sorted
    merged = [(r["lang"], r["source"], bytes(r["term"]), r["n"], r["df"]) for r in S.merge(spilled).collect()]
    assert len({m[:3] for m in merged}) == len(merged)
    want = Counter()
    for _, text, lang, source, _ in corpus():
        want.update((lang or "", source or "", t) for t in (text or "").encode().translate(S.TERM_BYTES).split())
    assert {m[:3]: m[3] for m in merged} == want


def test_long_texts_are_cut_between_terms(monkeypatch):
    text = (b"Alpha beta1gamma " * 200) + b"x" * 5000 + b" end"
    whole = S.terms(text)
    monkeypatch.setattr(S, "SEGMENT", 64)
    assert S.terms(text) == whole and whole[b"x" * 5000] == 1


def test_empty(spark):
    assert S.query(spark, frame(spark, [])).count() == 0
    assert [r["value"] for r in S.query(spark, frame(spark, [(1, None, None, "a", ""), (2, "", None, "b", "")])).collect()] == [0, 0]


def test_keys_that_share_a_hash_stay_apart(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(S, "shard_key", lambda: F.length("term").cast("long") % 3)
    monkeypatch.setattr(S, "BLOCK_ENTRIES", 4)
    rows = corpus()
    assert sorted(tuple(r[c] for c in COLUMNS) for r in S.query(spark, frame(spark, rows)).collect()) == brute(rows)
