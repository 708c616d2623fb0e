"""Operator 2 against naive window search."""

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from bellwether.llm import decontaminate as D
from bellwether.llm.text import words


def brute(items, ws, window):
    hit, ids = set(), set()
    for name, text in items:
        iw = words(text)
        size = min(window, len(iw))
        for i in range(len(iw) - size + 1 if iw else 0):
            for p in range(len(ws) - size + 1):
                if ws[p:p + size] == iw[i:i + size]:
                    hit.update(range(p, p + size))
                    ids.add(name)
    return hit, ids


sentence = st.lists(st.sampled_from(["a", "b", "c", "É", "d-e"]), max_size=14).map(" ".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(sentence, max_size=5), st.lists(st.sampled_from(["a", "b", "c", "É", "zz"]), max_size=30),
       st.integers(1, 5))
def test_scan_equals_brute_force(texts, ws, window):
    items = [(str(i), t) for i, t in enumerate(texts)]
    ws = words(" ".join(ws))
    runs, ids = D.scan(D.build_automaton(items, window), ws)
    hit, want = brute(items, ws, window)
    assert {i for s, e in runs for i in range(s, e)} == hit
    assert {items[k][0] for k in ids} == want
    assert all(a[1] < b[0] for a, b in zip(runs, runs[1:])) or len(runs) < 2 or D.merge_runs(runs) == runs


ITEM = "one two three four five six seven eight nine ten eleven twelve"
DOCS = [(1, f"Before it. {ITEM.upper()}! After it and a good deal more, more words than the passage has in it here.", 9, "x"),
        (2, ITEM, 3, "x"), (3, "nothing of it", 13, None), (4, None, None, "x"), (5, "", 0, "x"), (6, "short item", 1, "x"),
        (6, "short item", 1, "x")]
BENCH = [(10, ITEM), (9, "three four five six seven eight nine ten eleven twelve"), (8, None), (7, "short item"),
         (7, "short item"), (6, "!!")]


def frames(spark):
    return (spark.createDataFrame(DOCS, "doc_id long, text string, n_chars long, items string"),
            spark.createDataFrame(BENCH, "item_id long, text string"))


def test_query_and_blocks(spark):
    docs, bench = frames(spark)
    one = sorted(map(tuple, D.query(spark, docs, bench).collect()))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert one == [(1, 30, 12, 2, sha("10,9"), True), (2, 12, 12, 2, sha("10,9"), True), (3, 3, 0, 0, sha(""), False),
                   (4, 0, 0, 0, sha(""), False), (5, 0, 0, 0, sha(""), False), (6, 2, 2, 1, sha("7"), True),
                   (6, 2, 2, 1, sha("7"), True)]
    whole = D.find_hits(docs, bench).collect()
    dealt = D.find_hits(docs, bench, block_words=3).collect()
    assert sorted(map(str, whole)) == sorted(map(str, dealt))


def test_remove_spans(spark):
    docs, bench = frames(spark)
    out = D.remove_spans(docs, bench)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r for r in out.collect()}
    assert sorted(got) == [1, 3, 4, 5]                      # 2 and 6 are mostly benchmark
    assert got[1]["text"] == "Before it. ! After it and a good deal more, more words than the passage has in it here."
    assert got[1]["n_chars"] == len(got[1]["text"]) and got[3]["n_chars"] == 13 and got[4]["text"] is None
    assert D.query(spark, out, bench).where("contaminated").count() == 0
    assert D.remove_spans(docs.limit(0), bench).count() == 0
    assert D.remove_spans(docs, bench.limit(0)).count() == len(DOCS)
