"""Operator 5: brute force, the persistent index, edge cases."""

import hashlib

from bellwether.llm import exact_dedup as X


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, digest string")


ROWS = [(1, "a", "p"), (2, "a", "q"), (3, None, "r"), (4, "", "s"), (5, "b", "t"), (5, "b", "t"), (None, "c", "u"),
        (7, "a ", "v"), (None, "a", "w")] + [(100 + i, "hot", "h") for i in range(300)]


def test_query_equals_brute_force(spark):
    got = X.query(spark, frame(spark, ROWS)).collect()
    groups = {}
    for i, t, _ in ROWS:
        groups.setdefault(t or "", []).append(i)
    want = []
    for i, t, _ in ROWS:
        g = groups[t or ""]
        keep = max((x for x in g if x is not None), default=None)
        want.append((i, keep, len(g), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_keep_one_keeps_other_columns(spark):
    kept = X.keep_one(frame(spark, ROWS))
    assert kept.columns == ["doc_id", "text", "digest"]
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["digest"]) for r in kept.collect())
    assert got == [((False, 2), "q"), ((False, 4), "s"), ((False, 5), "t"), ((False, 7), "v"), ((False, 399), "h"),
                   ((True, 0), "u")]


def test_index_persists_and_batches_are_idempotent(spark):
    index = X.new_index(spark)
    first = {r["doc_id"]: r["kept"] for r in X.classify(frame(spark, [(1, "a", ""), (2, "b", "")]), index, "one").collect()}
    assert first == {1: True, 2: True}
    batch = frame(spark, [(3, "b", ""), (4, "c", ""), (5, "c", "")])
    for _ in range(2):                                    # the second run repeats the batch
        got = {r["doc_id"]: (r["kept"], r["keep_id"]) for r in X.classify(batch, index, "two").collect()}
        assert got == {3: (False, 2), 4: (False, 5), 5: (True, 5)}
        assert index.table().count() == 3
    plan = index.table().hint("merge").join(index.table().hint("merge"), "digest")._jdf.queryExecution().toString()
    assert "Bucketed: true" in plan


def test_empty_table(spark):
    assert X.query(spark, frame(spark, ROWS).limit(0)).count() == 0
    assert X.keep_one(frame(spark, ROWS).limit(0)).count() == 0


def test_no_index_of_its_own_is_left_in_the_catalog(spark):
    names = lambda: {t.name for t in spark.catalog.listTables() if t.name.startswith("digest_index_")}
    before = names()
    assert X.query(spark, frame(spark, ROWS)).count() == len(ROWS) and X.keep_one(frame(spark, ROWS)).count() == 6
    assert names() == before


def test_very_long_text(spark):
    long = "word " * 400_000
    got = {r["doc_id"]: r["kept"] for r in X.query(spark, frame(spark, [(1, long, ""), (2, long + "x", ""), (3, long, "")])).collect()}
    assert got == {1: False, 2: True, 3: True}
