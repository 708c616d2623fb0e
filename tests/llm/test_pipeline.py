"""The pipeline against a brute-force version, and what the entry module needs of it."""

import sentencepiece

import corpus_pipeline as P
from bellwether.llm import decontaminate as D
from bellwether.llm import langid as L
from bellwether.llm import sentencepiece_scan as S
from test_decontaminate import brute
from test_near_dedup import brute_classes
from bellwether.llm.text import words


def test_stages():
    assert [n for n, _ in P.STAGES] == ["language_id", "exact_dedup", "near_dedup", "decontaminate", "sentencepiece"]


def test_pipeline_equals_brute_force(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    base = spark.read.parquet(f"{sf}/documents.parquet").limit(120)
    extra = spark.createDataFrame([(10_000, None, "en", "x", None), (10_001, "12 !", "en", "x", 4), (10_001, "12 !", "en", "x", 4)],
                                  base.schema)
    base.unionByName(extra).unionByName(base.where("doc_id < 3")).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{sf}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = P.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "ids", "n_pieces"]
    got = {r["doc_id"]: (r["text"], r["n_chars"], r["ids"]) for r in out.collect()}

    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    bench = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(str(tmp_path / "benchmark.parquet")).collect()]
    model = L.fit(docs)
    rows = {(r["doc_id"], r["text"], r["n_chars"]) for r in docs.collect()}
    rows = [r for r in sorted(rows, key=lambda r: r[0]) if L.predict(model, [r[1]])[2][0]]
    last = {}
    for r in rows:
        last[r[1]] = max(last.get(r[1], -1), r[0])
    rows = [r for r in rows if last[r[1]] == r[0]]
    cls = brute_classes(rows)
    rows = [r for r in rows if cls[r[0]] == r[0]]
    lib = sentencepiece.SentencePieceProcessor(model_file=S.MODEL)
    want = {}
    for i, text, n in rows:
        hit, _ = brute(bench, words(text), D.WINDOW)
        if len(hit) > D.MAX_COVERAGE * len(words(text)):
            continue
        if hit:
            runs = D.merge_runs([(h, h + 1) for h in hit])
            text = D.cut(text, runs)
            n = len(text)
        want[i] = (text, n, lib.encode(text))
    assert got == want


def test_empty_tables(spark, tmp_path):
    """No documents: no rows; no benchmark: nothing is removed; a clashing column and a very long text pass through."""
    sf = "/root/testdata/sf0.001"
    base = spark.read.parquet(f"{sf}/documents.parquet").limit(60).selectExpr("*", "doc_id AS node")
    every = " ".join(r["text"] or "" for r in base.orderBy("doc_id").collect())
    long = spark.createDataFrame([(9999, every * 8, "en", "x", 0, 1)], base.schema)
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    for name, docs, items in (("none", base.limit(0), bench), ("all", base.unionByName(long), bench.limit(0))):
        docs.write.parquet(str(tmp_path / name / "documents.parquet"))
        items.write.parquet(str(tmp_path / name / "benchmark.parquet"))
        out = P.run(spark, str(tmp_path / name))
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "node", "ids", "n_pieces"]
        rows = {r["doc_id"]: r for r in out.collect()}
        if name == "none":
            assert not rows
        else:
            texts = {r["doc_id"]: r["text"] for r in docs.collect()}
            assert 9999 in rows and all(r["text"] == texts[i] for i, r in rows.items())


def test_registered():
    from __spark_entry__ import queries
    assert {"op1_near_dedup", "op10_sentencepiece", "pipeline"} <= set(queries())
