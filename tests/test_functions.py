"""Column functions: P1, P3, P4, P6, P7, P13, P18, P21 and the V1 slot."""

import datetime as dt

import pandas as pd
from pyspark.sql import functions as F

from bellwether import schemas
from bellwether.functions import parsing as P
from bellwether.functions.text import preview
from bellwether.operators.udf_scoring import score_with


def test_bytes_and_repair(spark):
    df = spark.createDataFrame([(bytearray(b"ok"),), (bytearray(b"a\xffb"),)], "v binary")
    got = [r[0] for r in df.select(P.bytes_to_string("v", repair=True)).collect()]
    assert got[0] == "ok" and got[1].startswith("a") and got[1].endswith("b")


def test_epoch_drops_fraction_exact_keeps_it(spark):
    df = spark.createDataFrame([(1719576200.987,), (None,)], "e double")
    r = df.select(P.epoch_to_timestamp("e").alias("w"), P.epoch_to_timestamp_exact("e").alias("x")).collect()
    assert r[0]["w"] == dt.datetime(2024, 6, 28, 12, 3, 20)
    assert r[0]["x"].microsecond // 1000 == 987
    assert r[1]["w"] is None


def test_iso_and_lenient(spark):
    df = spark.createDataFrame([("2025-01-02T03:04:05Z",), ("2025-01-01",), ("x",), (None,),
                                ("2025-1-2T3:4:5Z",), ("2025-01-02T03:04:05+01:00",)], "s string")
    got = df.select(P.iso_to_display("s").alias("d"), P.lenient_timestamp("s").alias("l")).collect()
    assert [r["d"] for r in got] == ["2025-01-02 03:04:05", None, None, None,
                                     "2025-01-02 03:04:05", None]      # as strptime does
    assert got[1]["l"] == dt.datetime(2025, 1, 1) and got[2]["l"] is None


def test_conditional_parse(spark):
    df = spark.createDataFrame([('{"sentiment":"Positive","confidence":0.5}',), ("",), (None,), ("junk",)],
                               "j string")
    got = df.select(P.conditional_parse("j", schemas.SENTIMENT_RESULT).alias("s")).collect()
    assert got[0]["s"]["sentiment"] == "Positive"
    assert got[1]["s"] is None and got[2]["s"] is None
    assert got[3]["s"] is not None and got[3]["s"]["sentiment"] is None   # all-null, not null


def test_wall_clock_and_preview(spark):
    r = spark.range(1).select(P.wall_clock_epoch().alias("t"), preview(F.lit("x" * 80)).alias("p")).collect()[0]
    assert r["t"] > 1.7e9 and len(r["p"]) == 50


def test_pandas_scorer_slot(spark):
    df = spark.createDataFrame([("up",), ("down",), ("",), (None,)], "title string")
    def scorer(s: pd.Series) -> pd.Series:
        return s.map({"up": 0.6, "down": -0.7}).astype("float64")
    got = {r["title"]: (r["sentiment"], r["compound"]) for r in score_with(df, scorer).collect()}
    assert got["up"] == ("Positive", 0.6) and got["down"] == ("Negative", -0.7)
    assert got[""] == ("Neutral", 0.0) and got[None] == ("Neutral", 0.0)

    def broken(s):
        raise ValueError("boom")
    assert {r["sentiment"] for r in score_with(df, broken).collect()} == {"Neutral"}


def test_field_violations(spark):
    from bellwether import schemas
    from bellwether.functions.parsing import field_violations
    rows = [(1, '{"title":"a","fetched_at":"x"}'), (2, '{"title":"a","fetched_at":1.5}'), (3, '{"fetched_at":null}'), (4, "junk"),
            (5, None), (6, '{"title":5,"fetched_at":[1,"b"]}'), (7, '{"fetched_at":{"a":1}}'), (8, '{"fetched_at":true}'), (9, "")]
    df = spark.createDataFrame(rows, "id int, value string")
    got = {r["id"]: [tuple(v) for v in r["v"]] for r in df.select("id", field_violations("value", schemas.NEWS).alias("v")).collect()}
    assert got[1] == [("fetched_at", "double", "string", "x")]
    assert got[6] == [("fetched_at", "double", "array", '[1,"b"]')]
    assert got[7] == [("fetched_at", "double", "object", '{"a":1}')] and got[8] == [("fetched_at", "double", "boolean", "true")]
    assert not any(got[k] for k in (2, 3, 4, 5, 9))


def test_a_factory_is_called_once_per_worker(spark, tmp_dir):
    """Many tasks and batches, a call for each Python worker process only; blank and failing rows as without a factory."""
    import os
    from bellwether.operators.udf_scoring import score_with

    def factory():
        with open(os.path.join(tmp_dir, "calls"), "a") as f:
            f.write(f"{os.getpid()}\n")

        def scorer(texts):
            if (texts == "boom").any():
                raise ValueError
            return texts.str.len() / 10.0
        return scorer
    df = spark.createDataFrame([("abc",), ("",), (None,), ("boom",), ("abcde",)] * 40, "title string").repartition(16)
    out = score_with(df, factory=factory)
    for _ in range(3):
        got = {(r["title"], round(r["compound"], 3)) for r in out.collect()}
        assert got == {("abc", 0.3), ("", 0.0), (None, 0.0), ("boom", 0.0), ("abcde", 0.5)}
    calls = open(os.path.join(tmp_dir, "calls")).read().split()
    assert len(calls) == len(set(calls)) <= spark.sparkContext.defaultParallelism * 2
