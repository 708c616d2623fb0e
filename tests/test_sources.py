"""S4, K3 (batch), CSV export, K4 debug sinks, W3 supervision, P12, Kafka builders."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from bellwether import schemas
from bellwether.functions.sentiment import sentiment_struct
from bellwether.sources import files as FS
from bellwether.sources import kafka
from bellwether.streaming import runner

ROWS = [("t1", "s", "2024-01-01 10:00:00", "Positive", 0.5, "l1"),
        ("t2", "s", "2024-01-02 11:00:00", "Negative", -0.25, "l2")]


def test_history_append_read_and_day(spark, tmp_dir):
    path = os.path.join(tmp_dir, "hist")
    assert FS.read_history(spark, path).count() == 0            # missing -> empty, typed
    df = spark.createDataFrame(ROWS, schemas.HISTORY)
    FS.append_history(df, path)
    FS.append_history(df.limit(1), path)                         # appends, never rewrites
    assert FS.read_history(spark, path).count() == 3
    assert FS.read_history(spark, path, day="2024-01-02").count() == 1
    assert FS.read_history(spark, path).columns == [f.name for f in schemas.HISTORY.fields]


def test_csv_export_and_read(spark, tmp_dir):
    path = os.path.join(tmp_dir, "csv")
    assert FS.read_history_csv(spark, path).count() == 0
    FS.export_csv(spark.createDataFrame(ROWS, schemas.HISTORY), path)
    back = FS.read_history_csv(spark, path)
    assert sorted(tuple(r) for r in back.collect()) == sorted(ROWS)


def test_csv_round_trip_of_hard_titles(spark, tmp_dir):
    hard = [("a, b", "s", "2024-01-01 10:00:00", "Positive", 0.5, "l"), ('say "x"', " s ", "p", "Neutral", None, ""),
            ("two\nlines", "s", "p", "Negative", -1.0, "l"), ("", None, "p", "Neutral", 0.0, "back\\slash")]
    path = os.path.join(tmp_dir, "csv")
    FS.export_csv(spark.createDataFrame(hard, schemas.HISTORY), path)
    assert sorted(map(str, FS.read_history_csv(spark, path).collect())) == sorted(
        map(str, spark.createDataFrame(hard, schemas.HISTORY).collect()))


def test_csv_columns_are_found_by_name(spark, tmp_dir):
    """A file written by pandas: another column order, one column missing, one extra."""
    import pandas as pd
    path = os.path.join(tmp_dir, "hist")
    os.makedirs(path)
    pd.DataFrame({"title": ["a, b", "two\nlines"], "sentiment": ["Positive", "Neutral"], "source": ["s", 'q"q'],
                  "publishedAt": ["2024-01-01 10:00:00"] * 2, "confidence": [0.5, "n/a"], "extra": [1, 2]}
                 ).to_csv(os.path.join(path, "one.csv"), index=False)
    pd.DataFrame({"link": ["l"], "title": ["t"]}).to_csv(os.path.join(path, "two.csv"), index=False)
    got = sorted(tuple(r) for r in FS.read_history_csv(spark, path).collect())
    assert got == [("a, b", "s", "2024-01-01 10:00:00", "Positive", 0.5, ""), ("t", "", "", "", None, "l"),
                   ("two\nlines", 'q"q', "2024-01-01 10:00:00", "Neutral", None, "")]


def test_history_takes_any_column_order_and_days_can_be_reset(spark, tmp_dir):
    path = os.path.join(tmp_dir, "hist")
    df = spark.createDataFrame(ROWS, schemas.HISTORY)
    FS.append_history(df.select("link", "title", "publishedAt", "confidence", "sentiment", "source"), path)   # P20
    FS.overwrite_days(df.limit(1).withColumn("title", F.lit("new")), path)                                    # K5
    assert sorted(r["title"] for r in FS.read_history(spark, path).collect()) == ["new", "t2"]


def test_read_position(spark, tmp_dir):
    """S3: resume behind what was read; partitions move by themselves."""
    from bellwether.sources import cursor
    path = os.path.join(tmp_dir, "position")
    recs = spark.createDataFrame([(0, 5, "a"), (0, 9, "b"), (1, 2, "c")], schemas.TOPIC_RECORD)
    assert cursor.load(spark, path) == {} and cursor.unread(recs, {}).count() == 3
    at = cursor.commit(spark, path, recs.where("offset < 9"), {})
    assert at == {0: 6, 1: 3} == cursor.load(spark, path)
    assert [r["value"] for r in cursor.unread(recs, at).collect()] == ["b"]
    assert cursor.commit(spark, path, recs.where("value = 'b'"), at) == {0: 10, 1: 3} == cursor.load(spark, path)
    assert cursor.as_kafka_offsets("t", at) == '{"t": {"0": 6, "1": 3}}' and cursor.as_kafka_offsets("t", {}) == "earliest"


def test_sentiment_struct(spark):
    r = spark.range(1).select(sentiment_struct(F.lit("Positive"), F.lit(0.25)).alias("s")).collect()[0]
    assert r["s"]["sentiment"] == "Positive" and r["s"]["confidence"] == 0.25


def test_debug_sinks_and_supervision(spark, tmp_dir):
    src = os.path.join(tmp_dir, "raw")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write('{"title":"x","sentiment":""}\n')
    raw = FS.read_raw_stream(spark, src)
    parsed = raw.select(F.from_json("value", schemas.SCORED).alias("d")).select("d.*")
    qs = runner.debug_queries(raw, parsed)
    try:
        for q in qs:
            q.processAllAvailable()
        names = {n for n, _ in runner.active_status(spark)}
        assert {"debug_raw", "debug_bad_sentiment", "debug_titles"} <= names
        spark.streams.resetTerminated()        # forget queries of earlier tests
        assert runner.await_any(spark, 0.1) is False
    finally:
        for q in qs:
            q.stop()


def test_kafka_builders_need_the_connector(spark):
    # Without the connector jar the source is not found; the options are
    # still assembled without touching a broker.
    with pytest.raises(AnalysisException):
        kafka.read_news_stream(spark, "broker:9092")
    with pytest.raises(AnalysisException):
        kafka.read_scored_bounded(spark, "broker:9092")


def test_kafka_writers_need_the_connector(spark, tmp_dir):
    from pyspark.errors import PySparkException
    from py4j.protocol import Py4JJavaError
    msgs = spark.createDataFrame(ROWS, schemas.HISTORY)
    with pytest.raises((AnalysisException, PySparkException, Py4JJavaError)):
        kafka.publish_news(msgs, "broker:9092")
    os.makedirs(os.path.join(tmp_dir, "in"))
    values = FS.read_raw_stream(spark, os.path.join(tmp_dir, "in"))
    with pytest.raises((AnalysisException, PySparkException, Py4JJavaError)):
        kafka.write_scored_stream(values, "broker:9092", os.path.join(tmp_dir, "ck")).start()
