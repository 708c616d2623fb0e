"""Hot keys: one title / label / source holding a third of all rows."""

from pyspark.sql import functions as F

from bellwether.operators import serving, timeline


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot_frame(spark, n=3000):
    return (spark.range(n).select(
        F.col("id").alias("offset"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("title"),
        F.lit("2024-01-01 00:00:00").alias("publishedAt"),
        F.when(F.col("id") % 3 == 0, F.lit("src-hot")).otherwise(F.lit("src")).alias("source"),
        F.when(F.col("id") % 3 == 0, F.lit("Negative")).otherwise(F.lit("Neutral")).alias("sentiment"),
        F.lit(0.0).alias("confidence"), F.lit("l").alias("link"))
        .repartition(6))


def test_hot_title_dedupe(spark):
    df = hot_frame(spark)
    out = serving.dedupe_title_published(df)
    rows = {r["title"]: r["offset"] for r in out.collect()}
    assert rows["hot"] == 0 and len(rows) == 1 + 2000
    assert "partial_min" in _plan(out)


def test_hot_groupings_are_partial_first(spark):
    df = hot_frame(spark)
    for out in (serving.sentiment_counts(df), serving.distinct_sources(df, "offset"),
                timeline.trend(df.withColumn("ts", F.to_timestamp("publishedAt")), "ts",
                               "sentiment", "confidence")):
        plan = _plan(out)
        assert "partial_" in plan
    counts = {r["sentiment"]: r["n"] for r in serving.sentiment_counts(df).collect()}
    assert counts == {"Positive": 0, "Negative": 1000, "Neutral": 2000}
