"""Schemas of every message and table the pipeline passes around."""

from __future__ import annotations

from pyspark.sql import types as T

# Normalised news message on the raw topic.
NEWS = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("publishedAt", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("fetched_at", T.DoubleType()),
])

# The sentiment result carried next to each message.
SENTIMENT_RESULT = T.StructType([
    T.StructField("sentiment", T.StringType()),
    T.StructField("confidence", T.FloatType()),
])

# Scored message on the scored topic (JSON, null fields omitted).
SCORED = T.StructType(NEWS.fields + [
    T.StructField("sentiment", T.StringType()),
    T.StructField("confidence", T.FloatType()),
    T.StructField("fetched_at_ts", T.TimestampType()),
])

# One history row; stored partitioned by `day`.
HISTORY = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("publishedAt", T.StringType()),
    T.StructField("sentiment", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("link", T.StringType()),
])

# A landed headline API response for one country (country fields are ours).
ARTICLE = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("publishedAt", T.StringType()),
    T.StructField("source", T.StructType([T.StructField("name", T.StringType())])),
])
ENVELOPE = T.StructType([
    T.StructField("country", T.StringType()),
    T.StructField("country_rank", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("articles", T.ArrayType(ARTICLE)),
])

# Bounded-read stand-in for a topic: one row per record.
TOPIC_RECORD = T.StructType([
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("value", T.StringType()),
])

# The same with the key that tells repeated records (K1).
KEYED_RECORD = T.StructType([*TOPIC_RECORD.fields, T.StructField("key", T.StringType())])

# Scorer tables.
LEXICON = T.StructType([
    T.StructField("token", T.StringType(), False),
    T.StructField("valence", T.DecimalType(8, 3), False),
])
BOOSTER = T.StructType([
    T.StructField("token", T.StringType(), False),
    T.StructField("inc", T.DecimalType(8, 3), False),
])
NEGATION = T.StructType([T.StructField("token", T.StringType(), False)])
