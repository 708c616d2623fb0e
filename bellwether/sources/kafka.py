"""Topic sources and sinks: S1, S3, S5, K1, K2.

Written against Spark's Kafka connector options.  The connector jar must
match the Spark build (Scala 2.13 for Spark 4), e.g. submitted with
``--packages org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version>``.
It is not bundled here, so tests drive the same pipelines through the file
stand-ins in ``bellwether.sources.files``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from bellwether.constants import NEWS_TOPIC, SCORED_TOPIC


def read_news_stream(spark: SparkSession, bootstrap: str, topic: str = NEWS_TOPIC,
                     starting_offsets: str = "earliest",
                     max_offsets_per_trigger: int | None = None) -> DataFrame:
    """The raw news topic as a stream of ``key, value, ..., timestamp``.

    ``failOnDataLoss=false`` is a source option: offsets lost to topic
    retention are skipped instead of failing the query.  D3: batch sizes are
    set by the trigger interval and ``max_offsets_per_trigger`` (not by
    10-row buffers).
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", "false"))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    return reader.load()


def read_scored_stream(spark: SparkSession, bootstrap: str, topic: str = SCORED_TOPIC,
                       max_offsets_per_trigger: int | None = None) -> DataFrame:
    """The scored topic as a stream; progress lives in the checkpoint."""
    return read_news_stream(spark, bootstrap, topic, "earliest", max_offsets_per_trigger)


def read_scored_bounded(spark: SparkSession, bootstrap: str, topic: str = SCORED_TOPIC,
                        starting_offsets: str = "earliest",
                        ending_offsets: str = "latest") -> DataFrame:
    """S3: a bounded batch read of the scored topic (``partition, offset, value``)."""
    return (spark.read.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .option("endingOffsets", ending_offsets)
            .load()
            .select("partition", "offset", F.col("value").cast("string").alias("value"),
                    F.col("key").cast("string").alias("key")))


def kafka_sink(df: DataFrame, bootstrap: str, topic: str = SCORED_TOPIC) -> None:
    """K1 per micro-batch (for ``foreachBatch``): write ``value``, and ``key`` where there is one.

    Kafka writes are at-least-once: a retried batch may repeat records.  They
    have the key of the first time, so readers can skip them
    (``serving.skip_repeats``); the history's dedupe (D2) does anyway.
    """
    (df.select(*[c for c in ("key", "value") if c in df.columns]).write.format("kafka")
     .option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save())


def write_scored_stream(values: DataFrame, bootstrap: str, checkpoint: str,
                        topic: str = SCORED_TOPIC) -> DataStreamWriter:
    """K1: stream a single ``value`` column to the scored topic, checkpointed."""
    return (values.select("value").writeStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .option("topic", topic)
            .option("checkpointLocation", checkpoint))


def publish_news(messages: DataFrame, bootstrap: str, topic: str = NEWS_TOPIC) -> None:
    """K2: publish normalised messages as JSON values (batch).

    The record timestamp cannot be set from a column by this sink, so the
    event time stays in the payload (``publishedAt``, UTC).
    """
    (messages.select(F.to_json(F.struct(*messages.columns)).alias("value"))
     .write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
     .option("topic", topic).save())
