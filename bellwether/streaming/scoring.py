"""The scoring stream: raw news records in, scored JSON records out.

S1 -> P1, P2 -> P3 -> W1 -> (per micro-batch) quarantine, P9-P11 -> P12-P15
-> K1.  Scoring is a projection of each row; ``foreachBatch`` serves the two
outputs (scores and quarantine) from one persisted batch.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from bellwether import constants as K
from bellwether import schemas
from bellwether.functions.parsing import bytes_to_string, epoch_to_timestamp, is_all_null, parse_json
from bellwether.operators.scoring import Scorer, make_scorer, score_text

BatchSink = Callable[[DataFrame, int], None]

# How far an event time may lie ahead of the time of ingestion.  One such row
# (milliseconds taken for seconds, say) would move the watermark past all others.
MAX_AHEAD = "1 day"


def parse_news(raw: DataFrame, now: Column | None = None) -> DataFrame:
    """Decode, parse with the message schema, derive event time.

    ``reason`` tells why a record cannot be used: it parses to nothing (probe
    messages, text that is not JSON, empty values), or its ``fetched_at`` is
    no time or lies more than ``MAX_AHEAD`` after ``now``.  The raw value and
    its position stay next to it.
    """
    position = [c for c in ("partition", "offset") if c in raw.columns]
    value = bytes_to_string(F.col("value"))
    data = parse_json(value, schemas.NEWS)
    parsed = raw.select(*position, value.alias("value"), data.alias("data")).select(
        *position, "value", "data.*",
        (F.col("data").isNull() | is_all_null("data", schemas.NEWS)).alias("__junk"),
    ).withColumn("fetched_at_ts", epoch_to_timestamp("fetched_at"))
    latest = (F.current_timestamp() if now is None else now) + F.expr(f"INTERVAL {MAX_AHEAD}")
    reason = (F.when(F.col("__junk"), F.lit("not a news message"))
              .when(F.col("fetched_at").isNotNull() & F.col("fetched_at_ts").isNull(),
                    F.lit("fetched_at is no time"))
              .when(F.col("fetched_at_ts") > latest, F.lit("fetched_at lies in the future")))
    return (parsed.withColumn("reason", reason).drop("__junk")
            .withColumn("fetched_at_ts", F.when(F.col("reason").isNull(), F.col("fetched_at_ts"))))


def scored_values(scored: DataFrame) -> DataFrame:
    """The scored record as one JSON ``value`` (null fields omitted), after its ``key`` if it has one."""
    key = ["key"] if "key" in scored.columns else []
    return scored.select(*key, F.to_json(F.struct(
        "title", "source", "publishedAt", "link", "fetched_at", "sentiment",
        F.col("confidence").cast("float").alias("confidence"), "fetched_at_ts")).alias("value"))


def record_key(parsed: DataFrame) -> Column:
    """K1: what a scored record is known by, the same whenever its batch is run again.

    The position of the raw record it comes from; without positions (raw
    files) a digest of the raw message, so equal messages are one record.
    """
    if {"partition", "offset"} <= set(parsed.columns):
        return F.concat_ws("-", F.col("partition").cast("string"), F.col("offset").cast("string"))
    return F.md5(F.coalesce("value", F.lit("")))


def score_batch(parsed: DataFrame, scorer: Scorer | None = None) -> DataFrame:
    """Score the usable messages of one batch (text in ``title``); ``key`` is the record's."""
    good = parsed.withColumn("key", record_key(parsed)).filter(F.col("reason").isNull()).drop(
        "reason", "value", "partition", "offset")
    return score_text(good, "title", scorer=scorer)


def set_aside(parsed: DataFrame) -> DataFrame:
    """The records that cannot be used: position (if known), original value and reason."""
    position = [c for c in ("partition", "offset") if c in parsed.columns]
    return parsed.filter(F.col("reason").isNotNull()).select(*position, "value", "reason")


def scoring_stream(raw: DataFrame, sink: BatchSink, checkpoint: str, quarantine: BatchSink,
                   lexicon=None, boosters=None, negations=None) -> DataStreamWriter:
    """Build the scoring query (call ``.trigger(...).start()`` on the result).

    ``sink(values_df, batch_id)`` receives the JSON values of each batch;
    ``quarantine`` the records set aside.  The scorer's tables are checked
    once, here.  W2: progress lives in ``checkpoint`` and is kept across
    restarts (never wiped at start).

    W1: the 10-minute watermark on ``fetched_at_ts`` is declared here as in
    the original, where no stateful operator follows it and nothing is
    dropped; scoring is stateless.  It takes effect in the windowed trend
    (``trend_stream``), which applies the same delay to its event time.
    """
    scorer = make_scorer(lexicon, boosters, negations)
    parsed = observe_counts(parse_news(raw).withWatermark("fetched_at_ts", K.WATERMARK_DELAY))

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()       # read twice: scored output and quarantine
        try:
            sink(scored_values(score_batch(batch, scorer)), batch_id)
            quarantine(set_aside(batch), batch_id)
        finally:
            batch.unpersist()

    return (parsed.writeStream.foreachBatch(run)
            .option("checkpointLocation", checkpoint))


METRICS_NAME = "scoring_metrics"


def observe_counts(parsed: DataFrame) -> DataFrame:
    """A4 (stream): per-batch totals of records and usable messages, reported
    in each progress event under ``observedMetrics[METRICS_NAME]``."""
    return parsed.observe(METRICS_NAME,
                          F.count(F.lit(1)).alias("n_records"),
                          F.count_if(F.col("reason").isNull()).alias("n_messages"))


def folder_sink(folder: str) -> BatchSink:
    """Stand-in for K1: each batch goes to ``folder/batch=<id>``.

    A ``value`` column (and its ``key``) becomes a topic stand-in (JSON lines
    with a position that rises from batch to batch), anything else parquet.
    A retried batch overwrites its own folder, so output is written once.
    """
    def write(df: DataFrame, batch_id: int) -> None:
        target = f"{folder.rstrip('/')}/batch={batch_id}"
        if df.columns[-1:] == ["value"] and set(df.columns) <= {"key", "value"}:
            offset = F.lit(batch_id).cast("long") * F.lit(1 << 44) + F.monotonically_increasing_id()
            df.select(F.lit(0).alias("partition"), offset.alias("offset"), *df.columns).write.mode(
                "overwrite").json(target)
        else:
            df.write.mode("overwrite").parquet(target)
    return write
