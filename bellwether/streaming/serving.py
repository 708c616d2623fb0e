"""Consumer-side streams: S5 -> F1 -> D2 -> P16 -> K3, and the X1 trend.

D2 in stream form comes in two ways:

* ``history_stream`` (default): each micro-batch is de-duplicated with the
  batch operator (partial aggregation before the shuffle, so a headline
  repeated in a third of all messages costs one record per task), then its
  128-bit keys of (title, publishedAt) are looked up in the key index of the
  history (``sources.keys``) and the rows of the keys found are left out.  ``day`` is derived from
  ``publishedAt``, so an earlier copy of a key can only sit in the same day:
  the join reads the keys of the batch's days.  The dedupe is exact for all
  time and needs no state store.  A batch's new rows do not depend on what
  the batch itself has written before, so a retried batch writes its keys
  and facets again (in place) and only the history rows still missing.
* ``deduped_scored``: ``dropDuplicatesWithinWatermark`` with its own long
  delay (headlines return with every hourly fetch, so keys must be kept far
  longer than the 10-minute event watermark); state bounded by time, but
  every copy of a headline goes to one state partition.  For sinks other
  than the history table; its undated rows are those of ``undated_scored``.

Both take the first arrival: the record with the least offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from bellwether import constants as K
from bellwether import schemas
from bellwether.functions.parsing import bytes_to_string, lenient_timestamp, parse_json
from bellwether.operators import facets
from bellwether.operators.serving import first_per_key, has_required_keys, to_served, to_served_columns
from bellwether.operators.timeline import trend
from bellwether.sources.deltas import DeltaTable, stream_id
from bellwether.sources.keys import BASE, KeyIndex, day_filter
from bellwether.session import land
from bellwether.sources.files import (STORED_HISTORY, append_history, delete, ensure_folder, history_sink, path_exists, with_day,
                                      with_key)

ARRIVAL = ("offset", "partition")


def parse_scored(raw: DataFrame) -> DataFrame:
    """S5 + P1/P2: scored records to columns, with their position."""
    data = parse_json(bytes_to_string(F.col("value")), schemas.SCORED)
    return raw.select("partition", "offset", data.alias("d")).select("partition", "offset", "d.*")


def deduped_scored(raw: DataFrame, delay: str = K.DEDUPE_DELAY) -> DataFrame:
    """F1 then D2 (stream form) on the scored records.

    Rows without an event time cannot be placed against the watermark; they
    are ``undated_scored``, which goes to a sink of its own.
    """
    valid = parse_scored(raw).filter(has_required_keys() & F.col("fetched_at_ts").isNotNull())
    return (valid.withWatermark("fetched_at_ts", delay)
            .dropDuplicatesWithinWatermark(["title", "publishedAt"]))


def undated_scored(raw: DataFrame) -> DataFrame:
    """The valid records that have no event time."""
    return parse_scored(raw).filter(has_required_keys() & F.col("fetched_at_ts").isNull())


def not_in_history(rows: DataFrame, path: str, days: Column) -> DataFrame:
    """Rows (with ``key``) that are not among the history's rows of these days."""
    spark = rows.sparkSession
    if not path_exists(spark, path):
        return rows
    seen = spark.read.schema(STORED_HISTORY).parquet(path).filter(days).select("key")
    return rows.join(seen, "key", "left_anti")


def key_index(spark: SparkSession, path: str) -> KeyIndex:
    """The key index of the history at ``path``, made from its rows if there is none yet."""
    where = f"{path.rstrip('/')}-keys"
    index = KeyIndex(spark, where)
    if not path_exists(spark, f"{where}/ready"):               # new, or its making was cut short
        if path_exists(spark, path):
            index.write(spark.read.schema(STORED_HISTORY).parquet(path).select("key", "day").distinct(), BASE, 0)
        ensure_folder(spark, f"{where}/ready")
    return index


def facet_table(spark: SparkSession, path: str) -> DeltaTable:
    """The facets of the history at ``path``, counted from its rows if there are none yet."""
    where = f"{path.rstrip('/')}-facets"
    if not path_exists(spark, f"{where}/ready"):               # new, or their making was cut short
        if path_exists(spark, path):
            recount(spark, path)
        ensure_folder(spark, f"{where}/ready")
    return DeltaTable(spark, where, facets.SCHEMA)


def recount(spark: SparkSession, path: str) -> None:
    """Count the facets anew from the whole history (after days were overwritten or expired)."""
    rows = spark.read.schema(STORED_HISTORY).parquet(path)
    DeltaTable(spark, f"{path.rstrip('/')}-facets", facets.SCHEMA).compact(
        facets.fold, replace=facets.partial(rows, order_col=None))


EXPIRED = "day date, n long, horizon date, logged_at timestamp"


def expire_days(spark: SparkSession, path: str, keep_days: int, log: str, dry_run: bool = True,
                today: str | None = None) -> DataFrame:
    """K6, K5: drop the day partitions of the history that lie before ``today`` less ``keep_days``.

    The days and their row counts (from the facets) are listed first and
    returned; a dry run stops there.  Else the list is logged, the folders
    are deleted, and the facets are folded without these days.  Keys stay in
    the index, so an expired headline that comes again is not new.  Undated
    rows are kept.  A run that dies half-way is finished by the next one.
    """
    today = F.to_date(F.lit(today)) if today else F.current_date()
    table = facet_table(spark, path)
    old = F.col("day") < F.date_sub(today, keep_days)
    found = table.read().where(old).groupBy("day").agg(F.sum("n").alias("n")).select(
        "day", "n", F.date_sub(today, keep_days).alias("horizon"), F.current_timestamp().alias("logged_at"))
    listed = land(found.orderBy("day").coalesce(1), "expired")                  # one row per day
    if dry_run:
        return listed
    listed.write.mode("append").parquet(log)
    for r in listed.collect():
        delete(spark, f"{path.rstrip('/')}/day={r['day']}")
    table.compact(lambda rows: facets.fold(rows.where(~F.coalesce(old, F.lit(False)))), everything=True)
    return listed


def history_stream(raw: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """K3: valid rows, new to the history, rounded, appended per micro-batch; its keys and facets with them."""
    valid = parse_scored(raw).filter(has_required_keys())

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = stream_id(spark, checkpoint)
        first = first_per_key(batch, ["title", "publishedAt"], list(ARRIVAL))
        served = first.select("offset", "fetched_at_ts", *to_served_columns())
        rows = with_key(with_day(served)).persist()                # read for its days, then for its new rows
        new = None
        try:
            index, counts = key_index(spark, path), facet_table(spark, path)
            days = day_filter(rows)
            again = index.started(stream, batch_id)
            new = index.landed_unseen(rows, days, stream, batch_id).persist()       # written three times
            index.write(new, stream, batch_id)
            append_history(not_in_history(new, path, days) if again else new, path)
            counts.write(facets.partial(new), stream, batch_id)
        finally:
            rows.unpersist()
            if new is not None:
                new.unpersist()

    return valid.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)


def history_as_stream(spark: SparkSession, path: str) -> DataFrame:
    """The history as it grows, each headline once: ``title``, ``ts``, ``sentiment``, ``confidence``.

    ``ts`` is the time of the fetch (the event time of the original's
    watermark), or that of publication for a message without one.  It is
    null where neither can be read or it lies more than a day ahead (it
    would move the watermark past all others).
    """
    rows = spark.readStream.schema(STORED_HISTORY).parquet(path)
    ts = F.coalesce("fetched_at_ts", lenient_timestamp("publishedAt"))
    near = ts <= F.current_timestamp() + F.expr("INTERVAL 1 DAY")
    return rows.select("title", F.when(near, ts).alias("ts"), "sentiment", "confidence")


def history_stream_stateful(raw: DataFrame, path: str, checkpoint: str,
                            delay: str = K.DEDUPE_DELAY) -> DataStreamWriter:
    """K3 with the state-store dedupe (``deduped_scored``) and Spark's file sink."""
    return history_sink(to_served(deduped_scored(raw, delay)), path, checkpoint)


def trend_stream(scored: DataFrame, path: str, checkpoint: str, ts_col: str = "fetched_at_ts",
                 label_col: str = "sentiment", value_col: str = "confidence",
                 width: str = "1 hour", delay: str = K.WATERMARK_DELAY) -> DataStreamWriter:
    """X1 (stream): windowed counts per label (append mode).

    A window is written once the watermark passes its end, so the windows
    that are open when the stream stops are not in the table yet.  Late rows
    are dropped by the watermark (W1, W4); ``runner.rows_dropped`` counts
    them from the recorded progress.
    """
    agg = trend(scored.withWatermark(ts_col, delay), ts_col, label_col, value_col, width)
    return (agg.writeStream.format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).outputMode("append"))
