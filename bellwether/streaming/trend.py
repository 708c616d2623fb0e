"""X1 kept up as it goes: windows that are still open, and late rows that are not lost.

* ``open_trend_stream``: the windowed aggregate in ``update`` mode.  Each
  batch's changed windows are written with the batch's number, and the table
  is each window's newest version: after every batch it equals the batch
  form over all rows so far.
* ``late_trend_stream``: each batch is split by the watermark recorded for
  the batches before it.  Rows whose window had closed by then go to a side
  table as they are; the others are aggregated.  ``merged_trend`` adds the
  late rows to their closed windows, so on-time and late rows together are
  the input.  The watermark, the split and both outputs belong to a batch
  number, so a batch that is run again writes the same once more in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from bellwether import constants as K
from bellwether.operators.timeline import trend
from bellwether.sources.deltas import DeltaTable, stream_id

_WINDOW = ("window_start", "window_end")


def _sum_type(value: T.DataType) -> T.DataType:
    """The type of a sum over ``value``."""
    if isinstance(value, T.DecimalType):
        return T.DecimalType(min(value.precision + 10, 38), value.scale)
    return T.DoubleType() if isinstance(value, (T.FloatType, T.DoubleType)) else T.LongType()


def partial_schema(label_col: str, value: T.DataType) -> T.StructType:
    return T.StructType([*[T.StructField(c, T.TimestampType()) for c in _WINDOW], T.StructField(label_col, T.StringType()),
                         T.StructField("n", T.LongType()), T.StructField("sum_value", _sum_type(value))])


def _mean(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_value", F.col("sum_value").cast("double") / F.col("n"))


# ---- open windows (update mode) ----------------------------------------------------
def _versions(spark: SparkSession, path: str, label_col: str, value: T.DataType) -> DeltaTable:
    schema = partial_schema(label_col, value)
    return DeltaTable(spark, path, T.StructType([*schema.fields, T.StructField("seq", T.LongType())]))


def _newest(versions: DataFrame, label_col: str) -> DataFrame:
    """Each window's row of the last batch that changed it."""
    return versions.groupBy(*_WINDOW, label_col).agg(
        F.max_by(F.struct("n", "sum_value"), "seq").alias("last"), F.max("seq").alias("seq")).select(
        *_WINDOW, label_col, "last.n", "last.sum_value", "seq")


def open_trend_stream(scored: DataFrame, path: str, checkpoint: str, ts_col: str = "fetched_at_ts",
                      label_col: str = "sentiment", value_col: str = "confidence",
                      width: str = "1 hour", delay: str = K.WATERMARK_DELAY) -> DataStreamWriter:
    """X1 in update mode, upserted by window (one checkpoint to a table)."""
    agg = trend(scored.withWatermark(ts_col, delay), ts_col, label_col, value_col, width)
    value = scored.schema[value_col].dataType

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _versions(spark, path, label_col, value).write(
            batch.withColumn("seq", F.lit(batch_id)), stream_id(spark, checkpoint), batch_id)

    return agg.writeStream.outputMode("update").foreachBatch(run).option("checkpointLocation", checkpoint)


def open_trend(spark: SparkSession, path: str, label_col: str, value: T.DataType) -> DataFrame:
    """The trend with its open windows, as of the last batch."""
    return _mean(_newest(_versions(spark, path, label_col, value).read(), label_col).drop("seq"))


def compact_open_trend(spark: SparkSession, path: str, label_col: str, value: T.DataType) -> None:
    _versions(spark, path, label_col, value).compact(lambda rows: _newest(rows, label_col))


# ---- late rows kept ---------------------------------------------------------------
MARKS = T.StructType([T.StructField("stream", T.StringType()), T.StructField("batch", T.LongType()),
                      T.StructField("latest", T.TimestampType())])


class LateTrend:
    """The tables of ``late_trend_stream`` under one path: ``partials``, ``late`` and ``marks``."""

    def __init__(self, spark: SparkSession, path: str, rows: T.StructType, ts_col: str, label_col: str, value_col: str,
                 width: str = "1 hour", delay: str = K.WATERMARK_DELAY):
        self.spark, self.ts_col, self.label_col, self.value_col = spark, ts_col, label_col, value_col
        self.width, self.delay = width, delay
        root = path.rstrip("/")
        self.partials = DeltaTable(spark, f"{root}/partials", partial_schema(label_col, rows[value_col].dataType))
        self.late = DeltaTable(spark, f"{root}/late", T.StructType([
            *rows.fields, T.StructField("late_watermark", T.TimestampType())]))
        self.marks = DeltaTable(spark, f"{root}/marks", MARKS)

    def watermark(self, stream: str, batch: int) -> str | None:
        """The recorded watermark for a batch: the latest event time of the batches before it, less the delay."""
        before = self.marks.read().where((F.col("stream") == stream) & (F.col("batch") < batch))
        return before.agg((F.max("latest") - F.expr(f"INTERVAL {self.delay}")).cast("string")).first()[0]

    def _partial(self, rows: DataFrame) -> DataFrame:
        return trend(rows, self.ts_col, self.label_col, self.value_col, self.width).drop("avg_value")

    def add(self, rows: DataFrame, stream: str, batch: int) -> None:
        """Split one batch, aggregate what is on time, keep the rest."""
        mark = F.lit(self.watermark(stream, batch)).cast("timestamp")
        # rows without a time have no window; they are kept with the late ones (a window of null would drop them)
        closes = F.window(F.coalesce(F.col(self.ts_col), F.timestamp_seconds(F.lit(0))), self.width).getField("end")
        marked = rows.withColumn("late_watermark", mark).withColumn("__end", closes)
        late = F.col(self.ts_col).isNull() | F.coalesce(F.col("__end") <= F.col("late_watermark"), F.lit(False))
        marked = marked.withColumn("__late", late).drop("__end").persist()        # read three times
        try:
            self.late.write(marked.where("__late"), stream, batch)
            self.partials.write(self._partial(marked.where("NOT __late")), stream, batch)
            latest = marked.agg(F.max(self.ts_col).cast("timestamp").alias("latest"))
            self.marks.write(latest.select(F.lit(stream).alias("stream"), F.lit(batch).cast("long").alias("batch"), "latest"),
                             stream, batch)
        finally:
            marked.unpersist()

    def _sums(self, rows: DataFrame) -> DataFrame:
        kind = self.partials.schema["sum_value"].dataType
        return rows.groupBy(*_WINDOW, self.label_col).agg(
            F.sum("n").alias("n"), F.sum("sum_value").cast(kind).alias("sum_value"))

    def on_time(self) -> DataFrame:
        """The trend of the rows that came in time, open windows included."""
        return _mean(self._sums(self.partials.read()))

    def merged(self) -> DataFrame:
        """The trend of all rows that have a time: the late ones are added to their closed windows."""
        late = self._partial(self.late.read().where(F.col(self.ts_col).isNotNull()))
        kind = self.partials.schema["sum_value"].dataType
        late = late.withColumn("sum_value", F.col("sum_value").cast(kind))
        return _mean(self._sums(self.partials.read().unionByName(late)))

    def compact(self) -> None:
        """Fold the batches of all three tables (late rows stay rows)."""
        self.partials.compact(self._sums)
        self.late.compact(lambda rows: rows)
        self.marks.compact(lambda rows: rows.groupBy("stream").agg(F.max("batch").alias("batch"), F.max("latest").alias("latest")))


def late_trend_stream(scored: DataFrame, path: str, checkpoint: str, ts_col: str = "fetched_at_ts",
                      label_col: str = "sentiment", value_col: str = "confidence",
                      width: str = "1 hour", delay: str = K.WATERMARK_DELAY) -> DataStreamWriter:
    """X1 with late rows kept (see ``LateTrend``)."""
    schema = scored.schema

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        LateTrend(spark, path, schema, ts_col, label_col, value_col, width, delay).add(
            batch, stream_id(spark, checkpoint), batch_id)

    return scored.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
