"""K4 debug sinks, W3 query supervision, A4 and W4 from recorded progress."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from bellwether.sources.files import delete, list_folder


def debug_queries(raw: DataFrame, parsed_scored: DataFrame | None = None) -> list[StreamingQuery]:
    """K4: console views of the raw records and of bad sentiment results.

    Off the main path: start these only when debugging, each is a separate
    query that reads the source again.
    """
    queries = [
        raw.select(F.col("key").cast("string") if "key" in raw.columns else F.lit(None).alias("key"),
                   F.col("value").cast("string").alias("value"))
        .writeStream.format("console").option("numRows", 5).queryName("debug_raw").start(),
    ]
    if parsed_scored is not None:
        bad = parsed_scored.filter(F.col("sentiment").isNull() | (F.col("sentiment") == ""))
        queries.append(bad.select("title", "sentiment").writeStream.format("console")
                       .option("truncate", False).option("numRows", 50)
                       .queryName("debug_bad_sentiment").start())
        queries.append(parsed_scored.select("title", "sentiment").writeStream.format("console")
                       .option("truncate", False).queryName("debug_titles").start())
    return queries


def active_status(spark: SparkSession) -> list[tuple[str | None, str]]:
    """Name and status message of every active query."""
    return [(q.name, q.status["message"]) for q in spark.streams.active]


def await_any(spark: SparkSession, timeout_s: float | None = None) -> bool:
    """Block until any query ends (or the timeout passes)."""
    if timeout_s is None:
        spark.streams.awaitAnyTermination()
        return True
    return bool(spark.streams.awaitAnyTermination(timeout_s))


PROGRESS = ("query_id string, run_id string, batch_id long, num_input_rows long, rows_dropped long, "
            "observed map<string, map<string, long>>")


class ProgressLog(StreamingQueryListener):
    """Appends every progress event of the session's streams to a table.

    A query keeps only its last progress events; the table keeps all of
    them, so totals over a long run are totals over all its batches.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        observed = {name: {k: int(v) for k, v in row.asDict().items() if v is not None}
                    for name, row in p.observedMetrics.items()}
        dropped = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
        row = (str(p.id), str(p.runId), p.batchId, p.numInputRows, dropped, observed)
        self.spark.createDataFrame([row], PROGRESS).coalesce(1).write.mode("append").parquet(self.path)


def log_progress(spark: SparkSession, path: str) -> ProgressLog:
    """Start recording (stop with ``spark.streams.removeListener``)."""
    log = ProgressLog(spark, path)
    spark.streams.addListener(log)
    return log


def progress_table(spark: SparkSession, path: str) -> DataFrame:
    """All recorded progress, one row per batch and run."""
    found = list_folder(spark, path)
    if not found:
        return spark.createDataFrame([], PROGRESS)
    merged = [n for n in found if n.startswith("merged-")]
    newest = max(merged, key=lambda n: int(n.split("-")[1]), default=None)
    held = [f"{path}/{n}" for n in found if n not in merged] + ([f"{path}/{newest}"] if newest else [])
    # a crash between the steps of a compaction leaves events twice, which are one event
    return spark.read.schema(PROGRESS).option("recursiveFileLookup", "true").parquet(*held).dropDuplicates(
        ["query_id", "run_id", "batch_id"]) if merged else spark.read.schema(PROGRESS).parquet(path)


def compact_progress(spark: SparkSession, path: str) -> None:
    """Rewrite the one-event files of the log as one file."""
    found = list_folder(spark, path)
    if len(found) < 2:
        return
    merged = [int(n.split("-")[1]) for n in found if n.startswith("merged-")]
    progress_table(spark, path).coalesce(1).write.parquet(f"{path}/merged-{max(merged, default=0) + 1}")
    for name in found:
        delete(spark, f"{path}/{name}")


def progress_metrics(progress: DataFrame, name: str, *metrics: str) -> DataFrame:
    """A4: the observed metrics of every recorded batch that has them."""
    values = F.col("observed").getItem(name)
    return progress.filter(values.isNotNull()).select(
        "query_id", "batch_id", "num_input_rows", *[values.getItem(m).alias(m) for m in metrics])


def rows_dropped(progress: DataFrame, query_id: str | None = None) -> DataFrame:
    """Late rows that stateful operators dropped, over all recorded batches."""
    some = progress if query_id is None else progress.filter(F.col("query_id") == F.lit(query_id))
    return some.agg(F.coalesce(F.sum("rows_dropped"), F.lit(0)).alias("rows_dropped"))


def wait_for_batches(spark: SparkSession, path: str, query: StreamingQuery, timeout_s: float = 60.0) -> DataFrame:
    """The progress table once it has the last batch of a query that has ended (events arrive after it)."""
    last = query.lastProgress
    until = time.monotonic() + timeout_s
    while True:
        table = progress_table(spark, path)
        if last is None or table.filter((F.col("run_id") == F.lit(str(last["runId"]))) & (
                F.col("batch_id") == F.lit(last["batchId"]))).limit(1).count() or time.monotonic() > until:
            return table
        time.sleep(0.2)
