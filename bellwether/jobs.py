"""Runnable jobs (what ``spark-submit`` starts).

    python -m bellwether.jobs stream --source kafka --bootstrap host:9092 --root <shared folder>
    python -m bellwether.jobs stream --source files --raw <folder> --root <shared folder> --once
    python -m bellwether.jobs ingest --envelopes <folder of JSON responses> --root <shared folder> [--bootstrap host:9092]
    python -m bellwether.jobs serve --root <shared folder> [--label Negative] [--sources a,b] [--bootstrap host:9092]
    python -m bellwether.jobs maintain --root <shared folder> [--keep-days 365] [--expire]

``stream`` runs three queries side by side and waits on any of them (W3):

* scoring:  raw news -> P1-P3, W1 -> lexicon scoring per batch -> P15 -> scored topic (K1)
* history:  scored topic -> F1 -> D2 -> P16, P17 -> day-partitioned history (K3)
* trend:    history, each headline once -> X1 windowed counts per label by fetch time, open windows
            included; late rows are kept aside and added to their windows when the trend is read

``ingest`` turns landed API responses into news messages (S2, U1, D1, P4, P5,
P8, F2) and publishes them (K2), or appends them to the raw folder.
``serve`` makes the dashboard's tables: the latest batch of the scored topic
(S3, O3) and the history (S4), each as counts, filtered cards and row count
(P18, A1, F4, F5, A3, O2, P19); the history's numbers come from its facets,
its cards by pages.  ``maintain`` compacts the per-batch tables and expires
old days (K6).

All progress lives under ``--root`` (checkpoints, history, trend, progress
log, positions, and with ``--source files`` the scored-topic stand-in),
which must be a folder every executor can reach; it defaults to
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bellwether import constants as K
from bellwether import schemas
from bellwether.operators import facets
from bellwether.operators import ingest as IN
from bellwether.operators import serving as SV
from bellwether.session import checkpoint_root, get_session, land
from bellwether.sources import cursor
from bellwether.sources import files as FS
from bellwether.sources import kafka
from bellwether.sources.paging import PAGE, Place, history_page
from bellwether.streaming.runner import active_status, await_any, compact_progress, log_progress
from bellwether.streaming.scoring import folder_sink, scoring_stream
from bellwether.streaming.serving import expire_days, facet_table, history_as_stream, history_stream, key_index
from bellwether.streaming.trend import LateTrend, late_trend_stream

# Records (Kafka) or files a micro-batch takes at most, so that the first
# batch of a new checkpoint is not the whole topic (D3).
MAX_OFFSETS = 1_000_000


@dataclass
class Layout:
    root: str

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)


def start_jobs(spark: SparkSession, source: str, layout: Layout, bootstrap: str | None = None,
               raw_folder: str | None = None, once: bool = False, max_offsets: int = MAX_OFFSETS,
               max_files: int = FS.FILES_PER_TRIGGER) -> list[StreamingQuery]:
    """Start the scoring, history and trend queries; return them."""
    def start(writer, name: str) -> StreamingQuery:
        writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
        query = writer.queryName(name).start()
        if once:                   # the next query reads what this one writes
            query.awaitTermination()
        return query

    if source == "kafka":
        raw = kafka.read_news_stream(spark, bootstrap, max_offsets_per_trigger=max_offsets)
        scored = kafka.read_scored_stream(spark, bootstrap, max_offsets_per_trigger=max_offsets)
        scored_sink = lambda df, batch_id: kafka.kafka_sink(df, bootstrap)
    else:
        FS.ensure_folder(spark, layout.path("scored"))      # its readers start before the first batch
        raw = FS.read_raw_stream(spark, raw_folder, max_files)
        scored = FS.read_topic_stream(spark, layout.path("scored"), max_files)
        scored_sink = folder_sink(layout.path("scored"))
    FS.ensure_folder(spark, layout.path("history"))

    return [
        start(scoring_stream(raw, scored_sink, layout.path("ck-scoring"),
                             folder_sink(layout.path("quarantine"))), "scoring"),
        start(history_stream(scored, layout.path("history"), layout.path("ck-history")), "history"),
        start(late_trend_stream(history_as_stream(spark, layout.path("history")), layout.path("trend"),
                                layout.path("ck-trend"), ts_col="ts"), "trend"),
    ]


def run_ingest(spark: SparkSession, envelopes: DataFrame, layout: Layout, fetched_at: float | None = None,
               bootstrap: str | None = None) -> DataFrame:
    """One fetch: responses to messages; returns its counts (A4).

    Valid messages go to the raw topic, or to ``raw`` under the root; the
    others to ``rejected`` with their reason.
    """
    from bellwether.functions.parsing import wall_clock_epoch

    flat = IN.flatten_envelopes(envelopes)
    normalised = IN.normalise_articles(IN.dedupe_first_title(flat),
                                       wall_clock_epoch() if fetched_at is None else fetched_at)
    messages = IN.valid_messages(normalised)
    if bootstrap:
        kafka.publish_news(messages, bootstrap)
    else:
        messages.select(F.to_json(F.struct(*messages.columns)).alias("value")).write.mode("append").text(
            layout.path("raw"))
    IN.quarantined(normalised).write.mode("append").parquet(layout.path("rejected"))
    return IN.fetch_metrics(flat)


def view(served: DataFrame, label: str = "All", sources: list[str] | None = None) -> dict[str, DataFrame]:
    """What the dashboard shows of served rows: all sources, counts per label, and the filtered cards."""
    chosen = SV.filter_sources(SV.filter_sentiment(served, label), sources)
    return {"counts": SV.sentiment_counts(served), "sources": served.select("source").distinct(),
            "n_rows": SV.filtered_count(chosen), "cards": SV.headline_cards(chosen)}


def history_view(spark: SparkSession, path: str, label: str = "All", sources: list[str] | None = None,
                 size: int = PAGE, after: Place | None = None) -> dict[str, DataFrame]:
    """The same of the history: numbers from its facets (no headline is read for them), cards page by page."""
    table = facet_table(spark, path).read()
    return {"counts": facets.sentiment_counts(table), "sources": facets.distinct_sources(table).select("source"),
            "n_rows": facets.filtered_count(table, label, sources),
            "cards": SV.headline_cards(history_page(spark, path, size, after, label, sources))}


def serve(spark: SparkSession, layout: Layout, label: str = "All", sources: list[str] | None = None,
          bootstrap: str | None = None, advance: bool = False, partitions: int | None = None,
          after: Place | None = None) -> dict[str, dict[str, DataFrame]]:
    """The dashboard's two views: ``latest`` (unread scored records, O3) and ``history``.

    The read resumes from the committed position (S3).  The unread records
    are landed first, so every view and the position are of the same ones,
    whatever arrives meanwhile.  With ``advance`` the views are written, and
    after that the position behind the records that were read is committed:
    after a crash between the two, the next call shows the same records
    again, and none is lost.  ``partitions`` of the scored topic need to be
    told when not all of them have been read yet (Kafka).
    """
    place = layout.path("position")
    position = cursor.load(spark, place)
    if bootstrap:
        unread = kafka.read_scored_bounded(spark, bootstrap, starting_offsets=cursor.as_kafka_offsets(
            kafka.SCORED_TOPIC, position, partitions))
    else:
        unread = cursor.unread(FS.read_topic(spark, layout.path("scored"), keyed=True), position)
    records = SV.parse_records(land(SV.skip_repeats(unread), "unread"))
    taken = land(SV.capped_take(records, SV.has_required_keys()), "latest")              # at most the cap and one
    views = {"latest": view(SV.to_served(taken), label, sources),
             "history": history_view(spark, layout.path("history"), label, sources, after=after)}
    if not advance:
        return views
    written = {}
    for name, tables in views.items():
        for kind, df in tables.items():
            df.write.mode("overwrite").parquet(layout.path(f"views/{name}-{kind}"))
        written[name] = {kind: spark.read.schema(df.schema).parquet(layout.path(f"views/{name}-{kind}"))
                         for kind, df in tables.items()}
    last = taken.orderBy(F.desc("idx")).first()
    stop = (last["partition"], last["offset"]) if last is not None and last["idx"] >= K.LATEST_CAP else None
    cursor.store(spark, place, position | cursor.behind(records, stop))
    return written


def maintain(spark: SparkSession, layout: Layout, keep_days: int = K.HISTORY_DAYS, dry_run: bool = True,
             today: str | None = None) -> DataFrame:
    """Compact the tables that grow per batch, and expire old days of the history (K6); returns the days past the horizon.

    A dry run only lists them.
    """
    history = layout.path("history")
    if FS.path_exists(spark, history):
        facet_table(spark, history).compact(facets.fold)
        key_index(spark, history).compact()
        trend = history_as_stream(spark, history).schema
        LateTrend(spark, layout.path("trend"), trend, "ts", "sentiment", "confidence").compact()
    compact_progress(spark, layout.path("progress"))
    return expire_days(spark, history, keep_days, layout.path("expired"), dry_run, today)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("job", nargs="?", choices=("stream", "ingest", "serve", "maintain"), default="stream")
    ap.add_argument("--source", choices=("kafka", "files"), default="kafka")
    ap.add_argument("--bootstrap", help="Kafka bootstrap servers (kafka source)")
    ap.add_argument("--raw", help="folder of raw JSON lines (files source)")
    ap.add_argument("--root", help="shared folder for checkpoints and tables")
    ap.add_argument("--once", action="store_true", help="process what is available, then stop")
    ap.add_argument("--max-offsets", type=int, default=MAX_OFFSETS, help="records of a micro-batch (D3)")
    ap.add_argument("--max-files", type=int, default=FS.FILES_PER_TRIGGER, help="files of a micro-batch (D3)")
    ap.add_argument("--envelopes", help="folder of landed API responses (ingest)")
    ap.add_argument("--label", default="All", help="label of the cards (serve)")
    ap.add_argument("--sources", default="", help="comma list of sources of the cards (serve)")
    ap.add_argument("--partitions", type=int, help="partitions of the scored topic (serve, kafka source)")
    ap.add_argument("--after", help="last card of the page before: time|title|link|publishedAt (serve)")
    ap.add_argument("--keep-days", type=int, default=K.HISTORY_DAYS, help="days of history to keep (maintain)")
    ap.add_argument("--expire", action="store_true", help="delete days past the horizon, not only list them (maintain)")
    args = ap.parse_args(argv)

    spark = get_session(app=f"bellwether-{args.job}")
    layout = Layout(args.root or checkpoint_root(spark))
    if args.job == "ingest":
        run_ingest(spark, spark.read.schema(schemas.ENVELOPE).json(args.envelopes), layout,
                   bootstrap=args.bootstrap).show()
        return
    if args.job == "serve":
        wanted = [s for s in args.sources.split(",") if s]
        after = Place(*args.after.split("|", 3)) if args.after else None
        serve(spark, layout, args.label, wanted, args.bootstrap, advance=True, partitions=args.partitions, after=after)
        return
    if args.job == "maintain":
        maintain(spark, layout, args.keep_days, dry_run=not args.expire).show(truncate=False)
        return
    log = log_progress(spark, layout.path("progress"))
    try:
        queries = start_jobs(spark, args.source, layout, args.bootstrap, args.raw, args.once,
                             args.max_offsets, args.max_files)
        for name, message in active_status(spark):
            print(f"  {name}: {message}")
        if args.once:
            for q in queries:
                q.awaitTermination()
        else:
            await_any(spark)
    finally:
        spark.streams.removeListener(log)


if __name__ == "__main__":
    main()
