"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads the driver tables in full through the adapters in
``bellwether.sources.tables``; timestamps are returned as display strings so
results compare across engines without time-zone ambiguity.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bellwether import constants as K
from bellwether import schemas
from bellwether.functions import parsing as P
from bellwether.functions.sentiment import sentiment_struct
from bellwether.functions.text import capitalize, round_stored
from bellwether.operators import facets, ingest, serving, timeline
from bellwether.operators.scoring import score_text
from bellwether.session import land, scratch_path
from bellwether.sources import files as FS
from bellwether.sources import tables as TB
from bellwether.streaming.runner import log_progress, rows_dropped, wait_for_batches
from bellwether.streaming.scoring import folder_sink, scoring_stream
from bellwether.sources.paging import history_page, newest_first_order, place_of
from bellwether.streaming.serving import expire_days, facet_table, history_stream, trend_stream
from bellwether.streaming.trend import LateTrend, late_trend_stream, open_trend, open_trend_stream

# Fixed query parameters (the dashboard's filter choices, ingestion time).
FILTER_LABEL = "Negative"
FILTER_SOURCES = ("src1", "src3", "src5")
INGEST_TIME = 1735689600.5          # explicit fetch time for replays (P7)
LATE_LABEL, LATE_SHARE = "error", 0.25   # copies of these early events arrive last (W4)
NO_RESULT, EMPTY_RESULT = 10, 9     # of 50 documents, one also has a missing result text and one an empty one (P13)
JSON_FIELDS = ("title", "source", "publishedAt", "link", "fetched_at", "sentiment", "confidence", "fetched_at_ts")
TREND_WIDTH = "1 hour"
PAGES, PAGE_SIZE = 3, 150            # of the cards that are paged through (O2)
ODD_EVERY = 40                       # of so many messages six are not as the schema says (P2)
KEEP_DAYS = 5                        # of the history whose older days expire (K6)
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _fmt(col: str | F.Column) -> F.Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, TS_FORMAT)


# ---- scoring and serving over documents -------------------------------------
def scored_headlines(spark: SparkSession, sf_dir: str, lexicon: dict[str, str] | None = None) -> DataFrame:
    return score_text(TB.headlines(spark, sf_dir), "title", key="doc_id", lexicon=lexicon)


def q_score_headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9-P11 over every document (whole text), each word with its own valence."""
    return scored_headlines(spark, sf_dir, K.GRADED_LEXICON).select(
        "doc_id", "title", "source", "publishedAt", "link", "fetched_at",
        "sentiment", "confidence", "compound", "n_hits")


def scores_only(spark: SparkSession, sf_dir: str, *keep: str, lexicon: dict[str, str] | None = None) -> DataFrame:
    """Scores per document without carrying the text through the shuffle."""
    h = TB.headlines(spark, sf_dir).select("doc_id", "title", *keep)
    return score_text(h, "title", key="doc_id", keep_text=False, lexicon=lexicon)


def q_sentiment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: headlines per sentiment, zero-filled, fixed label order."""
    return serving.sentiment_counts(scores_only(spark, sf_dir))


def served(spark: SparkSession, sf_dir: str, lexicon: dict[str, str] | None = None) -> DataFrame:
    return serving.to_served(scored_headlines(spark, sf_dir, lexicon))


def q_latest_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every served headline as a card, newest first, with its place in its day.

    The scores are materialised first: the sort reads its input twice (for
    the ranges, then for the rows), and the scoring would run twice.
    """
    rows = land(served(spark, sf_dir), "served")
    cards = serving.headline_cards(rows)
    day = Window.partitionBy(F.to_date("published_ts")).orderBy(F.col("published_ts").desc(), "title", "link")
    ranked = cards.withColumn("rank_in_day", F.row_number().over(day).cast("long"))
    return ranked.withColumn("published_ts", _fmt("published_ts"))


def q_sentiment_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's sentiment result as JSON text, then
    conditionally re-parsed (null or empty text -> null struct) and flattened.
    The null and empty texts stand beside the documents' own, not in their place."""
    scored = scores_only(spark, sf_dir, lexicon=K.GRADED_LEXICON)
    rest = F.col("doc_id") % TB.BAD_LABEL_EVERY
    text = F.to_json(sentiment_struct("sentiment", "confidence"))
    odd = F.when(rest == EMPTY_RESULT, F.lit("")).when(rest == NO_RESULT, F.lit(None))
    texts = F.when(rest.isin(EMPTY_RESULT, NO_RESULT), F.array(text, odd)).otherwise(F.array(text))
    as_json = scored.select("doc_id", F.explode(texts).alias("sentiment_json"))
    parsed = as_json.select("doc_id", P.conditional_parse("sentiment_json", schemas.SENTIMENT_RESULT)
                            .alias("s"))
    return parsed.select("doc_id", F.col("s").isNull().alias("is_null"),
                         F.col("s.sentiment").alias("sentiment"),
                         F.col("s.confidence").alias("confidence"))


def q_oldest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: served headlines in ascending publishedAt order, with their place in their day."""
    rows = land(served(spark, sf_dir, K.GRADED_LEXICON), "served")
    day = Window.partitionBy(F.substring("publishedAt", 1, 10)).orderBy("publishedAt", "title", "link")
    return serving.oldest_first(rows.withColumn("rank_in_day", F.row_number().over(day).cast("long")))


def _filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = serving.filter_sentiment(served(spark, sf_dir, K.GRADED_LEXICON), FILTER_LABEL)
    return serving.filter_sources(df, FILTER_SOURCES)


def q_filter_sentiment_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one label, a set of sources."""
    return _filtered(spark, sf_dir)


def q_filtered_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: rows left after F4 and F5 (scores only: the text is not carried)."""
    df = serving.filter_sentiment(scores_only(spark, sf_dir, "source"), FILTER_LABEL)
    return serving.filtered_count(serving.filter_sources(df, FILTER_SOURCES))


def q_reconcile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P20: a frame in another column order, one extra and two missing columns."""
    odd = scored_headlines(spark, sf_dir).select(
        "title", "sentiment", "source", "publishedAt", F.col("n_hits").alias("extra"))
    return serving.reconcile_columns(odd, schemas.HISTORY)


# ---- scored topic (records) ---------------------------------------------------
def parsed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return serving.parse_records(TB.scored_records(spark, sf_dir))


def landed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a topic that has landed (scored once), for queries that read it in several passes."""
    folder = scratch_path(spark, "topic")
    FS.write_topic(TB.scored_records(spark, sf_dir), folder)
    return serving.parse_records(FS.read_topic(spark, folder))


def _record_out(df: DataFrame, *lead: str) -> DataFrame:
    return df.select(*lead, "partition", "offset", "title", "source", "publishedAt", "link",
                     "fetched_at", "sentiment", "confidence",
                     _fmt("fetched_at_ts").alias("fetched_at_ts"))


def q_scored_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as bytes, decoded, parsed, projected."""
    recs = TB.scored_records(spark, sf_dir).withColumn("value", F.col("value").cast("binary"))
    return _record_out(serving.parse_records(recs))


def q_json_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored messages as JSON text, null fields omitted: the keys of each
    message in order, and its fields parsed back."""
    recs = TB.scored_records(spark, sf_dir)
    parsed = recs.select("partition", "offset", F.array_join(F.json_object_keys("value"), ",").alias("keys"),
                         P.parse_json("value", schemas.SCORED).alias("d"))
    return _record_out(parsed.select("partition", "offset", "keys", "d.*"), "keys")


def q_required_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """records carrying all six required keys; no document loses its own label before the test."""
    records = serving.parse_records(TB.scored_records(spark, sf_dir, K.GRADED_LEXICON, labelled=True))
    return _record_out(serving.require_keys(records))


def q_bad_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """records whose sentiment is null or empty (data-quality check)."""
    df = parsed_records(spark, sf_dir)
    bad = df.filter(F.col("sentiment").isNull() | (F.col("sentiment") == ""))
    return bad.select("partition", "offset", "title", "sentiment")


def q_dedupe_title_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 then D2: first record per (title, publishedAt), served form."""
    valid = serving.require_keys(parsed_records(spark, sf_dir))
    first = serving.dedupe_title_published(valid, order=("offset", "partition"))
    return first.select("partition", "offset", "title", "source", "publishedAt",
                        capitalize("sentiment").alias("sentiment"),
                        round_stored("confidence").alias("confidence"), "link")


def q_distinct_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: sources in first-seen order (a missing source is one value)."""
    return serving.distinct_sources(parsed_records(spark, sf_dir), "offset")


def q_scored_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 on the scored topic: records within 30 minutes of the latest fetch."""
    recs = landed_records(spark, sf_dir)
    last = recs.agg(F.max("fetched_at_ts").cast("string")).first()[0]
    return _record_out(timeline.retention_window(recs, "fetched_at_ts", K.SCORED_RETENTION, last))


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest view's capped read over the topic (F1 + O3)."""
    return serving.capped_take(landed_records(spark, sf_dir), serving.has_required_keys())


def q_capped_take(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: the latest view's capped read over the topic."""
    return _record_out(_latest(spark, sf_dir), "idx")


def q_latest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 over the latest view (the latest-batch chart)."""
    return serving.sentiment_counts(_latest(spark, sf_dir))


# ---- ingest over conversations and pages ------------------------------------
def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.flatten_envelopes(TB.envelopes(spark, sf_dir))


def _flat_out(df: DataFrame) -> DataFrame:
    return df.select("country", "country_rank", "page", "pos", "title", "url", "publishedAt",
                     F.col("source.name").alias("source_name"),
                     F.col("source").isNull().alias("source_missing"))


def q_flatten_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles of the ok responses, with their position."""
    return _flat_out(_flat(spark, sf_dir))


def q_dedupe_first_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First article per title in country-then-position order."""
    return _flat_out(ingest.dedupe_first_title(_flat(spark, sf_dir)))


def q_dedupe_page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 over raw pages: first page per <title>."""
    return serving.first_per_key(TB.page_titles(TB.load(spark, sf_dir, "pages")),
                                 ["title"], ["pos"])


def _normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = ingest.dedupe_first_title(_flat(spark, sf_dir))
    return ingest.normalise_articles(deduped, INGEST_TIME)


def _norm_out(df: DataFrame) -> DataFrame:
    return df.select("country_rank", "page", "pos", "title", "source", "publishedAt",
                     "link", "fetched_at", "reject_reason")


def q_normalise_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4, P5, P8 with the F2 reason, after D1."""
    return _norm_out(_normalised(spark, sf_dir))


def q_quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the articles set aside, with the reason."""
    return _norm_out(ingest.quarantined(_normalised(spark, sf_dir)))


def q_union_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages from two fetches (documents and responses), UNION ALL."""
    return ingest.union_batches(
        TB.headlines(spark, sf_dir).select(*[f.name for f in schemas.NEWS.fields]),
        ingest.valid_messages(_normalised(spark, sf_dir)))


def q_batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: fetched, unique, sent and rejected counts of one fetch."""
    return ingest.fetch_metrics(_flat(spark, sf_dir))


# ---- parsing and time over events -------------------------------------------
def q_parse_json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON props column parsed with a schema."""
    ev = TB.load(spark, sf_dir, "events")
    return ev.select("event_id", P.parse_json("props", "k INT").getField("k").alias("k"))


def q_iso_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO-8601 to display format; error events carry another format."""
    ev = TB.events(spark, sf_dir)
    iso_in = (F.when(F.col("event_type") == "error", F.date_format("ts", "yyyy/MM/dd HH:mm:ss"))
              .otherwise(F.date_format("ts", K.ISO_INPUT_FORMAT)))
    return ev.select("event_id", iso_in.alias("iso_in")).withColumn(
        "display", P.iso_to_display("iso_in"))


def q_epoch_to_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch seconds (with fraction) to a whole-second timestamp."""
    ev = TB.events(spark, sf_dir)
    epoch = (F.unix_micros("ts") / F.lit(1_000_000.0)).alias("epoch")
    return ev.select("event_id", epoch).withColumn(
        "ts_whole", _fmt(P.epoch_to_timestamp("epoch")))


def q_lenient_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lenient parse; error events carry JSON instead of a time."""
    ev = TB.events(spark, sf_dir)
    raw = (F.when(F.col("event_type") == "error", F.col("props"))
           .otherwise(F.date_format("ts", TS_FORMAT)))
    return ev.select("event_id", raw.alias("raw")).withColumn(
        "parsed", _fmt(P.lenient_timestamp("raw")))


def q_retention_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: events within the raw retention horizon of the latest event."""
    ev = TB.load(spark, sf_dir, "events")
    kept = timeline.retention_window(ev, "ts", K.RAW_RETENTION)
    return kept.select("event_id", _fmt("ts").alias("ts"), "event_type")


def q_today_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: events of the latest day."""
    ev = TB.load(spark, sf_dir, "events")
    return timeline.today_partition(ev, "ts").select("event_id", _fmt("ts").alias("ts"))


def _trend_out(df: DataFrame, label: str) -> DataFrame:
    return df.select(_fmt("window_start").alias("window_start"),
                     _fmt("window_end").alias("window_end"), label, "n",
                     "sum_value", "avg_value")


def q_sentiment_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 (addition): headlines per hour of publication and label."""
    s = scores_only(spark, sf_dir, "publishedAt", lexicon=K.GRADED_LEXICON).select(
        F.to_timestamp("publishedAt").alias("ts"), capitalize("sentiment").alias("sentiment"),
        round_stored("confidence").cast("decimal(12,3)").alias("value"))
    return _trend_out(timeline.trend(s, "ts", "sentiment", "value", TREND_WIDTH), "sentiment")


def q_event_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 over events: per hour and event type."""
    ev = TB.events(spark, sf_dir).select(
        "ts", "event_type", F.col("value").cast("decimal(12,2)").alias("value"))
    return _trend_out(timeline.trend(ev, "ts", "event_type", "value", TREND_WIDTH), "event_type")


# ---- streams replayed from the driver tables ---------------------------------
def _run_available(writer) -> StreamingQuery:
    """Run a stream over everything available, then stop (fails loudly)."""
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def q_stream_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 -> P1-P3, W1 -> score per batch -> P15 -> K1 (folder) -> S5 -> F1, D2 -> K3.

    The documents are landed as a raw-topic stand-in (JSON lines), scored,
    re-read as the scored topic and appended to the day-partitioned history,
    which is returned.
    """
    root = scratch_path(spark, "stream-history")
    news = TB.headlines(spark, sf_dir)
    news.select(F.to_json(F.struct(*[f.name for f in schemas.NEWS.fields])).alias("value")).write.text(f"{root}/raw")
    raw = FS.read_raw_stream(spark, f"{root}/raw")
    _run_available(scoring_stream(raw, folder_sink(f"{root}/scored"), f"{root}/ck-score",
                                  folder_sink(f"{root}/quarantine")))
    scored_raw = FS.read_topic_stream(spark, f"{root}/scored")
    _run_available(history_stream(scored_raw, f"{root}/history", f"{root}/ck-history"))
    return FS.read_history(spark, f"{root}/history")


def q_stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 in stream form: both fetches of every record replayed."""
    root = scratch_path(spark, "stream-dedupe")
    FS.write_topic(TB.scored_records(spark, sf_dir), f"{root}/scored")
    raw = FS.read_topic_stream(spark, f"{root}/scored")
    _run_available(history_stream(raw, f"{root}/history", f"{root}/ck"))
    return FS.read_history(spark, f"{root}/history")


def _event_values(ev: DataFrame) -> DataFrame:
    return ev.select(F.col("ts").cast("timestamp").alias("ts"), "event_type",
                     F.col("value").cast("decimal(12,2)").alias("value"))


def q_stream_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 in stream form over events: the windows that the watermark has passed."""
    root = scratch_path(spark, "stream-trend")
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    schema = spark.read.parquet(path).schema
    ev = _event_values(spark.readStream.schema(schema).parquet(FS.stream_path(spark, path)))
    _run_available(trend_stream(ev, f"{root}/trend", f"{root}/ck", ts_col="ts",
                                label_col="event_type", value_col="value", width=TREND_WIDTH))
    return _trend_out(spark.read.parquet(f"{root}/trend"), "event_type")


def q_stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream with late data.

    Three batches: the earlier events, the later ones, and copies of early
    error events, far behind the watermark by then.  The trend is that of the
    events on time; ``rows_dropped`` is what the engine reports (it counts
    the window and label groups of a batch that come too late).
    """
    root = scratch_path(spark, "stream-late")
    ev = TB.load(spark, sf_dir, "events")
    last = ev.agg(F.max("event_id")).first()[0] or 0
    halves = (ev.filter(F.col("event_id") * 2 < last), ev.filter(F.col("event_id") * 2 >= last))
    late = ev.filter((F.col("event_type") == LATE_LABEL) & (F.col("event_id") < last * LATE_SHARE))
    log = log_progress(spark, f"{root}/progress")
    writer = lambda: trend_stream(
        _event_values(spark.readStream.schema(ev.schema).parquet(f"{root}/in")), f"{root}/trend", f"{root}/ck",
        ts_col="ts", label_col="event_type", value_col="value", width=TREND_WIDTH)
    try:
        for batch in (*halves, late):          # each run of the stream takes what has landed since
            batch.write.mode("append").parquet(f"{root}/in")
            query = _run_available(writer())
            progress = wait_for_batches(spark, f"{root}/progress", query)
    finally:
        spark.streams.removeListener(log)
    dropped = rows_dropped(progress, str(query.id))
    trend = _trend_out(spark.read.parquet(f"{root}/trend"), "event_type")
    return trend.join(F.broadcast(dropped))


def q_history_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, A2, A3, F4, F5 kept up per batch: headlines per day, source and label of a history that grew in four batches.

    The last batch repeats records of earlier ones, and the batches are
    compacted half-way; the numbers are those of a full recount.
    """
    root = scratch_path(spark, "history-facets")
    records = land(TB.scored_records(spark, sf_dir), "topic-records")
    history = f"{root}/history"
    part = F.pmod(F.col("offset"), F.lit(3))
    batches = [records.where(part == k) for k in range(3)] + [records.where(F.pmod(F.col("offset"), F.lit(2)) == 0)]
    for k, batch in enumerate(batches):
        FS.write_topic(batch, f"{root}/scored/{k}")
        _run_available(history_stream(FS.read_topic_stream(spark, f"{root}/scored"), history, f"{root}/ck"))
        if k == 1:
            facet_table(spark, history).compact(facets.fold)
    whole = facets.fold(facet_table(spark, history).read())
    return whole.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "source", "sentiment", "n", "first_seen")


def _event_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The earlier events, the later ones, and copies of early error events that come far too late."""
    ev = TB.load(spark, sf_dir, "events")
    last = ev.agg(F.max("event_id")).first()[0] or 0
    return [ev.filter(F.col("event_id") * 2 < last), ev.filter(F.col("event_id") * 2 >= last),
            ev.filter((F.col("event_type") == LATE_LABEL) & (F.col("event_id") < last * LATE_SHARE))]


def q_stream_open_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1 in update mode: after two batches of events, all windows, the open ones too."""
    root = scratch_path(spark, "stream-open")
    for batch in _event_batches(spark, sf_dir)[:2]:
        batch.write.mode("append").parquet(f"{root}/in")
        stream = _event_values(spark.readStream.schema(batch.schema).parquet(f"{root}/in"))
        _run_available(open_trend_stream(stream, f"{root}/trend", f"{root}/ck", ts_col="ts", label_col="event_type",
                                         value_col="value", width=TREND_WIDTH))
    return _trend_out(open_trend(spark, f"{root}/trend", "event_type", stream.schema["value"].dataType), "event_type")


def _late_tables(spark: SparkSession, sf_dir: str) -> LateTrend:
    root = scratch_path(spark, "stream-late-kept")
    for batch in _event_batches(spark, sf_dir):
        batch.write.mode("append").parquet(f"{root}/in")
        raw = spark.readStream.schema(batch.schema).parquet(f"{root}/in")
        stream = raw.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type",
                            F.col("value").cast("decimal(12,2)").alias("value"))
        _run_available(late_trend_stream(stream, f"{root}/trend", f"{root}/ck", ts_col="ts", label_col="event_type",
                                         value_col="value", width=TREND_WIDTH))
    return LateTrend(spark, f"{root}/trend", stream.schema, "ts", "event_type", "value", TREND_WIDTH)


def q_stream_late_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that came after their window had closed, with the watermark that closed it."""
    late = _late_tables(spark, sf_dir).late.read()
    return late.select("event_id", _fmt("ts").alias("ts"), "event_type", "value", _fmt("late_watermark").alias("late_watermark"))


def q_stream_trend_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trend with its late rows added to the windows they missed: no row is lost."""
    return _trend_out(_late_tables(spark, sf_dir).merged(), "event_type")


def q_card_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1, O2 by pages: the first pages of the history's cards, each found from the place of the last card before."""
    path = f"{scratch_path(spark, 'card-pages')}/history"
    FS.append_history(served(spark, sf_dir), path)
    after, pages = None, []
    for number in range(1, PAGES + 1):
        page = land(history_page(spark, path, PAGE_SIZE, after), "page")
        pages.append(page.withColumn("page", F.lit(number)))
        if page.count() < PAGE_SIZE:
            break
        after = place_of(page.orderBy(*newest_first_order()).tail(1)[0])
    return reduce(DataFrame.unionByName, pages).withColumn("published_ts", _fmt("published_ts"))


def _odd_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News messages of which some have a field of the wrong type, by the remainder of their id."""
    h, rest = TB.headlines(spark, sf_dir), F.col("doc_id") % ODD_EVERY
    good = F.to_json(F.struct(*[f.name for f in schemas.NEWS.fields]))
    bad = F.concat(F.lit('{"title":'), F.to_json(F.struct("source")), F.lit(',"source":7,"fetched_at":'),
                   F.when(rest == 1, F.lit('"x"')).when(rest == 2, F.lit('{"at":[1,2]}')).when(rest == 3, F.lit("true"))
                   .when(rest == 4, F.lit("null")).otherwise(F.lit("[1.5]")), F.lit("}"))
    return h.select("doc_id", F.when(rest.between(1, 5), bad).when(rest == 6, F.lit("no JSON")).otherwise(good).alias("value"))


def q_field_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of a wrong type, which the permissive parse nulls, with what the message had."""
    found = _odd_messages(spark, sf_dir).select("doc_id", F.explode(P.field_violations("value", schemas.NEWS)).alias("v"))
    return found.select("doc_id", "v.field", "v.expected", "v.found", "v.value")


def q_history_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6 as expiry: what is left of a history of events after its old days are dropped, with the rows per day."""
    path = f"{scratch_path(spark, 'history-expiry')}/history"
    ev = TB.events(spark, sf_dir)
    FS.append_history(ev.select(F.col("event_id").cast("string").alias("title"), F.col("event_type").alias("source"),
                                _fmt("ts").alias("publishedAt"), F.lit("Neutral").alias("sentiment"),
                                F.lit(0.0).alias("confidence"), F.lit("").alias("link")), path)
    today = ev.agg(F.max("ts").cast("date").cast("string")).first()[0]
    expire_days(spark, path, KEEP_DAYS, f"{path}-expired", dry_run=False, today=today)
    left = facets.day_counts(facet_table(spark, path).read()).withColumnRenamed("n", "n_day")
    kept = FS.with_day(FS.read_history(spark, path)).join(left, "day")
    return kept.select(F.col("title").cast("long").alias("event_id"), F.col("source").alias("event_type"),
                       F.col("publishedAt").alias("ts"), "n_day")


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "score_headlines": q_score_headlines,
        "sentiment_counts": q_sentiment_counts,
        "latest_cards": q_latest_cards,
        "sentiment_json": q_sentiment_json,
        "oldest_first": q_oldest_first,
        "filter_sentiment_source": q_filter_sentiment_source,
        "filtered_count": q_filtered_count,
        "reconcile_columns": q_reconcile_columns,
        "scored_projection": q_scored_projection,
        "json_output": q_json_output,
        "required_keys": q_required_keys,
        "bad_sentiment": q_bad_sentiment,
        "dedupe_title_published": q_dedupe_title_published,
        "distinct_sources": q_distinct_sources,
        "scored_retention": q_scored_retention,
        "capped_take": q_capped_take,
        "latest_counts": q_latest_counts,
        "flatten_envelope": q_flatten_envelope,
        "dedupe_first_title": q_dedupe_first_title,
        "dedupe_page_titles": q_dedupe_page_titles,
        "normalise_articles": q_normalise_articles,
        "quarantine_split": q_quarantine_split,
        "union_batches": q_union_batches,
        "batch_metrics": q_batch_metrics,
        "parse_json_props": q_parse_json_props,
        "iso_normalise": q_iso_normalise,
        "epoch_to_ts": q_epoch_to_ts,
        "lenient_ts": q_lenient_ts,
        "retention_window": q_retention_window,
        "today_partition": q_today_partition,
        "sentiment_trend": q_sentiment_trend,
        "event_trend": q_event_trend,
        "stream_history": q_stream_history,
        "stream_dedupe": q_stream_dedupe,
        "stream_trend": q_stream_trend,
        "stream_late_rows": q_stream_late_rows,
        "history_facets": q_history_facets,
        "card_pages": q_card_pages,
        "field_violations": q_field_violations,
        "history_expiry": q_history_expiry,
        "stream_open_trend": q_stream_open_trend,
        "stream_late_split": q_stream_late_split,
        "stream_trend_merged": q_stream_trend_merged,
    }
