"""Driver tables and the adapters that turn them into pipeline inputs.

The test tables hold no news, so deterministic adapters map them onto the
pipeline's message shapes.  Every adapter is a projection (no sampling, no
row caps); the oracle SQL repeats the same expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bellwether.constants import DISPLAY_FORMAT, ISO_INPUT_FORMAT, PAGE_SIZE, STATUS_OK
from bellwether.functions.parsing import epoch_to_timestamp
from bellwether.operators.scoring import score_text
from bellwether.schemas import ARTICLE

# Fixed values of the adapters.
EPOCH_START = 1704067200            # 2024-01-01 00:00:00 UTC
START_TS = "2024-01-01 00:00:00"
FETCH_LAG_SECONDS = 3600.125        # fetched an hour (and a fraction) after publication
LINK_PREFIX = "https://news.example.com/articles/"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def published_at(minutes: F.Column) -> F.Column:
    """Display-format publication time ``START_TS + minutes``."""
    ts = F.timestamp_add("MINUTE", minutes, F.to_timestamp(F.lit(START_TS)))
    return F.date_format(ts, DISPLAY_FORMAT)


def headlines_from_documents(documents: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """News messages from ``documents``: the whole text is the headline."""
    doc_id = F.col("doc_id")
    return documents.select(
        doc_id, *keep,
        F.col("text").alias("title"),
        F.col("source"),
        published_at(doc_id).alias("publishedAt"),
        F.concat(F.lit(LINK_PREFIX), doc_id.cast("string")).alias("link"),
        (F.lit(EPOCH_START) + doc_id * F.lit(60) + F.lit(FETCH_LAG_SECONDS))
        .cast("double").alias("fetched_at"),
    )


def headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return headlines_from_documents(load(spark, sf_dir, "documents"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``ts`` as a session-zone (UTC) timestamp."""
    return load(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


# Envelope stand-in ---------------------------------------------------------
CONV_LINK_PREFIX = "https://news.example.com/conv/"
DATE_ONLY_FORMAT = "yyyy-MM-dd"


REPEAT_EVERY = 3                  # these conversations are answered by a second country too
SECOND_RANK = 1_000_000_000       # which comes later in fetch order


def envelopes_from_conversations(conversations: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Landed API responses from ``conversations``.

    One response per (conversation, page of ``page_size`` turns), so no
    response holds more articles than the API's page size.  Every third
    conversation is also the response of a second country, so its titles come
    twice.  Edge cases come from fixed rules: a response holding a ``system``
    turn failed; turn 0 carries a date-only publishedAt, turn 1 no source,
    turn 2 a source without name, turn 3 no url.
    """
    turn, conv = F.col("turn"), F.col("conv_id")
    ts = F.timestamp_add("MINUTE", turn,
                         F.timestamp_add("HOUR", conv, F.to_timestamp(F.lit(START_TS))))
    published = (F.when(turn == 0, F.date_format(ts, DATE_ONLY_FORMAT))
                 .otherwise(F.date_format(ts, ISO_INPUT_FORMAT)))
    source = (F.when(turn == 1, F.lit(None).cast(ARTICLE["source"].dataType))
              .when(turn == 2, F.struct(F.lit(None).cast("string").alias("name")))
              .otherwise(F.struct(F.col("role").alias("name"))))
    url = F.when(turn != 3, F.concat(F.lit(CONV_LINK_PREFIX), conv.cast("string"),
                                     F.lit("/"), turn.cast("string")))
    article = F.struct(F.col("text").alias("title"), url.alias("url"),
                       published.alias("publishedAt"), source.alias("source"))
    paged = conversations.select(
        conv, F.floor(turn / F.lit(page_size)).cast("int").alias("page"), turn, "role",
        article.alias("article"))
    grouped = paged.groupBy("conv_id", "page").agg(
        F.max(F.col("role") == F.lit("system")).alias("failed"),
        F.array_sort(F.collect_list(F.struct("turn", "article"))).alias("items"))
    second = F.when(F.col("conv_id") % REPEAT_EVERY == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    grouped = grouped.withColumn("copy", F.explode(second))
    return grouped.select(
        F.concat(F.when(F.col("copy") == 0, F.lit("c")).otherwise(F.lit("d")),
                 F.col("conv_id").cast("string")).alias("country"),
        (F.col("conv_id") + F.col("copy") * F.lit(SECOND_RANK)).cast("long").alias("country_rank"),
        "page",
        F.when(F.col("failed"), F.lit("error")).otherwise(F.lit(STATUS_OK)).alias("status"),
        F.transform("items", lambda x: x.getField("article")).alias("articles"))


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelopes_from_conversations(load(spark, sf_dir, "conversations"))


# Page titles ---------------------------------------------------------------
TITLE_PATTERN = "<title>([^<]*)</title>"


def page_titles(pages: DataFrame) -> DataFrame:
    """Articles from raw pages: the <title> text, in page order."""
    title = F.regexp_extract(F.col("html"), TITLE_PATTERN, 1)
    return pages.select(F.col("page_id").alias("pos"),
                        F.when(title != "", title).alias("title"), "url")


# Scored-topic stand-in -------------------------------------------------------
FETCHES = 2                       # each document is fetched twice, an hour apart
REFETCH_SECONDS = 3600.0
NO_SOURCE_LANG = "es"             # messages from these documents omit `source`
BAD_LABEL_EVERY = 50              # of so many documents one has label '' and one has none
EMPTY_LABEL, NO_LABEL = 7, 8      # their remainders


def scored_records_from_documents(documents: DataFrame, lexicon: dict[str, str] | None = None,
                                  labelled: bool = False) -> DataFrame:
    """Records of the scored topic: ``partition, offset, value`` (JSON).

    Two fetches per document, an hour apart (same title and publishedAt,
    later fetched_at), so keyed dedupe has work to do.  Fetch round ``f``
    lands in topic partition ``f`` at offset ``doc_id``, so offsets are
    contiguous within each partition.  Documents in ``NO_SOURCE_LANG``
    yield messages without ``source``; a few lack a label (F3).  With
    ``labelled`` those keep their label, and the message without it is a
    further fetch.
    """
    scored = score_text(headlines_from_documents(documents, keep=("lang",)), "title", key="doc_id", lexicon=lexicon)
    label = F.col("doc_id") % BAD_LABEL_EVERY
    last = F.lit(FETCHES - 1)
    if labelled:
        last += F.when(label.isin(EMPTY_LABEL, NO_LABEL), 1).otherwise(0)
    both = scored.select("*", F.explode(F.sequence(F.lit(0), last)).alias("fetch"))
    fetched_at = F.col("fetched_at") + F.col("fetch") * F.lit(REFETCH_SECONDS)
    sentiment = F.when(label == EMPTY_LABEL, F.lit("")).when(label != NO_LABEL, F.col("sentiment"))
    if labelled:
        sentiment = F.when(F.col("fetch") < FETCHES, F.col("sentiment")).otherwise(sentiment)
    msg = F.struct(
        F.col("title"),
        F.when(F.col("lang") != F.lit(NO_SOURCE_LANG), F.col("source")).alias("source"),
        F.col("publishedAt"), F.col("link"),
        fetched_at.alias("fetched_at"),
        sentiment.alias("sentiment"),
        F.col("confidence"),
        epoch_to_timestamp(fetched_at).alias("fetched_at_ts"))
    return both.select(
        F.col("fetch").alias("partition"),
        F.col("doc_id").alias("offset"),
        F.to_json(msg).alias("value"))


def scored_records(spark: SparkSession, sf_dir: str, lexicon: dict[str, str] | None = None,
                   labelled: bool = False) -> DataFrame:
    return scored_records_from_documents(load(spark, sf_dir, "documents"), lexicon, labelled)
