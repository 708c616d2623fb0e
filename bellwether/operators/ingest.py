"""Ingest-side operators: S2, U1, D1, P4, P5, P8, F2, A4.

Landed API responses (envelopes) are flattened into articles, duplicate
titles within one fetch are removed first-wins, and each article is
normalised into a news message or set aside with a reason.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bellwether import constants as K
from bellwether import schemas
from bellwether.functions.parsing import iso_to_display
from bellwether.operators.scoring import constant_table
from bellwether.operators.serving import first_per_key


def country_frame(spark: SparkSession) -> DataFrame:
    """The fetch order of the countries (a local relation of 11 rows)."""
    schema = T.StructType([T.StructField("country", T.StringType(), False),
                           T.StructField("country_rank", T.LongType(), False)])
    return constant_table(spark, [(c, str(i)) for i, c in enumerate(K.COUNTRIES)], schema)


def flatten_envelopes(envelopes: DataFrame) -> DataFrame:
    """Keep ``status == 'ok'`` responses and explode their articles.

    A missing ``articles`` list counts as empty.  ``pos`` keeps each
    article's position in its response for the first-wins order of D1.
    Responses without a ``country_rank`` get it from the fixed fetch order
    (a broadcast of the 11-row country table).
    """
    if "country_rank" not in envelopes.columns:
        envelopes = envelopes.join(F.broadcast(country_frame(envelopes.sparkSession)),
                                   "country", "left")
    ok = envelopes.filter(F.col("status") == F.lit(K.STATUS_OK))
    empty = F.array().cast(schemas.ENVELOPE["articles"].dataType)
    order = [c for c in ("country_rank", "page") if c in envelopes.columns]
    flat = ok.select(
        "country", *order,
        F.posexplode(F.coalesce(F.col("articles"), empty)).alias("pos", "article"))
    return flat.select("country", *order, "pos", "article.*")


def union_batches(*frames: DataFrame) -> DataFrame:
    """Concatenate results (UNION ALL, by column name)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def dedupe_first_title(articles: DataFrame,
                       order: tuple[str, ...] = ("country_rank", "page", "pos")) -> DataFrame:
    """One article per title, the first in fetch order; null is one title."""
    return first_per_key(articles, ["title"], [c for c in order if c in articles.columns])


def reject_reason() -> Column:
    """why an article cannot become a message (null when it can)."""
    return (F.when(F.col("publishedAt").isNull(), F.lit("missing publishedAt"))
            .when(iso_to_display("publishedAt").isNull(), F.lit("unparsable publishedAt"))
            .when(F.col("source").isNull(), F.lit("missing source")))


def normalise_articles(articles: DataFrame, fetched_at: Column | float) -> DataFrame:
    """P4, P5, P8 plus the F2 reason column.

    ``fetched_at`` is the ingestion time (P7); pass it explicitly so a
    replay gives the same output.  Missing url -> '', missing source name
    -> 'Unknown Source' (explicit nulls are filled too).
    """
    fetched = fetched_at if isinstance(fetched_at, Column) else F.lit(float(fetched_at))
    return articles.select(
        *[c for c in articles.columns
          if c not in ("title", "url", "publishedAt", "source")],
        F.col("title"),
        F.coalesce(F.col("source.name"), F.lit(K.UNKNOWN_SOURCE)).alias("source"),
        iso_to_display("publishedAt").alias("publishedAt"),
        F.coalesce(F.col("url"), F.lit("")).alias("link"),
        fetched.cast("double").alias("fetched_at"),
        reject_reason().alias("reject_reason"),
    )


def valid_messages(normalised: DataFrame) -> DataFrame:
    return (normalised.filter(F.col("reject_reason").isNull())
            .select(*[f.name for f in schemas.NEWS.fields]))


def quarantined(normalised: DataFrame) -> DataFrame:
    return normalised.filter(F.col("reject_reason").isNotNull())


def fetch_metrics(articles: DataFrame) -> DataFrame:
    """A4 (ingest): fetched, unique, sendable and rejected counts as one row.

    ``articles`` (flattened, with their position) is read once: a first
    aggregate counts the copies of each title next to the copy that wins
    (D1), a second one sums up.
    """
    copies = articles.withColumn("__n", F.lit(1))
    order = [c for c in ("country_rank", "page", "pos") if c in articles.columns]
    first = F.struct(*order, "publishedAt", "source")
    titles = copies.groupBy("title").agg(F.sum("__n").alias("__n"), F.min(first).alias("__first"))
    rows = titles.select("__n", "__first.publishedAt", "__first.source")
    reason = reject_reason()
    return rows.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_fetched"), F.count(F.lit(1)).alias("n_unique"),
        F.count_if(reason.isNull()).alias("n_sent"), F.count_if(reason.isNotNull()).alias("n_rejected"))
