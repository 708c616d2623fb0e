"""A1, A2, A3 with F4 and F5 kept up batch by batch, instead of recounting the history.

Every micro-batch of the history adds one small row per (day, source,
label): how many headlines, and where the first of them stood in the topic.
The dashboard's numbers are sums and minima of these rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bellwether.operators.serving import filter_sentiment, filter_sources, label_counts

SCHEMA = T.StructType([
    T.StructField("day", T.DateType()),
    T.StructField("source", T.StringType()),
    T.StructField("sentiment", T.StringType()),
    T.StructField("n", T.LongType()),
    T.StructField("first_seen", T.LongType()),
])
GROUP = ("day", "source", "sentiment")


def partial(rows: DataFrame, order_col: str | None = "offset") -> DataFrame:
    """The facets of history rows that have a ``day``; without an order column, ``first_seen`` is null."""
    first = F.min(order_col) if order_col else F.lit(None)
    return rows.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"), first.cast("long").alias("first_seen"))


def fold(facets: DataFrame) -> DataFrame:
    """Facets of several batches as those of one (also what a compaction does)."""
    return facets.groupBy(*GROUP).agg(F.sum("n").alias("n"), F.min("first_seen").alias("first_seen"))


def sentiment_counts(facets: DataFrame) -> DataFrame:
    """A1: headlines per label, zero-filled, fixed order."""
    return label_counts(facets.groupBy("sentiment").agg(F.sum("n").alias("n")))


def distinct_sources(facets: DataFrame) -> DataFrame:
    """A2: each source once, in first-seen order."""
    return (facets.groupBy("source").agg(F.min("first_seen").alias("first_seen"))
            .orderBy(F.col("first_seen").asc_nulls_last(), "source"))


def filtered_count(facets: DataFrame, label: str = "All", sources: Sequence[str] | None = None) -> DataFrame:
    """A3 after F4 and F5: number of headlines, as a one-row frame."""
    chosen = filter_sources(filter_sentiment(facets, label), sources)
    return chosen.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))


def day_counts(facets: DataFrame) -> DataFrame:
    """Headlines per day, newest day first (undated ones last)."""
    return facets.groupBy("day").agg(F.sum("n").alias("n")).orderBy(F.col("day").desc_nulls_last())
