"""O1, O2 by pages: the newest headlines first, reading only the days that a page needs.

The facets say how many headlines each day has (after F4 and F5), so a page
starts with the newest day at or before the last card shown and takes as
many days as it needs; only their partitions are read, and the page is a
top-N of them.  The place of the last card is the cursor of the next page.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bellwether import schemas
from bellwether.functions.parsing import lenient_timestamp
from bellwether.operators import facets
from bellwether.operators.serving import filter_sentiment, filter_sources
from bellwether.sources.files import STORED_HISTORY, path_exists

PAGE = 100                    # cards of a page
MOST_DAYS = 3_660             # days that are listed in a partition filter; beyond, a range of days is read


class Place(NamedTuple):
    """Where a card stands in newest-first order: its parsed time (None: undated), title, link and publishedAt."""

    published_ts: str | None
    title: str | None
    link: str | None
    publishedAt: str | None


def newest_first_order() -> list[Column]:
    """O2's order, made total by the publication text (a headline's key is its title and publication text)."""
    return [F.col("published_ts").desc_nulls_last(), F.col("title"), F.col("link"), F.col("publishedAt")]


def place_of(row) -> Place:
    """The cursor behind a row of a page."""
    ts = row["published_ts"]
    return Place(None if ts is None else ts.strftime("%Y-%m-%d %H:%M:%S.%f"), row["title"], row["link"], row["publishedAt"])


def _behind(after: Place) -> Column:
    """Does a row come after the place?"""
    ts = F.lit(after.published_ts).cast("timestamp")
    rest = F.struct(*[F.coalesce(F.col(c), F.lit("")) for c in ("title", "link", "publishedAt")])
    mine = F.struct(*[F.lit(v or "") for v in (after.title, after.link, after.publishedAt)])
    if after.published_ts is None:
        return F.col("published_ts").isNull() & (rest > mine)
    return F.col("published_ts").isNull() | (F.col("published_ts") < ts) | ((F.col("published_ts") == ts) & (rest > mine))


def days_of_page(spark: SparkSession, path: str, size: int, after: Place | None = None, label: str = "All",
                 sources: Sequence[str] | None = None) -> list:
    """The newest days that hold a page of ``size`` headlines behind a place."""
    from bellwether.streaming.serving import facet_table

    chosen = filter_sources(filter_sentiment(facet_table(spark, path).read(), label), sources)
    counts = [(r["day"], r["n"]) for r in facets.day_counts(chosen).collect()]          # one row per day
    first = None if after is None or after.published_ts is None else after.published_ts[:10]
    if after is not None:
        counts = [(d, n) for d, n in counts if d is None or (first is not None and str(d) <= first)]
    days, found = [], 0
    for day, n in counts:
        days.append(day)
        # of the cursor's own day an unknown part has been shown, so it does not count
        found += 0 if after is not None and (str(day) if day else None) == first else n
        if found >= size:
            break
    return days


def history_page(spark: SparkSession, path: str, size: int = PAGE, after: Place | None = None, label: str = "All",
                 sources: Sequence[str] | None = None) -> DataFrame:
    """The next ``size`` headlines of the history, newest first, with ``published_ts``."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schemas.HISTORY).withColumn("published_ts", F.lit(None).cast("timestamp"))
    days = days_of_page(spark, path, size, after, label, sources)
    some = [d for d in days if d is not None]
    in_days = F.lit(False)
    if some:
        in_days = F.col("day").isin(some) if len(some) <= MOST_DAYS else F.col("day").between(F.lit(min(some)), F.lit(max(some)))
    if None in days:
        in_days = in_days | F.col("day").isNull()
    rows = spark.read.schema(STORED_HISTORY).parquet(path).filter(in_days)
    rows = filter_sources(filter_sentiment(rows, label), sources).withColumn("published_ts", lenient_timestamp("publishedAt"))
    if after is not None:
        rows = rows.filter(_behind(after))
    return rows.select(*[f.name for f in schemas.HISTORY.fields], "published_ts").orderBy(*newest_first_order()).limit(size)
