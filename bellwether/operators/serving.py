"""Serving-side operators: validation, dedupe, counts, filters, ordering.

F1, F4, F5, D2, A1, A2, A3, O1, O2, O3, P16, P17, P19, P20.
All groupings aggregate map-side before shuffling, so a label, source or
key holding a large share of the rows costs one record per task.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bellwether import constants as K
from bellwether import schemas
from bellwether.functions.parsing import bytes_to_string, lenient_timestamp, parse_json
from bellwether.functions.text import capitalize, card_markdown, round_stored
from bellwether.operators.scoring import constant_table
from bellwether.session import land


def _cols(names: Iterable[str]) -> list[Column]:
    return [F.col(n) for n in names]


# F1 ---------------------------------------------------------------------
def has_required_keys(keys: Sequence[str] = K.REQUIRED_KEYS) -> Column:
    """F1 predicate: every required key is present (omitted == null after P15)."""
    out = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        out = out & F.col(k).isNotNull()
    return out


def require_keys(df: DataFrame, keys: Sequence[str] = K.REQUIRED_KEYS) -> DataFrame:
    return df.filter(has_required_keys(keys))


# P16, P17 ----------------------------------------------------------------
def to_served_columns() -> list[Column]:
    """Capitalised label and confidence rounded to 3 places, history column order."""
    return [F.col("title"), F.col("source"), F.col("publishedAt"), capitalize("sentiment").alias("sentiment"),
            round_stored("confidence").alias("confidence"), F.col("link")]


def to_served(df: DataFrame) -> DataFrame:
    """The served form of scored rows."""
    return df.select(*to_served_columns())


# D2 / D1 ----------------------------------------------------------------
def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep, for each key, the row that comes first in ``order``.

    ``min`` over a struct led by the order columns: a partial aggregate runs
    before the shuffle, so a key with millions of copies sends one row per
    task.  Ties on ``order`` fall back to the remaining columns, so the
    choice is deterministic.  Null keys form one group, as in a dict.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*_cols(order), *_cols(rest)).alias("__first")
    # A 64-bit hash leads the grouping: the sort-based aggregate then orders
    # on a fixed-width prefix and compares the (possibly long, near-equal)
    # key texts only on hash ties.  The keys themselves keep grouping exact.
    agg = df.groupBy(F.xxhash64(*_cols(keys)).alias("__h"), *_cols(keys)) \
        .agg(F.min(packed).alias("__first"))
    return agg.select(*_cols(keys),
                      *[F.col("__first").getField(c).alias(c) for c in list(order) + rest]
                      ).select(*df.columns)


def dedupe_title_published(df: DataFrame, order: Sequence[str] = ("offset",)) -> DataFrame:
    """One row per (title, publishedAt), the earliest by offset."""
    return first_per_key(df, ["title", "publishedAt"], order)


# K1 ----------------------------------------------------------------------
def skip_repeats(records: DataFrame) -> DataFrame:
    """The records of a topic without those that a retried batch has written again.

    Of records with one ``key`` the first stays (least partition and offset);
    records without a key are all different.  Keys are grouped together with
    the position of keyless records, so these are no hot group.
    """
    alone = F.when(F.col("key").isNull(), F.struct("partition", "offset"))
    kept = first_per_key(records.withColumn("__alone", alone), ["key", "__alone"], ["partition", "offset"])
    return kept.drop("__alone")


# F4, F5, A3 ----------------------------------------------------------------
def filter_sentiment(df: DataFrame, label: str = "All") -> DataFrame:
    """``All`` keeps every row."""
    return df if label == "All" else df.filter(F.col("sentiment") == F.lit(label))


def filter_sources(df: DataFrame, sources: Sequence[str] | None = None) -> DataFrame:
    """an empty selection keeps every row."""
    return df if not sources else df.filter(F.col("source").isin(list(sources)))


def filtered_count(df: DataFrame) -> DataFrame:
    """A3: number of rows after the filters, as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


# A1 ---------------------------------------------------------------------
def labels_frame(spark: SparkSession) -> DataFrame:
    """The three labels with their display rank (a local relation)."""
    schema = T.StructType([T.StructField("sentiment", T.StringType(), False),
                           T.StructField("label_rank", T.IntegerType(), False)])
    return constant_table(spark, [(l, str(i + 1)) for i, l in enumerate(K.LABELS)], schema)


def sentiment_counts(df: DataFrame, label_col: str = "sentiment") -> DataFrame:
    """A1: count per label in fixed label order; missing labels 0, unknown dropped.

    The input is restricted to the three known labels before grouping, so
    the counts side has at most three rows and is safe to broadcast.
    """
    label = capitalize(label_col)
    return label_counts(df.select(label.alias("sentiment")).groupBy("sentiment").agg(F.count(F.lit(1)).alias("n")))


def label_counts(counts: DataFrame) -> DataFrame:
    """The counts ``sentiment, n`` of the known labels (one row each at most) on the label dimension, zero-filled."""
    known = counts.filter(F.col("sentiment").isin(list(K.LABELS)))
    return (labels_frame(counts.sparkSession).join(F.broadcast(known), "sentiment", "left")
            .select("sentiment", "label_rank", F.coalesce(F.col("n"), F.lit(0)).alias("n"))
            .orderBy("label_rank"))


# A2 ---------------------------------------------------------------------
def distinct_sources(df: DataFrame, order_col: str) -> DataFrame:
    """A2: each source once, ordered by where it was first seen."""
    return (df.groupBy("source").agg(F.min(order_col).alias("first_seen"))
            .orderBy("first_seen", "source"))


# O1, O2 -----------------------------------------------------------------
def oldest_first(df: DataFrame) -> DataFrame:
    """O1: ascending by the publishedAt string (same as time for this format),
    missing times last."""
    return df.orderBy(F.col("publishedAt").asc_nulls_last(), "title", "link")


def newest_first(df: DataFrame) -> DataFrame:
    """O2: by parsed time, newest first, unparsable times last."""
    return (df.withColumn("published_ts", lenient_timestamp("publishedAt"))
            .orderBy(F.col("published_ts").desc_nulls_last(), "title", "link"))


# P19 --------------------------------------------------------------------
def headline_cards(df: DataFrame) -> DataFrame:
    """P19 over O2: one card per served row, newest first."""
    served = newest_first(df)
    return served.select(
        "title", "source", "publishedAt", "published_ts", "sentiment", "confidence", "link",
        card_markdown("title", "source", "published_ts", "sentiment", "confidence", "link")
        .alias("card"))


# O3 ---------------------------------------------------------------------
def capped_take(records: DataFrame, valid: Column, cap: int = K.LATEST_CAP) -> DataFrame:
    """O3: valid records with index < cap, plus the first valid one at index >= cap.

    The index (``idx``) is the record's place in the whole read, in order of
    ``partition`` and ``offset``; offsets may have gaps.  All records wanted
    are among the ``cap`` + 1 least valid ones: a top-N per task, landed, and
    the only pass over the records' contents.  Their places follow from the
    numbers of records between them, counted over the positions alone: one
    partial aggregate of at most ``cap`` + 2 groups.
    """
    at = F.struct("partition", "offset")
    first = land(records.filter(valid).orderBy("partition", "offset").limit(cap + 1), "first-valid")
    bounds = first.agg(F.array_sort(F.collect_list(at)).alias("__bounds"))                            # one row
    passed = F.size(F.filter("__bounds", lambda b: b <= at))
    between = records.select("partition", "offset").join(F.broadcast(bounds)).groupBy(
        passed.cast("long").alias("__passed")).agg(F.count(F.lit(1)).alias("__n"))
    # a record's place is the number of records that have passed fewer bounds than it has
    order = Window.orderBy("partition", "offset")                                                     # cap + 1 rows
    ranked = first.withColumn("__rank", F.row_number().over(order).cast("long"))
    placed = ranked.join(F.broadcast(between), F.col("__passed") < F.col("__rank"), "left").groupBy("__rank").agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("idx"))
    late = F.row_number().over(Window.partitionBy(F.col("idx") >= cap).orderBy("idx"))
    wanted = placed.withColumn("__late", late).filter((F.col("idx") < cap) | (F.col("__late") == 1))
    return ranked.join(F.broadcast(wanted), "__rank").select("idx", *records.columns).orderBy("idx").limit(cap + 1)


# P20 --------------------------------------------------------------------
def reconcile_columns(df: DataFrame, target: T.StructType) -> DataFrame:
    """P20: target columns in target order; missing strings '' and other types null."""
    present = set(df.columns)
    out = []
    for f in target.fields:
        if f.name in present:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            out.append(F.lit("").alias(f.name))
        else:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*out)


# P1, P2, P14 ---------------------------------------------------------------
def parse_records(records: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Decode topic records (P1) and expand the JSON value.

    ``value`` may be binary or text; the record position is kept.
    """
    schema = schema or schemas.SCORED
    return records.select(
        "partition", "offset",
        parse_json(bytes_to_string("value"), schema).alias("data")).select(
        "partition", "offset", "data.*")
