"""Time-based operators: K5, K6 retention, X1 trend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _literal(df: DataFrame, ts_col: str, text: str) -> Column:
    """A constant of the column's own type, so a comparison with it reaches the scan."""
    return F.lit(text).cast(df.schema[ts_col].dataType)


def _latest(df: DataFrame, ts_col: str) -> str | None:
    """The latest event time, found first (one row): a filter with a constant
    is pushed to the scan, one with a subquery over the same scan is not."""
    return df.agg(F.max(ts_col).cast("string")).first()[0]


def retention_window(df: DataFrame, ts_col: str, interval: str,
                     horizon: str | None = None) -> DataFrame:
    """K6: keep rows with ``ts >= horizon - interval`` (topic retention as a filter)."""
    horizon = horizon or _latest(df, ts_col)
    if horizon is None:
        return df.limit(0)
    return df.filter(F.col(ts_col) >= _literal(df, ts_col, horizon) - F.expr(f"INTERVAL {interval}"))


def today_partition(df: DataFrame, ts_col: str, day: str | None = None) -> DataFrame:
    """K5: the rows of one day (default: the day of the latest event).

    A range of times, which is pushed to the scan.  On the history the same
    is a partition filter, and the daily reset an overwrite of that one
    partition (``sources.files.overwrite_days``).
    """
    day = day or (_latest(df, ts_col) or "")[:10]
    if not day:
        return df.limit(0)
    start = _literal(df, ts_col, f"{day} 00:00:00")
    return df.filter((F.col(ts_col) >= start) & (F.col(ts_col) < start + F.expr("INTERVAL 1 DAY")))


def trend(df: DataFrame, ts_col: str, label_col: str, value_col: str,
          width: str = "1 hour") -> DataFrame:
    """X1 (addition, advertised but not coded upstream): per time window and
    label, the row count and mean value.  Tumbling windows; each row is in
    exactly one window, and the aggregate is partial before the shuffle.
    The mean is the (exact, for DECIMAL values) sum over the count."""
    return (df.groupBy(F.window(ts_col, width).alias("w"), F.col(label_col))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(value_col).alias("sum_value"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    label_col, "n", "sum_value",
                    (F.col("sum_value").cast("double") / F.col("n")).alias("avg_value")))
