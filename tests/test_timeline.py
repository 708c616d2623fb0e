"""K5, K6, X1."""

import datetime as dt

from bellwether.operators import timeline

T0 = dt.datetime(2024, 1, 10, 12, 0, 0)


def frame(spark, offsets_minutes):
    rows = [(i, T0 + dt.timedelta(minutes=m) if m is not None else None)
            for i, m in enumerate(offsets_minutes)]
    return spark.createDataFrame(rows, "id long, ts timestamp")


def test_retention_window_default_and_explicit(spark):
    df = frame(spark, [-60 * 24 * 8, -60 * 24 * 7, -60, 0])
    assert [r["id"] for r in timeline.retention_window(df, "ts", "7 days").orderBy("id").collect()] == [1, 2, 3]
    kept = timeline.retention_window(df, "ts", "30 minutes", horizon="2024-01-10 11:30:00")
    assert sorted(r["id"] for r in kept.collect()) == [2, 3]


def test_today_partition(spark):
    df = frame(spark, [-60 * 13, -60, 0, 60 * 11])   # 23:00 previous day .. 23:00
    assert sorted(r["id"] for r in timeline.today_partition(df, "ts").collect()) == [1, 2, 3]
    assert sorted(r["id"] for r in timeline.today_partition(df, "ts", "2024-01-09").collect()) == [0]


def test_trend_counts_and_mean(spark):
    rows = [(T0, "Positive", 1.0), (T0 + dt.timedelta(minutes=59), "Positive", 0.5),
            (T0 + dt.timedelta(minutes=60), "Positive", 0.25), (T0, "Negative", -1.0)]
    df = spark.createDataFrame(rows, "ts timestamp, sentiment string, v double")
    got = {(r["window_start"], r["sentiment"]): (r["n"], r["avg_value"])
           for r in timeline.trend(df, "ts", "sentiment", "v").collect()}
    assert got == {(T0, "Positive"): (2, 0.75), (T0, "Negative"): (1, -1.0),
                   (T0 + dt.timedelta(hours=1), "Positive"): (1, 0.25)}


def _pushed(df):
    import re
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"PushedFilters: \[([^\]]*)\]", plan)


def test_horizons_reach_the_parquet_scan(spark):
    """Also the default ones: a range on the raw column, not just a null check."""
    from bellwether.sources import tables as TB
    ev = TB.load(spark, "/root/testdata/sf0.001", "events")
    for df in (timeline.retention_window(ev, "ts", "7 days", horizon="2024-01-20 00:00:00"),
               timeline.retention_window(ev, "ts", "7 days")):
        pushed = _pushed(df)
        assert len(pushed) == 1 and "GreaterThanOrEqual(ts" in pushed[0]
    for df in (timeline.today_partition(ev, "ts"), timeline.today_partition(ev, "ts", "2024-01-20")):
        pushed = _pushed(df)
        assert len(pushed) == 1 and "GreaterThanOrEqual(ts" in pushed[0] and "LessThan(ts" in pushed[0]


def test_empty_frames(spark):
    empty = frame(spark, [0]).limit(0)
    assert timeline.retention_window(empty, "ts", "7 days").count() == 0
    assert timeline.today_partition(empty, "ts").count() == 0
