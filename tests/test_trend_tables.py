"""Open windows by upsert, late rows kept: against the batch form after every batch."""

import datetime as dt
import json
import os
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from bellwether.operators.timeline import trend
from bellwether.sources import files as FS
from bellwether.streaming import serving as SS
from bellwether.streaming.trend import LateTrend, compact_open_trend, late_trend_stream, open_trend, open_trend_stream
from test_streaming import read_one_by_one, run, write_lines, write_records

SCHEMA = "id long, ts timestamp, sentiment string, v double"
T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def ev(k, minutes, label="Positive"):
    return json.dumps({"id": k, "ts": (T0 + dt.timedelta(minutes=minutes)).isoformat() if minutes is not None else None,
                       "sentiment": label, "v": float(k % 4)})


def table(df):
    return sorted((r["window_start"], r["sentiment"], r["n"], r["sum_value"]) for r in df.collect())


def test_open_windows_equal_the_batch_form_after_every_batch(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, n) for n in ("in", "out", "ck"))
    rng = random.Random(1)
    for b in range(4):
        write_lines(src, f"{b}.json", [ev(k, 50 * b + rng.randrange(60), rng.choice(["Positive", "Negative"])) for k in range(30)])
        stream = spark.readStream.schema(SCHEMA).json(src)
        run(open_trend_stream(stream, out, ck, ts_col="ts", value_col="v", delay="3 hours"))
        got = table(open_trend(spark, out, "sentiment", T.DoubleType()))
        assert got == table(trend(spark.read.schema(SCHEMA).json(src), "ts", "sentiment", "v"))
        if b == 2:
            compact_open_trend(spark, out, "sentiment", T.DoubleType())
            assert table(open_trend(spark, out, "sentiment", T.DoubleType())) == got


def test_late_rows_are_kept_and_merged(spark, tmp_dir):
    src, out, ck = (os.path.join(tmp_dir, n) for n in ("in", "out", "ck"))
    batches = [[(0, 0), (1, 5)], [(2, 120)], [(3, 30), (4, 125), (5, 59)], [(6, None), (7, 300)], [(8, 121), (9, 295)]]
    stream = lambda: spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(src)
    tables = lambda: LateTrend(spark, out, stream().schema, "ts", "sentiment", "v")
    for b, rows in enumerate(batches):
        write_lines(src, f"{b}.json", [ev(k, m) for k, m in rows])
        run(late_trend_stream(stream(), out, ck, ts_col="ts", value_col="v"))
        if b == 3:
            tables().compact()
    late = {r["id"] for r in tables().late.read().collect()}
    assert late == {3, 5, 6, 8}                     # behind the watermark of the batches before, or without a time
    every = spark.read.schema(SCHEMA).json(src)
    assert table(tables().merged()) == table(trend(every.where("ts IS NOT NULL"), "ts", "sentiment", "v"))
    on_time = every.where(~F.col("id").isin(late))
    assert table(tables().on_time()) == table(trend(on_time, "ts", "sentiment", "v"))
    # a batch that is run again writes the same once more in place
    stream_, batch = tables().marks.read().orderBy(F.desc("batch")).first()[:2]
    again = spark.read.schema(SCHEMA).json(os.path.join(src, "4.json"))
    tables().add(again, stream_, batch)
    assert table(tables().merged()) == table(trend(every.where("ts IS NOT NULL"), "ts", "sentiment", "v"))


def test_two_fetches_lose_no_headline(spark, tmp_dir):
    """The second fetch has headlines published long before those of the first; the trend of the job has all of them."""
    src, hist = os.path.join(tmp_dir, "scored"), os.path.join(tmp_dir, "hist")

    def rec(title, pub, fetched):
        return json.dumps({"title": title, "source": "s", "publishedAt": pub, "link": "l", "sentiment": "Positive",
                           "confidence": 0.5, **({"fetched_at_ts": fetched} if fetched else {})})
    fetches = [[rec("a", "2024-06-28 12:00:00", "2024-06-28T12:30:00Z"), rec("b", "2024-06-28 11:00:00", "2024-06-28T12:30:00Z")],
               [rec("c", "2024-06-28 10:30:00", "2024-06-28T13:30:00Z"), rec("d", "2024-06-28 09:00:00", None),
                rec("e", "no time", None)],
               [rec("f", "2024-06-28 15:00:00", "2024-06-28T15:30:00Z")], [rec("g", "2024-06-28 10:00:00", "2024-06-28T15:31:00Z")]]
    stream = lambda: SS.history_as_stream(spark, hist)
    out = os.path.join(tmp_dir, "trend")
    for k, values in enumerate(fetches):
        write_records(src, f"{k}.json", values)
        run(SS.history_stream(read_one_by_one(spark, src), hist, os.path.join(tmp_dir, "ck")))
        run(late_trend_stream(stream(), out, os.path.join(tmp_dir, "ck-trend"), ts_col="ts"))
    tables = LateTrend(spark, out, stream().schema, "ts", "sentiment", "confidence")
    assert sorted(r["title"] for r in tables.late.read().collect()) == ["d", "e"]       # published 09:00, never fetched in time
    got = {r["window_start"].strftime("%H"): r["n"] for r in tables.merged().collect()}
    assert got == {"12": 2, "13": 1, "09": 1, "15": 2} and FS.read_history(spark, hist).count() == 7
