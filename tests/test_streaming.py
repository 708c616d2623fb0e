"""Streams driven by file replays: scoring, history (D2, K3), trend with late data."""

import datetime as dt
import json
import os

from bellwether.operators import serving
from bellwether.operators.scoring import lexicon_frame
from bellwether.sources import files as FS
from bellwether.streaming.scoring import folder_sink, scoring_stream
import pytest

from bellwether.streaming import runner
from bellwether.streaming.scoring import METRICS_NAME
from bellwether.streaming.serving import history_stream, history_stream_stateful, trend_stream, undated_scored

LEX = {"good": "2.0", "bad": "-2.0"}


_MTIME = [1_700_000_000]


def write_lines(folder, name, lines):
    """Write one replay file; files get increasing mtimes so the file source
    replays them in write order."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    _MTIME[0] += 10
    os.utime(path, (_MTIME[0], _MTIME[0]))


_OFFSET = [0]


def write_records(folder, name, values):
    """Records of a topic stand-in, with offsets in order of arrival."""
    lines = []
    for v in values:
        _OFFSET[0] += 1
        lines.append(json.dumps({"partition": 0, "offset": _OFFSET[0], "value": v}))
    write_lines(folder, name, lines)


def read_one_by_one(spark, folder):
    return FS.read_topic_stream(spark, folder, max_files_per_trigger=1)


def run(writer):
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    assert q.exception() is None
    return q


def msg(title, fetched_at=1719576200.987, **kw):
    d = {"title": title, "source": "s", "publishedAt": "2024-06-28 12:00:00",
         "link": "l", "fetched_at": fetched_at}
    d.update(kw)
    return json.dumps(d)


def test_scoring_stream_quarantines_junk(spark, tmp_dir):
    raw_dir = os.path.join(tmp_dir, "raw")
    write_lines(raw_dir, "a.json", [
        msg("good news"), json.dumps({"message": "Kafka connection test"}),
        json.dumps({"test": "connection"}), "not json", "",
        msg("bad", fetched_at="x"), msg("", fetched_at=None), msg("plain", fetched_at=1719576200),
        msg("huge", fetched_at=1e300), msg("ms", fetched_at=1719576200000), msg("far", fetched_at=7e9), msg("nan", fetched_at=-1e18),
        msg("good", extra="unknown key")])
    out_dir, junk_dir = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "junk")
    raw = FS.read_raw_stream(spark, raw_dir)
    run(scoring_stream(raw, folder_sink(out_dir), os.path.join(tmp_dir, "ck"),
                       quarantine=folder_sink(junk_dir),
                       lexicon=lexicon_frame(spark, LEX)))
    vals = [json.loads(r["value"]) for r in FS.read_topic(spark, out_dir).collect()]
    by_title = {v["title"]: v for v in vals}
    assert set(by_title) == {"good news", "bad", "", "plain", "good"}
    assert by_title["good news"]["sentiment"] == "Positive"
    assert by_title["good news"]["fetched_at_ts"].startswith("2024-06-28T12:03:20")  # fraction dropped
    assert "fetched_at" not in by_title["bad"]          # wrong type nulls one field, omitted in JSON
    assert by_title["bad"]["sentiment"] == "Negative"
    assert by_title[""]["sentiment"] == "Neutral" and by_title[""]["confidence"] == 0.0
    junk = {(r["value"], r["reason"]) for r in spark.read.parquet(junk_dir).collect()}
    assert junk == {
        (json.dumps({"message": "Kafka connection test"}), "not a news message"),
        (json.dumps({"test": "connection"}), "not a news message"), ("not json", "not a news message"),
        ("", "not a news message"), (msg("huge", fetched_at=1e300), "fetched_at is no time"),
        (msg("nan", fetched_at=-1e18), "fetched_at is no time"),
        (msg("ms", fetched_at=1719576200000), "fetched_at is no time"),
        (msg("far", fetched_at=7e9), "fetched_at lies in the future")}


@pytest.mark.parametrize("stream_fn", [history_stream, history_stream_stateful])
def test_history_stream_equals_batch_and_restarts(spark, tmp_dir, stream_fn):
    src = os.path.join(tmp_dir, "scored")
    def rec(title, pub, fetched, label="Positive", conf=0.43999999):
        return json.dumps({"title": title, "source": "s", "publishedAt": pub, "link": "l",
                           "fetched_at": fetched, "sentiment": label, "confidence": conf,
                           "fetched_at_ts": dt.datetime.fromtimestamp(fetched, dt.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")})
    base = 1719576000.0
    write_records(src, "1.json", [rec("a", "2024-06-28 10:00:00", base), rec("b", "2024-06-28 10:00:00", base),
                                json.dumps({"title": "missing keys"})])
    write_records(src, "2.json", [rec("a", "2024-06-28 10:00:00", base + 3600),      # refetch, 1 h later
                                rec("a", "2024-06-28 11:00:00", base + 3600, "negative")])
    write_records(src, "3.json", [rec("a", "2024-06-28 10:00:00", base + 3 * 3600),
                                rec("b", "2024-06-28 10:00:00", base + 2 * 3600)])
    hist, ck = os.path.join(tmp_dir, "hist"), os.path.join(tmp_dir, "ck")
    run(stream_fn(read_one_by_one(spark, src), hist, ck))
    got = sorted(tuple(r) for r in FS.read_history(spark, hist).collect())
    assert got == [("a", "s", "2024-06-28 10:00:00", "Positive", 0.44, "l"),
                   ("a", "s", "2024-06-28 11:00:00", "Negative", 0.44, "l"),
                   ("b", "s", "2024-06-28 10:00:00", "Positive", 0.44, "l")]
    # batch form gives the same rows
    batch = serving.to_served(serving.dedupe_title_published(serving.require_keys(
        serving.parse_records(FS.read_topic(spark, src)))))
    assert sorted(tuple(r) for r in batch.collect()) == got
    # restart from the checkpoint with one more file: nothing written twice
    write_records(src, "4.json", [rec("a", "2024-06-28 10:00:00", base + 4 * 3600),
                                rec("c", "2024-06-28 12:00:00", base + 4 * 3600)])
    run(stream_fn(read_one_by_one(spark, src), hist, ck))
    again = sorted(tuple(r) for r in FS.read_history(spark, hist).collect())
    assert again == sorted(got + [("c", "s", "2024-06-28 12:00:00", "Positive", 0.44, "l")])
    assert FS.read_history(spark, hist, day="2024-06-28").count() == 4
    assert FS.read_history(spark, os.path.join(tmp_dir, "none")).count() == 0


def test_trend_stream_drops_late_rows(spark, tmp_dir):
    src = os.path.join(tmp_dir, "ev")
    t0 = dt.datetime(2024, 1, 1, 10, 0, 0)
    def ev(minutes, label="Positive"):
        return json.dumps({"ts": (t0 + dt.timedelta(minutes=minutes)).isoformat(), "sentiment": label,
                           "v": 1.0})
    write_lines(src, "1.json", [ev(0), ev(5)])
    write_lines(src, "2.json", [ev(120)])                 # 2 h ahead: watermark 11:50 after this batch
    write_lines(src, "3.json", [ev(30), ev(125)])         # late, but the late-row watermark lags a batch: kept
    write_lines(src, "4.json", [ev(35)])                  # late against 11:50: dropped
    write_lines(src, "5.json", [ev(300)])                 # moves the watermark past 12:00 windows
    schema = "ts timestamp, sentiment string, v double"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(src)
    out = os.path.join(tmp_dir, "trend")
    log = runner.log_progress(spark, os.path.join(tmp_dir, "progress"))
    try:
        q = run(trend_stream(stream, out, os.path.join(tmp_dir, "ck"), ts_col="ts", value_col="v"))
        progress = runner.wait_for_batches(spark, os.path.join(tmp_dir, "progress"), q)
    finally:
        spark.streams.removeListener(log)
    got = sorted((r["window_start"].hour, r["n"]) for r in spark.read.parquet(out).collect())
    assert got == [(10, 3), (12, 2)]
    assert runner.rows_dropped(progress, str(q.id)).collect()[0][0] == 1


def test_metrics_of_all_batches_are_kept(spark, tmp_dir):
    """More batches than a query remembers (it keeps its last progress events only)."""
    raw_dir, log_dir = os.path.join(tmp_dir, "raw"), os.path.join(tmp_dir, "progress")
    n = 12
    for i in range(n):
        write_lines(raw_dir, f"{i:03}.json", [msg("good"), "not json"])
    keep = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "5")
    log = runner.log_progress(spark, log_dir)
    try:
        q = run(scoring_stream(FS.read_raw_stream(spark, raw_dir, 1), folder_sink(os.path.join(tmp_dir, "o")),
                               os.path.join(tmp_dir, "ck"), folder_sink(os.path.join(tmp_dir, "q")),
                               lexicon=lexicon_frame(spark, LEX)))
        progress = runner.wait_for_batches(spark, log_dir, q)
    finally:
        spark.streams.removeListener(log)
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", keep)
    assert len(q.recentProgress) < n
    m = runner.progress_metrics(progress, METRICS_NAME, "n_records", "n_messages").collect()
    assert sum(r["n_records"] for r in m) == 2 * n and sum(r["n_messages"] for r in m) == n


def test_history_stream_retry_writes_nothing_twice(spark, tmp_dir):
    """A micro-batch re-run after its write committed adds no rows."""
    from bellwether.streaming import serving as SS
    src = os.path.join(tmp_dir, "scored")
    rec = json.dumps({"title": "a", "source": "s", "publishedAt": "2024-06-28 10:00:00", "link": "l",
                      "fetched_at": 1.0, "sentiment": "Positive", "confidence": 0.5,
                      "fetched_at_ts": "2024-06-28T10:00:00Z"})
    odd = rec.replace("2024-06-28 10:00:00", "not a time")    # lands in the null-day partition
    write_records(src, "1.json", [rec, rec, odd])
    hist = os.path.join(tmp_dir, "hist")
    run(history_stream(read_one_by_one(spark, src), hist, os.path.join(tmp_dir, "ck1")))
    # a fresh checkpoint replays the same batch: the anti-join keeps the history exact
    run(history_stream(read_one_by_one(spark, src), hist, os.path.join(tmp_dir, "ck2")))
    assert FS.read_history(spark, hist).count() == 2


def test_stream_dedupe_keeps_the_first_arrival(spark, tmp_dir):
    """The record with the least offset wins, also against one without an event time."""
    src = os.path.join(tmp_dir, "scored")
    def rec(link, ts):
        return json.dumps({"title": "a", "source": "s", "publishedAt": "2024-06-28 10:00:00", "link": link,
                           "sentiment": "Positive", "confidence": 0.5, **({"fetched_at_ts": ts} if ts else {})})
    write_records(src, "1.json", [rec("first", "2024-06-28T12:00:00Z"), rec("undated", None),
                                  rec("early", "2024-06-28T09:00:00Z")])
    hist = os.path.join(tmp_dir, "hist")
    run(history_stream(read_one_by_one(spark, src), hist, os.path.join(tmp_dir, "ck")))
    assert [r["link"] for r in FS.read_history(spark, hist).collect()] == ["first"]
    undated = undated_scored(FS.read_topic_stream(spark, src)).writeStream.format("parquet").option(
        "path", os.path.join(tmp_dir, "undated")).option("checkpointLocation", os.path.join(tmp_dir, "ck-u"))
    run(undated)
    assert [r["link"] for r in spark.read.parquet(os.path.join(tmp_dir, "undated")).collect()] == ["undated"]
