"""The runnable jobs, end to end on the file stand-in."""

import json
import os

import time

from bellwether import schemas
from bellwether.jobs import Layout, run_ingest, serve, start_jobs
from bellwether.sources import files as FS


def test_jobs_once_on_files(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    lines = [json.dumps({"title": t, "source": "s", "publishedAt": "2024-06-28 10:00:00",
                         "link": "l", "fetched_at": 1719568800.0 + i * 600})
             for i, t in enumerate(["great news", "terrible loss", "plain", "great news"])]
    lines.append(json.dumps({"message": "Kafka connection test"}))
    with open(os.path.join(raw, "a.json"), "w") as f:
        f.write("\n".join(lines) + "\n")
    layout = Layout(os.path.join(tmp_dir, "root"))
    for q in start_jobs(spark, "files", layout, raw_folder=raw, once=True):
        q.awaitTermination()
        assert q.exception() is None
    hist = {r["title"]: r["sentiment"] for r in FS.read_history(spark, layout.path("history")).collect()}
    assert hist == {"great news": "Positive", "terrible loss": "Negative", "plain": "Neutral"}
    junk = spark.read.parquet(layout.path("quarantine")).collect()
    assert [(json.loads(r["value"]), r["reason"]) for r in junk] == [
        ({"message": "Kafka connection test"}, "not a news message")]
    assert os.path.isdir(layout.path("trend"))


def test_cli_once(spark, tmp_dir):
    from bellwether.jobs import main
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    with open(os.path.join(raw, "a.json"), "w") as f:
        f.write(json.dumps({"title": "good", "source": "s", "publishedAt": "2024-06-28 10:00:00",
                            "link": "l", "fetched_at": 1719568800.0}) + "\n")
    root = os.path.join(tmp_dir, "root")
    main(["stream", "--source", "files", "--raw", raw, "--root", root, "--once"])
    assert FS.read_history(spark, os.path.join(root, "history")).count() == 1


def test_jobs_start_before_anything_has_landed(spark, tmp_dir):
    """Without --once the readers of the scored folder and the history start on empty folders."""
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    layout = Layout(os.path.join(tmp_dir, "root"))
    queries = start_jobs(spark, "files", layout, raw_folder=raw)
    try:
        time.sleep(3)
        assert all(q.isActive and q.exception() is None for q in queries) and len(queries) == 3
    finally:
        for q in queries:
            q.stop()


def test_ingest_then_stream_then_serve(spark, tmp_dir):
    layout = Layout(os.path.join(tmp_dir, "root"))
    def art(title, when="2024-06-28T10:00:00Z", name="s"):
        return {"title": title, "url": "u", "publishedAt": when, "source": {"name": name}}
    rows = [("us", 0, "ok", [art("great news"), art("bad day", name="t"), art("no time", when="soon")]),
            ("cn", 1, "ok", [art("great news", when="2024-06-28T11:00:00Z")]), ("jp", 2, "error", [art("lost")])]
    counts = run_ingest(spark, spark.createDataFrame(rows, schemas.ENVELOPE), layout, 1719568800.0).collect()[0]
    assert tuple(counts) == (4, 3, 2, 1)
    assert [r["reject_reason"] for r in spark.read.parquet(layout.path("rejected")).collect()] == ["unparsable publishedAt"]
    start_jobs(spark, "files", layout, raw_folder=layout.path("raw"), once=True)
    views = serve(spark, layout, "Negative", advance=True)
    for name in ("latest", "history"):
        assert {r["sentiment"]: r["n"] for r in views[name]["counts"].collect()} == {"Positive": 1, "Negative": 1, "Neutral": 0}
        assert views[name]["n_rows"].collect()[0][0] == 1
        assert "**bad day**" in views[name]["cards"].collect()[0]["card"]
        assert {r[0] for r in views[name]["sources"].collect()} == {"s", "t"}
    again = serve(spark, layout, sources=["s"])                    # the position was committed: nothing is unread
    assert again["latest"]["n_rows"].collect()[0][0] == 0
    assert again["history"]["n_rows"].collect()[0][0] == 1


def scored_line(offset, title, partition=0, key=None, pub=None, **kw):
    value = {"title": title, "source": "s", "publishedAt": pub or f"2024-06-{1 + offset % 28:02} 10:00:00", "link": "l",
             "fetched_at": 1.0, "sentiment": "Positive", "confidence": 0.5, **kw}
    return json.dumps({"partition": partition, "offset": offset, "value": json.dumps(value), **({"key": key} if key else {})})


def test_position_over_three_partitions_survives_a_crash(spark, tmp_dir, monkeypatch):
    """Views first, then the position; nothing is lost between the two, and nothing that lands meanwhile."""
    from bellwether.sources import cursor
    layout = Layout(os.path.join(tmp_dir, "root"))
    folder = layout.path("scored")
    os.makedirs(folder)

    def land_lines(name, lines):
        with open(os.path.join(folder, name), "w") as f:
            f.write("\n".join(lines) + "\n")
    land_lines("1.json", [scored_line(5 + i, f"p0-{i}") for i in range(20)] + [scored_line(40, "p0-junk").replace("title", "label")]
               + [scored_line(3 * i, f"p1-{i}", 1) for i in range(30)] + [scored_line(7, "p2-0", 2)])
    with monkeypatch.context() as m:
        m.setattr(cursor, "store", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        try:
            serve(spark, layout, advance=True)
            raise AssertionError("the crash did not happen")
        except RuntimeError:
            pass
    shown = {r["title"] for r in spark.read.parquet(layout.path("views/latest-cards")).collect()}
    land_lines("2.json", [scored_line(41, "p0-late")])                      # lands after the crash, in a partition that was read
    first = serve(spark, layout, advance=True)["latest"]["cards"].collect()
    assert shown <= {r["title"] for r in first} | {"p1-9", "p1-10"} and "p0-late" in {r["title"] for r in first}
    assert len(first) == 30                          # 20 and one late of partition 0 (one is junk), then partition 1
    position = cursor.load(spark, layout.path("position"))
    assert position[0] == 42 and set(position) == {0, 1}
    assert json.loads(cursor.as_kafka_offsets("t", position, 3)) == {"t": {"0": 42, "1": position[1], "2": -2}}
    seen = [r["title"] for r in first]
    for _ in range(3):
        seen += [r["title"] for r in serve(spark, layout, advance=True)["latest"]["cards"].collect()]
    assert sorted(seen) == sorted([f"p0-{i}" for i in range(20)] + ["p0-late", "p2-0"] + [f"p1-{i}" for i in range(30)])
    assert json.loads(cursor.as_kafka_offsets("t", cursor.load(spark, layout.path("position")), 3))["t"]["2"] == 8


def test_records_of_a_retried_batch_are_skipped(spark, tmp_dir):
    """K1: the same batch written again (at least once) changes nothing downstream."""
    from bellwether.operators import serving as SV
    from bellwether.streaming.scoring import parse_news, score_batch, scored_values
    raw = spark.createDataFrame([(0, k, json.dumps({"title": f"good {k}", "source": "s", "publishedAt": "2024-06-28 10:00:00",
                                                    "link": "l", "fetched_at": 1719568800.0})) for k in range(4)],
                                "partition int, offset long, value string")
    values = scored_values(score_batch(parse_news(raw)))
    assert values.columns == ["key", "value"]
    folder = os.path.join(tmp_dir, "topic")
    os.makedirs(folder)
    lines = [(r["key"], r["value"]) for r in values.collect()]
    with open(os.path.join(folder, "a.json"), "w") as f:
        for offset, (key, value) in enumerate(lines + lines[1:] + [(None, "x"), (None, "x")]):
            f.write(json.dumps({"partition": 0, "offset": offset, "value": value, **({"key": key} if key else {})}) + "\n")
    once = SV.skip_repeats(FS.read_topic(spark, folder, keyed=True))
    assert sorted(r["offset"] for r in once.collect()) == [0, 1, 2, 3, 7, 8]


def test_pages_joined_are_the_full_sort(spark, tmp_dir):
    from bellwether.sources.paging import days_of_page, history_page, newest_first_order, place_of
    from bellwether.operators.serving import newest_first
    from bellwether.functions.parsing import lenient_timestamp
    rows = [(f"t{k % 13}", "ab"[k % 2], f"2024-06-{1 + k % 9:02} {k % 5:02}:00:00", "Positive" if k % 3 else "Negative", 0.1, f"l{k}")
            for k in range(120)]
    rows = list({(r[0], r[2]): r for r in rows}.values()) + [("odd", "a", "2024-06-03T01:00:00", "Neutral", 0.0, "l"),
                                                             ("x", "a", "soon", "Neutral", 0.0, "l"), ("w", "a", "never", "Neutral", 0.0, "l")]
    path = os.path.join(tmp_dir, "hist")
    FS.append_history(spark.createDataFrame(rows, schemas.HISTORY), path)
    for label, sources in (("All", None), ("Negative", ["a"])):
        after, got = None, []
        for _ in range(40):
            page = history_page(spark, path, 7, after, label, sources)
            shown = page.orderBy(*newest_first_order()).collect()
            got += [(r["title"], r["publishedAt"]) for r in shown]
            if len(shown) < 7:
                break
            after = place_of(shown[-1])
        whole = FS.read_history(spark, path)
        whole = whole if label == "All" else whole.where("sentiment = 'Negative' AND source = 'a'")
        order = whole.withColumn("published_ts", lenient_timestamp("publishedAt")).orderBy(*newest_first_order()).collect()
        assert got == [(r["title"], r["publishedAt"]) for r in order] and len(got) == newest_first(whole).count()
    assert [str(d) for d in days_of_page(spark, path, 3)] == ["2024-06-09"]          # only the days needed
    plan = history_page(spark, path, 3)._jdf.queryExecution().executedPlan().toString()
    assert "2024-06-09" in plan or "19883" in plan


def test_expiry_lists_then_deletes(spark, tmp_dir):
    from bellwether.jobs import maintain
    layout = Layout(os.path.join(tmp_dir, "root"))
    path = layout.path("history")
    rows = [(f"t{k}", "s", f"2024-06-{1 + k % 10:02} 10:00:00", "Positive", 0.5, "l") for k in range(30)] + [
        ("undated", "s", "soon", "Neutral", 0.0, "l")]
    FS.append_history(spark.createDataFrame(rows, schemas.HISTORY), path)
    listed = maintain(spark, layout, 3, today="2024-06-10").collect()
    assert [(str(r["day"]), r["n"]) for r in listed] == [(f"2024-06-0{d}", 3) for d in range(1, 7)]
    assert FS.read_history(spark, path).count() == 31 and not FS.path_exists(spark, layout.path("expired"))
    maintain(spark, layout, 3, dry_run=False, today="2024-06-10")
    left = FS.read_history(spark, path)
    assert left.count() == 13 and left.agg({"publishedAt": "min"}).first()[0].startswith("2024-06-07")
    assert spark.read.parquet(layout.path("expired")).count() == 6
    from bellwether.operators import facets
    from bellwether.streaming.serving import facet_table
    assert facets.filtered_count(facet_table(spark, path).read()).first()[0] == 13
    assert maintain(spark, layout, 3, today="2024-06-10").count() == 0
