"""Facets, key index and delta tables: replays, crashes between writes, compaction, odd dates."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from bellwether.operators import facets, serving
from bellwether.sources import files as FS
from bellwether.sources.deltas import DeltaTable
from bellwether.sources.keys import KeyIndex, day_filter
from bellwether.streaming import serving as SS
from test_streaming import read_one_by_one, run, write_records


def rec(title, pub="2024-06-28 10:00:00", label="Positive", source="s", **kw):
    return json.dumps({"title": title, "source": source, "publishedAt": pub, "link": "l", "sentiment": label,
                       "confidence": 0.5, "fetched_at_ts": "2024-06-28T12:00:00Z", **kw})


def facet_rows(spark, hist):
    return sorted((str(r["day"]), r["source"], r["sentiment"], r["n"]) for r in
                  facets.fold(SS.facet_table(spark, hist).read()).collect())


def recounted(spark, hist):
    rows = FS.with_day(FS.read_history(spark, hist))
    return sorted((str(r["day"]), r["source"], r["sentiment"], r["n"]) for r in facets.partial(rows, None).collect())


def test_facets_equal_a_recount_after_repeats_and_compaction(spark, tmp_dir):
    src, hist, ck = (os.path.join(tmp_dir, n) for n in ("scored", "hist", "ck"))
    write_records(src, "1.json", [rec("a"), rec("b", source="t"), rec("a")])
    write_records(src, "2.json", [rec("a"), rec("c", "2024-06-29 10:00:00", "negative"), rec("d", "no time")])
    run(SS.history_stream(read_one_by_one(spark, src), hist, ck))
    assert facet_rows(spark, hist) == recounted(spark, hist)
    SS.facet_table(spark, hist).compact(facets.fold)
    SS.key_index(spark, hist).compact()
    write_records(src, "3.json", [rec("a"), rec("e", label="Neutral"), rec("c", "2024-06-29 10:00:00")])
    write_records(src, "4.json", [rec("e"), rec("d", "no time")])
    run(SS.history_stream(read_one_by_one(spark, src), hist, ck))
    got = facet_rows(spark, hist)
    assert got == recounted(spark, hist) and sum(r[3] for r in got) == 5
    run(SS.history_stream(read_one_by_one(spark, src), hist, os.path.join(tmp_dir, "other-ck")))     # a full replay
    assert facet_rows(spark, hist) == got and FS.read_history(spark, hist).count() == 5
    table = facets.fold(SS.facet_table(spark, hist).read())
    history = FS.read_history(spark, hist)
    assert facets.sentiment_counts(table).collect() == serving.sentiment_counts(history).collect()
    assert facets.filtered_count(table, "Positive", ["s"]).first()[0] == history.where("sentiment = 'Positive' AND source = 's'").count()
    assert [r["source"] for r in facets.distinct_sources(table).collect()] == ["s", "t"]
    assert "title" not in facets.sentiment_counts(table)._jdf.queryExecution().toString()


@pytest.mark.parametrize("broken", ["append_history", "index", "facets"])
def test_a_crash_between_the_writes_of_a_batch(spark, tmp_dir, monkeypatch, broken):
    """Whatever was written before the crash, the repeated batch leaves history, keys and facets as without it."""
    src, hist, ck = (os.path.join(tmp_dir, n) for n in ("scored", "hist", "ck"))
    write_records(src, "1.json", [rec("a"), rec("b")])
    write_records(src, "2.json", [rec("b"), rec("c", "2024-06-30 10:00:00"), rec("d")])
    calls = []

    def failing(real):
        def wrapped(*args, **kw):
            out = real(*args, **kw)
            calls.append(1)
            if len(calls) == 2:
                raise RuntimeError("lost")
            return out
        return wrapped
    with monkeypatch.context() as m:
        if broken == "append_history":
            m.setattr(SS, "append_history", failing(SS.append_history))
        elif broken == "index":
            m.setattr(KeyIndex, "write", failing(KeyIndex.write))
        else:
            m.setattr(DeltaTable, "write", failing(DeltaTable.write))
        with pytest.raises(Exception):
            run(SS.history_stream(read_one_by_one(spark, src), hist, ck))
    run(SS.history_stream(read_one_by_one(spark, src), hist, ck))
    assert sorted(r["title"] for r in FS.read_history(spark, hist).collect()) == ["a", "b", "c", "d"]
    assert facet_rows(spark, hist) == recounted(spark, hist)
    assert SS.key_index(spark, hist).table().select("key").distinct().count() == 4


def test_an_odd_date_reads_no_extra_days(spark, tmp_dir):
    index = KeyIndex(spark, os.path.join(tmp_dir, "keys"), buckets=3)
    days = spark.range(200).selectExpr("unhex(md5(cast(id as string))) AS key", "date_add(DATE '2024-01-01', int(id % 40)) AS day")
    index.write(days, "s", 0)
    batch = spark.createDataFrame([(dt.date(1970, 1, 1),), (dt.date(2024, 1, 5),), (dt.date(2099, 1, 1),)], "day date")
    rows = batch.join(days, "day", "left").select("key", "day")
    fresh = index.unseen(rows, day_filter(rows), "s", 1)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    scan = [x for x in plan.splitlines() if "FileScan parquet" in x and "keys-" not in x and "Bucketed: true" in x]
    assert len(scan) == 1 and "SelectedBucketsCount: 3 out of 3" in scan[0]
    files = fresh._jdf.queryExecution().executedPlan()
    assert "2024-01-05" in plan or "19727" in plan                      # the days are a partition filter
    index_side = plan[plan.index(scan[0]) - 2000: plan.index(scan[0])].splitlines()[-3:]
    assert not any("Exchange" in x for x in index_side)                 # no index row moves
    assert fresh.count() == 2 and files is not None


def test_key_index_is_found_again_and_compacts(spark, tmp_dir):
    where = os.path.join(tmp_dir, "keys")
    index = KeyIndex(spark, where, buckets=2)
    def keys(ids):
        return spark.createDataFrame([(i, dt.date(2024, 1, 1 + i % 2) if i != 7 else None) for i in ids], "id int, day date").selectExpr(
            "unhex(md5(cast(id as string))) AS key", "day")
    for b in range(4):
        index.write(keys([10 * b, 10 * b + 1, 7]), "s", b)
    index.write(keys([0, 1]), "s", 0)                                   # a batch that is run again replaces itself
    before = {bytes(r["key"]) for r in index.table().collect()}
    index.compact()
    index.write(keys([99]), "s", 4)
    spark.sql(f"DROP TABLE {index.name}")                               # another session knows nothing of the table
    again = KeyIndex(spark, where)
    assert again.buckets == 2 and {bytes(r["key"]) for r in again.table().collect()} >= before
    parts = {(r["stream"], r["batch"]) for r in again.table().select("stream", "batch").distinct().collect()}
    assert ("s", 3) in parts and ("s", 1) not in parts
    assert again.unseen(keys([0, 11, 99, 500]), F.lit(True), "s", 5).count() == 1


def test_delta_table_counts_every_batch_once(spark, tmp_dir):
    schema = facets.SCHEMA
    table = DeltaTable(spark, os.path.join(tmp_dir, "t"), schema)
    def rows(n):
        return spark.createDataFrame([(dt.date(2024, 1, 1), "s", "Positive", n, n)], schema)
    assert table.read().count() == 0
    for b in range(3):
        table.write(rows(b + 1), "x", b)
    table.write(rows(10), "x", 2)                                      # the newest batch again
    total = lambda: facets.fold(table.read()).first()["n"]
    assert total() == 13
    table.compact(facets.fold)
    assert total() == 13 and FS.list_folder(spark, f"{table.path}/delta/stream=x") == ["batch=2"]
    table.write(rows(20), "x", 2)                                      # and once more after a compaction
    table.write(rows(5), "y", 0)
    assert total() == 28
    table.write(rows(7), "x", 1)                                       # a batch that the base covers is not counted twice
    assert total() == 28
    table.compact(facets.fold)
    table.compact(facets.fold)
    assert total() == 28
    FS.delete(spark, f"{table.path}/base/version=3/rows/_SUCCESS")     # a compaction that did not finish is not read
    assert DeltaTable(spark, table.path, schema)._version() == 2


def test_a_history_without_index_gets_one_even_after_a_crash(spark, tmp_dir, monkeypatch):
    """The keys and facets of an older history are made at the first use; a crash while they are made is made good."""
    src, hist, ck = (os.path.join(tmp_dir, n) for n in ("scored", "hist", "ck"))
    old = [("a", "s", "2024-06-28 10:00:00", "Positive", 0.5, "l"), ("z", "s", "2024-06-01 10:00:00", "Negative", 0.5, "l")]
    from bellwether import schemas
    FS.append_history(spark.createDataFrame(old, schemas.HISTORY), hist)
    with monkeypatch.context() as m:
        m.setattr(KeyIndex, "write", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            SS.key_index(spark, hist)
        m.setattr(DeltaTable, "compact", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            SS.facet_table(spark, hist)
    write_records(src, "1.json", [rec("a"), rec("b")])
    run(SS.history_stream(read_one_by_one(spark, src), hist, ck))
    assert sorted(r["title"] for r in FS.read_history(spark, hist).collect()) == ["a", "b", "z"]
    assert facet_rows(spark, hist) == recounted(spark, hist)


def parquet_files(folder):
    return [os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")]


def test_a_batch_of_many_days_costs_files_by_its_days_not_by_tasks(spark, tmp_dir):
    """The files of the index grow with the days of a batch only, whatever the number of shuffle partitions."""
    keys = spark.range(3_000).selectExpr("unhex(md5(cast(id as string))) AS key", "date_add(DATE '2024-01-01', int(id % 30)) AS day")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        index = KeyIndex(spark, os.path.join(tmp_dir, "keys"))
        for b in range(2):
            index.write(keys, "s", b)
        files = parquet_files(index.path)
        fresh = index.unseen(keys.unionAll(keys.limit(0)), F.lit(True), "s", 2)
        assert fresh.count() == 0 and index.table().count() == 6_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(files) <= 2 * 30 * index.buckets <= 2 * 30 * 8


def test_new_rows_stay_cached_while_their_keys_are_written(spark, tmp_dir):
    """The new rows of a batch do not read the index that is written from them; the same rows as without landing."""
    index = KeyIndex(spark, os.path.join(tmp_dir, "keys"), buckets=3)
    def keys(lo, hi):
        return spark.range(lo, hi).selectExpr("unhex(md5(cast(id as string))) AS key", "DATE '2024-01-01' AS day", "id")
    index.write(keys(0, 50), "s", 0)
    rows = keys(40, 60).unionAll(spark.createDataFrame([(None, None, -1)], "key binary, day date, id long"))
    new = index.landed_unseen(rows, day_filter(rows), "s", 1).persist()
    try:
        assert index.name not in new._jdf.queryExecution().analyzed().toString()
        want = sorted(r["id"] for r in index.unseen(rows, day_filter(rows), "s", 1).collect())
        assert sorted(r["id"] for r in new.collect()) == want == [-1, *range(50, 60)]
        index.write(new.where("key IS NOT NULL"), "s", 1)
        assert new.storageLevel.useMemory and new.count() == 11
        assert index.landed_unseen(rows, day_filter(rows), "s", 2).count() == 1      # the next batch has seen them
    finally:
        new.unpersist()
