"""F1, D2, A1-A3, F4, F5, O1-O3, P16, P17, P19, P20."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bellwether import schemas
from bellwether.functions.text import capitalize, round_stored
from bellwether.operators import serving

SCORED_COLS = "offset long, title string, source string, publishedAt string, sentiment string, " \
              "confidence float, link string"


def test_required_keys_each_missing(spark):
    full = ["t", "s", "2024-01-01 00:00:00", "Positive", 0.5, "l"]
    rows = [(0, *full)]
    for i in range(6):
        r = list(full)
        r[i] = None
        rows.append((i + 1, *r))
    df = spark.createDataFrame(rows, SCORED_COLS)
    assert [r["offset"] for r in serving.require_keys(df).collect()] == [0]


def test_dedupe_title_published(spark):
    rows = [(5, "a", "s", "p1", "Positive", 0.5, "l"),
            (2, "a", "s", "p1", "Negative", -0.5, "l2"),   # earlier offset wins
            (3, "a", "s", "p2", "Neutral", 0.0, "l"),      # other publishedAt kept
            (9, None, "s", "p1", "Neutral", 0.0, "l"),
            (8, None, "s", "p1", "Neutral", 0.0, "l")]
    out = {(r["title"], r["publishedAt"]): r["offset"]
           for r in serving.dedupe_title_published(spark.createDataFrame(rows, SCORED_COLS)).collect()}
    assert out == {("a", "p1"): 2, ("a", "p2"): 3, (None, "p1"): 8}


def test_dedupe_is_idempotent(spark):
    rows = [(i, f"t{i % 3}", "s", "p", "Neutral", 0.0, "l") for i in range(12)]
    once = serving.dedupe_title_published(spark.createDataFrame(rows, SCORED_COLS))
    twice = serving.dedupe_title_published(once)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_counts_zero_filled_unknown_dropped(spark):
    df = spark.createDataFrame([("positive",), ("POSITIVE",), ("Neutral",), ("mixed",)], "sentiment string")
    got = [(r["sentiment"], r["n"]) for r in serving.sentiment_counts(df).collect()]
    assert got == [("Positive", 2), ("Negative", 0), ("Neutral", 1)]


def test_counts_sum_to_known_rows(spark):
    df = spark.createDataFrame([(l,) for l in ["Positive"] * 3 + ["Negative"] * 2 + ["x"]], "sentiment string")
    assert sum(r["n"] for r in serving.sentiment_counts(df).collect()) == 5


def test_capitalize_and_round(spark):
    df = spark.createDataFrame([("nEGATIVE", 2.6755), ("", 0.125)], "s string, c double")
    got = df.select(capitalize("s").alias("s"), round_stored("c").alias("c")).collect()
    assert [tuple(r) for r in got] == [("Negative", 2.676), ("", 0.125)]


def test_distinct_sources_first_seen(spark):
    df = spark.createDataFrame([(3, "b"), (1, "a"), (2, "b"), (4, None)], "offset long, source string")
    got = [(r["source"], r["first_seen"]) for r in serving.distinct_sources(df, "offset").collect()]
    assert got == [("a", 1), ("b", 2), (None, 4)]


def test_filters(spark):
    df = spark.createDataFrame([("Positive", "x"), ("Negative", "y"), ("Negative", "x")],
                               "sentiment string, source string")
    assert serving.filter_sentiment(df, "All").count() == 3
    assert serving.filter_sentiment(df, "Negative").count() == 2
    assert serving.filter_sources(df, []).count() == 3
    assert serving.filter_sources(df, ["nope"]).count() == 0
    both = serving.filter_sources(serving.filter_sentiment(df, "Negative"), ["x"])
    assert serving.filtered_count(both).collect()[0]["n_rows"] == 1


def test_newest_first_nat_last_and_cards(spark):
    rows = [("t1", "s", "2024-01-01 10:00:00", "Positive", 0.125, "l1"),
            ("<b>t2</b>", "s&p", "not a time", "Negative", -0.5, "l2"),
            ("t3", "s", "2024-01-02 09:00:00", "Neutral", 0.0, "l3"),
            ("t0", "s", "2024-01-02 09:00:00", "Neutral", 0.0, "l0")]
    df = spark.createDataFrame(rows, "title string, source string, publishedAt string, "
                                     "sentiment string, confidence double, link string")
    cards = serving.headline_cards(df).collect()
    assert [c["title"] for c in cards] == ["t0", "t3", "t1", "<b>t2</b>"]
    assert cards[2]["card"] == ("**t1**  \n_Source_: s  \n_Published at_: 2024-01-01 10:00:00  \n"
                                "_Sentiment_: Positive (0.13)  \n[Link to article](l1)")
    assert "&lt;b&gt;t2&lt;/b&gt;" in cards[3]["card"] and "s&amp;p" in cards[3]["card"]
    assert "_Published at_: NaT" in cards[3]["card"]
    oldest = [r["title"] for r in serving.oldest_first(df).collect()]
    assert oldest == ["t1", "t0", "t3", "<b>t2</b>"]
    missing = df.limit(1).withColumn("publishedAt", F.lit(None).cast("string")).withColumn("title", F.lit("tn"))
    assert [r["title"] for r in serving.oldest_first(df.unionByName(missing)).collect()][-1] == "tn"


@pytest.mark.parametrize("n,invalid,expected", [
    (28, [], list(range(28))),
    (31, [], list(range(31))),
    (40, [], list(range(31))),
    (40, [30, 31], list(range(30)) + [32]),
    (40, [5, 29], [i for i in range(30) if i not in (5, 29)] + [30]),
])
def test_capped_take(spark, n, invalid, expected):
    rows = [(0, 100 + i, None if i in invalid else "ok") for i in range(n)]
    df = spark.createDataFrame(rows, "partition int, offset long, v string")
    got = sorted(r["idx"] for r in serving.capped_take(df, F.col("v").isNotNull()).collect())
    assert got == expected


def test_reconcile_columns(spark):
    df = spark.createDataFrame([("t", "Positive", "s", "p", 1)],
                               "title string, sentiment string, source string, publishedAt string, extra int")
    out = serving.reconcile_columns(df, schemas.HISTORY)
    assert out.columns == [f.name for f in schemas.HISTORY.fields]
    r = out.collect()[0]
    assert r["link"] == "" and r["confidence"] is None and r["sentiment"] == "Positive"


def test_parse_records_probe_and_junk(spark):
    rows = [(0, 0, '{"title":"t","source":"s","publishedAt":"p","link":"l","sentiment":"Neutral","confidence":0.0}'),
            (0, 1, '{"message":"Kafka connection test"}'),
            (0, 2, "not json"),
            (0, 3, None)]
    df = spark.createDataFrame(rows, schemas.TOPIC_RECORD)
    got = serving.require_keys(serving.parse_records(df)).collect()
    assert [r["offset"] for r in got] == [0]


def test_empty_inputs_give_typed_results(spark):
    empty = spark.createDataFrame([], schemas.HISTORY)
    assert [(r["sentiment"], r["n"]) for r in serving.sentiment_counts(empty).collect()] == \
        [("Positive", 0), ("Negative", 0), ("Neutral", 0)]
    cards = serving.headline_cards(empty)
    assert cards.count() == 0 and "card" in cards.columns
    recs = spark.createDataFrame([], schemas.TOPIC_RECORD)
    assert serving.capped_take(recs, F.col("value").isNotNull()).count() == 0
    assert serving.filtered_count(empty).collect()[0]["n_rows"] == 0


def test_capped_take_has_one_index_over_the_read(spark):
    """Offsets may have gaps and there may be several partitions: 31 records at most in all."""
    rows = ([(1, 7 + 3 * i, "ok") for i in range(40)] + [(0, 500 + 10 * i, None if i % 5 == 0 else "ok") for i in range(20)])
    df = spark.createDataFrame(rows, schemas.TOPIC_RECORD)
    got = sorted((r["idx"], r["partition"], r["offset"]) for r in
                 serving.capped_take(df, F.col("value").isNotNull()).collect())
    first = [(i, 0, 500 + 10 * i) for i in range(20) if i % 5]
    assert got == first + [(20 + i, 1, 7 + 3 * i) for i in range(11)]
    plan = serving.capped_take(df, F.col("value").isNotNull())._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_card_with_missing_fields_is_still_a_card(spark):
    df = spark.createDataFrame([("t", None, None, "Positive", None, None)],
                               "title string, source string, publishedAt string, sentiment string, confidence double, link string")
    card = serving.headline_cards(df).collect()[0]["card"]
    assert card.startswith("**t**") and "_Source_:   " in card and card.endswith("()")
