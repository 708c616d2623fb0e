"""The scorer and the topic are evaluated once per query, whatever is filtered on top."""

import pytest

from bellwether.operators import serving
from bellwether.plans import queries as Q
from bellwether.sources import tables as TB

SF = "/root/testdata/sf0.001"
SCORING = ["score_headlines", "sentiment_counts", "sentiment_json", "filter_sentiment_source", "filtered_count",
           "reconcile_columns", "scored_projection", "json_output", "required_keys", "bad_sentiment",
           "dedupe_title_published", "distinct_sources", "sentiment_trend"]
LANDED = ["latest_cards", "oldest_first", "scored_retention", "capped_take", "latest_counts"]


def tokenisers(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all")


@pytest.mark.parametrize("name", SCORING)
def test_one_scorer_in_the_plan(spark, name):
    assert tokenisers(Q.registry()[name](spark, SF)) == 1


@pytest.mark.parametrize("name", LANDED)
def test_landed_scores_are_not_computed_again(spark, name):
    assert tokenisers(Q.registry()[name](spark, SF)) == 0


def test_capped_take_reads_the_contents_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(serving, "land", lambda df, name: seen.append(df) or df.sparkSession.createDataFrame(df.collect(), df.schema))
    out = serving.capped_take(serving.parse_records(TB.scored_records(spark, SF)), serving.has_required_keys(), 3)
    assert len(seen) == 1 and tokenisers(seen[0]) == 1
    assert [r["idx"] for r in out.orderBy("idx").collect()] == [0, 1, 2, 3]
