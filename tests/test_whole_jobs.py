"""Registered queries do their whole job: every document scored with the graded valences, none left out by the adapters."""

import math

import duckdb
import pytest

from bellwether import constants as K
from bellwether.plans import queries as Q
from bellwether.plans.oracle import oracle_sql
from tools.oracle_check import rows_key, type_mismatches

# (doc_id, text, lang, source); the words of a pair share a step but not a valence
ROWS = [(1, "great", "en", "src1"), (2, "best", "en", "src2"), (3, "nothing here", "de", "src3"),
        (7, "good", "en", "src4"), (8, "better", "en", "src5"), (9, "surge", "en", "src1"), (10, "soar", "en", "src2"),
        (57, "crisis", "en", "src1"), (58, "worst", "en", "src3"), (61, "kill", "es", "src5"), (62, "hate", "en", "src5")]


def confidence(text):
    v = float(K.GRADED_LEXICON.get(text, 0))
    return v / math.sqrt(v * v + K.NORMALIZATION_ALPHA)


@pytest.fixture
def folder(spark, tmp_dir):
    spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string").coalesce(1) \
        .write.parquet(f"{tmp_dir}/documents.parquet")
    return tmp_dir


def checked(spark, folder, name):
    """The query's rows, after a comparison with its SQL over the same folder."""
    df, sql = Q.registry()[name](spark, folder), oracle_sql()[name]
    rows = df.collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    assert rows_key(map(tuple, rows), df.columns) == rows_key(found.fetchall(), columns)
    assert type_mismatches(df.schema, con, sql) == []
    return rows


def test_the_graded_lexicon_has_the_words_of_the_steps():
    assert set(K.GRADED_LEXICON) == set(K.DEFAULT_LEXICON)
    assert all((float(K.GRADED_LEXICON[w]) > 0) == (float(v) > 0) for w, v in K.DEFAULT_LEXICON.items())


def test_score_headlines_tells_words_of_a_step_apart(spark, folder):
    got = {r["title"]: r["compound"] for r in checked(spark, folder, "score_headlines")}
    assert got == {text: pytest.approx(confidence(text), abs=1e-12) for _, text, _, _ in ROWS}
    assert len(set(got.values())) == len(ROWS) - 1      # "good" and "better" alone have the same valence


def test_sentiment_json_parses_the_result_of_every_document(spark, folder):
    rows = checked(spark, folder, "sentiment_json")
    got = {r["doc_id"]: r["confidence"] for r in rows if not r["is_null"]}
    assert got == {i: pytest.approx(confidence(text), abs=1e-6) for i, text, _, _ in ROWS}
    odd = [(r["doc_id"], r["sentiment"], r["confidence"]) for r in rows if r["is_null"]]
    assert sorted(odd) == [(9, None, None), (10, None, None)]       # beside their own results


def test_oldest_first_serves_every_headline_with_its_own_confidence(spark, folder):
    rows = checked(spark, folder, "oldest_first")
    assert [r["title"] for r in rows] == [text for _, text, _, _ in ROWS]       # doc_id is the minute of publication
    assert [r["rank_in_day"] for r in rows] == list(range(1, len(ROWS) + 1))
    assert [r["confidence"] for r in rows] == [pytest.approx(confidence(text), abs=5.1e-4) for _, text, _, _ in ROWS]
    assert len({r["confidence"] for r in rows}) == len(ROWS) - 1


def test_filter_sentiment_source_filters_the_graded_scores(spark, folder):
    rows = checked(spark, folder, "filter_sentiment_source")
    got = {r["title"]: (r["sentiment"], r["source"], r["confidence"]) for r in rows}
    assert got == {text: ("Negative", source, pytest.approx(confidence(text), abs=5.1e-4))
                   for _, text, _, source in ROWS if confidence(text) <= -0.05 and source in Q.FILTER_SOURCES}
    assert set(got) == {"crisis", "worst", "kill", "hate"} and len({c for _, _, c in got.values()}) == 4


def test_required_keys_keeps_the_label_of_every_document(spark, folder):
    rows = checked(spark, folder, "required_keys")
    got = {(r["partition"], r["offset"]): (r["sentiment"], r["confidence"]) for r in rows}
    assert len(got) == len(rows)
    odd = {k: got.pop(k)[0] for k in list(got) if k[0] == 2}
    assert odd == {(2, 7): "", (2, 57): ""}          # an empty label is a label; the records without one are dropped
    label = {i: "Positive" if confidence(text) >= 0.05 else "Negative" if confidence(text) <= -0.05 else "Neutral"
             for i, text, _, _ in ROWS}
    assert got == {(fetch, i): (label[i], pytest.approx(confidence(text), abs=1e-6))
                   for i, text, lang, _ in ROWS if lang != "es" for fetch in (0, 1)}


def test_sentiment_trend_sums_the_graded_scores(spark, folder):
    rows = checked(spark, folder, "sentiment_trend")
    got = {(r["window_start"], r["sentiment"]): (r["n"], float(r["sum_value"])) for r in rows}
    wanted = {}
    for i, text, _, _ in ROWS:
        c = confidence(text)
        key = f"2024-01-01 0{i // 60}:00:00", "Positive" if c >= 0.05 else "Negative" if c <= -0.05 else "Neutral"
        n, total = wanted.get(key, (0, 0.0))
        wanted[key] = n + 1, total + round(c, 3)
    assert got == {key: (n, pytest.approx(total, abs=1e-9)) for key, (n, total) in wanted.items()}
