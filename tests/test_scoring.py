"""The lexicon scorer, on hand-made rows with hand-computed values."""

import math

import pytest
from pyspark.sql import functions as F

from bellwether.functions.sentiment import label_for_score
from bellwether.operators import scoring as S
from bellwether.operators.scoring import booster_frame, lexicon_frame, negation_frame, score_text
from bellwether.operators.udf_scoring import score_with

LEX = {"good": "2.0", "bad": "-2.0", "worthless": "-3.0"}
BOOST = {"very": "0.293", "slightly": "-0.293"}
NEG = ("not", "don't")


def compound(s):
    return s / math.sqrt(s * s + 15.0)


CASES = [
    ("good", compound(2.0), 1),
    ("Very good", compound(2.293), 1),
    ("slightly good", compound(1.707), 1),
    ("not good", compound(-1.48), 1),
    ("not very good", compound(2.293 * -0.74), 1),
    ("not a b c good", compound(2.0), 1),          # negation 4 tokens back: no flip
    ("not a b good", compound(-1.48), 1),          # 3 tokens back: flipped
    ("don’t good", compound(-1.48), 1),            # curly apostrophe
    ("Good bad", 0.0, 2),
    ("very bad, worthless", compound(-5.293 - 0.293 * 0.95), 2),   # the booster reaches the second word, damped
    ("very a b good", compound(2.0 + 0.293 * 0.9), 1),             # booster 3 tokens back
    ("very a b c good", compound(2.0), 1),
    ("bad but good", compound(-1.0 + 3.0), 2),     # contrast: less before, more after
    ("good but but x", compound(1.0), 1),
    ("good!", compound(2.292), 1),
    ("bad!!!!!!", compound(-2.0 - 4 * 0.292), 1),  # four marks count
    ("this is GOOD", compound(2.733), 1),          # capitals stand out
    ("GOOD NEWS", compound(2.0), 1),               # not when all words are
    ("schön good über", compound(2.0), 1),         # letters of any script are one token
    ("goodé", 0.0, 0),
    ("nothing here 123", 0.0, 0),
    ("", 0.0, 0),
    (None, 0.0, 0),
]


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(i, t) for i, (t, _, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "id long, title string")
    out = score_text(df, "title", key="id", lexicon=lexicon_frame(spark, LEX),
                     boosters=booster_frame(spark, BOOST), negations=negation_frame(spark, NEG))
    return {r["id"]: r for r in out.collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_compound_values(scored, i):
    text, expected, hits = CASES[i]
    r = scored[i]
    assert r["title"] == text
    assert r["compound"] == pytest.approx(expected, abs=1e-12)
    assert r["n_hits"] == hits
    label = "Positive" if expected >= 0.05 else "Negative" if expected <= -0.05 else "Neutral"
    assert r["sentiment"] == label
    assert r["confidence"] == pytest.approx(expected, abs=1e-6)


def test_every_row_scored_once_without_key(spark):
    df = spark.createDataFrame([("good",), ("good",), (None,), ("",)], "title string")
    out = score_text(df, "title", lexicon=lexicon_frame(spark, LEX))
    assert out.count() == 4
    assert sorted(r["sentiment"] for r in out.collect()) == ["Neutral", "Neutral", "Positive", "Positive"]


def test_label_bounds(spark):
    vals = [0.05, -0.05, 0.0499, -0.0499, 0.0]
    df = spark.createDataFrame([(v,) for v in vals], "s double")
    got = [r[0] for r in df.select(label_for_score("s")).collect()]
    assert got == ["Positive", "Negative", "Neutral", "Neutral", "Neutral"]


def test_label_is_function_of_score(spark):
    rows = [(i, " ".join(["good"] * (i % 3) + ["bad"] * (i % 4))) for i in range(40)]
    out = score_text(spark.createDataFrame(rows, "id long, title string"), "title", key="id",
                     lexicon=lexicon_frame(spark, LEX))
    pairs = {(r["compound"], r["sentiment"]) for r in out.collect()}
    assert len({c for c, _ in pairs}) == len(pairs)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scoring_moves_no_row(spark):
    df = spark.createDataFrame([(1, "good")], "id long, title string")
    for keep in (True, False):
        plan = _plan(score_text(df, "title", key="id", keep_text=keep))
        assert "Exchange" not in plan and "Join" not in plan and "Python" not in plan


def test_large_lexicon_is_joined_by_row_id(spark, monkeypatch):
    rows = [(i, t) for i, (t, _, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, "id long, title string").withColumn("other", F.lit("x"))
    args = dict(lexicon=lexicon_frame(spark, LEX), boosters=booster_frame(spark, BOOST), negations=negation_frame(spark, NEG))
    small = score_text(df, "title", key="id", **args).collect()
    monkeypatch.setattr(S, "CONSTANT_BYTES", 200)           # the boosters and negations still are constants
    for limit in (1 << 20, 0):
        monkeypatch.setattr(S, "BROADCAST_BYTES", limit)
        monkeypatch.setattr(S, "_constants", lambda t, v, b, f=S._constants: f(t, v, 0 if v == "valence" else 1 << 20))
        large = score_text(df, "title", key="id", **args)
        assert sorted(map(str, large.collect())) == sorted(map(str, small))
        import re
        keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", _plan(large))
        assert keys and all("title" not in k for k in keys)


def test_repeated_tokens_are_an_error(spark):
    twice = spark.createDataFrame([("Good", 2.0), ("good", 2.0)], "token string, valence double")
    with pytest.raises(ValueError, match="twice"):
        score_text(spark.createDataFrame([("good",)], "title string"), "title", lexicon=twice)


def test_user_scorer_falls_back_row_by_row(spark):
    """V1: one text the scorer fails on costs that row alone, in batches of any size."""
    def scorer(texts):
        if (texts == "boom").any():
            raise RuntimeError("cannot score this")
        return texts.str.len() / 10.0

    rows = [("abc",), ("boom",), ("hello",), (None,), ("",), ("far too long a text for ten",)]
    df = spark.createDataFrame(rows, "title string").coalesce(1)
    got = [(r["title"], r["compound"], r["sentiment"]) for r in score_with(df, scorer).collect()]
    assert got == [("abc", 0.3, "Positive"), ("boom", 0.0, "Neutral"), ("hello", 0.5, "Positive"),
                   (None, 0.0, "Neutral"), ("", 0.0, "Neutral"), ("far too long a text for ten", 1.0, "Positive")]


def test_scores_only_drops_text(spark):
    df = spark.createDataFrame([(1, "good", "s"), (2, "", "s")], "id long, title string, src string")
    out = score_text(df, "title", key="id", keep_text=False, lexicon=lexicon_frame(spark, LEX))
    assert "title" not in out.columns and "src" in out.columns
    assert {r["id"]: r["sentiment"] for r in out.collect()} == {1: "Positive", 2: "Neutral"}


def test_caller_tables_match_case_insensitively(spark):
    df = spark.createDataFrame([(1, "VERY GOOD"), (2, "NOT good")], "id long, title string")
    out = score_text(df, "title", key="id", lexicon=lexicon_frame(spark, {"Good": "2.0"}),
                     boosters=booster_frame(spark, {"VERY": "0.293"}),
                     negations=negation_frame(spark, ["Not"]))
    got = {r["id"]: r["compound"] for r in out.collect()}
    assert got[1] == pytest.approx(compound(2.293)) and got[2] == pytest.approx(compound(-1.48))
