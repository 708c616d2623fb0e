"""The scoring job against a brute-force reading of its rules, on random texts."""

import math
from decimal import Decimal

import regex
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from bellwether import constants as K
from bellwether.operators.scoring import booster_frame, lexicon_frame, negation_frame, score_text

LEX = {"up": "1.5", "down": "-2.25", "gain": "0.75", "loss": "-1.0"}
BOOST = {"very": "0.293", "barely": "-0.293"}
NEG = ("not", "never", "isn't")
WORDS = list(LEX) + list(BOOST) + list(NEG) + ["the", "of", "isn’t", "Up", "DOWN", "x", "but", "É"]
SEPS = [" ", ", ", "! ", "\n", " - ", "3"]


def capital(token):
    return len(token) > 1 and token == token.upper() != token.lower()


def brute_force(text):
    if not text:
        return 0.0, 0
    toks = regex.findall(K.TOKEN_PATTERN, text)
    norm = [t.lower().replace("’", "'") for t in toks]
    mixed = not all(map(capital, toks))
    contrast = [i for i, t in enumerate(norm) if t in K.CONTRAST_WORDS]
    total, hits = Decimal(0), 0
    for i, t in enumerate(norm):
        if t not in LEX:
            continue
        hits += 1
        v = Decimal(LEX[t])
        plus = sum((Decimal(BOOST[norm[i - 1 - k]]) * Decimal(damp) for k, damp in enumerate(K.BOOSTER_DAMPING)
                    if i - 1 - k >= 0 and norm[i - 1 - k] in BOOST), Decimal(0))
        plus += Decimal(K.CAPITALS_INCREMENT) if mixed and capital(toks[i]) else 0
        v += plus if v > 0 else -plus
        if any(i - k >= 0 and norm[i - k] in NEG for k in (1, 2, 3)):
            v *= Decimal(K.NEGATION_SCALAR)
        if contrast:
            v *= Decimal(K.CONTRAST_BEFORE if i < contrast[-1] else K.CONTRAST_AFTER)
        total += v
    if hits == 0:
        return 0.0, 0
    marks = min(text.count("!"), K.EXCLAMATION_LIMIT) * Decimal(K.EXCLAMATION_INCREMENT)
    s = float(total + (marks if total > 0 else -marks if total < 0 else 0))
    return s / math.sqrt(s * s + K.NORMALIZATION_ALPHA), hits


texts = st.lists(st.lists(st.tuples(st.sampled_from(WORDS), st.sampled_from(SEPS)), max_size=12)
                 .map(lambda ws: "".join(w + s for w, s in ws)), min_size=1, max_size=40)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts)
def test_matches_brute_force(spark, batch):
    df = spark.createDataFrame(list(enumerate(batch)), "id long, title string")
    out = score_text(df, "title", key="id", lexicon=lexicon_frame(spark, LEX),
                     boosters=booster_frame(spark, BOOST), negations=negation_frame(spark, NEG))
    got = {r["id"]: (r["compound"], r["n_hits"]) for r in out.collect()}
    assert len(got) == len(batch)
    for i, text in enumerate(batch):
        want = brute_force(text)
        assert got[i][1] == want[1] and abs(got[i][0] - want[0]) < 1e-5, text
