"""V1: an Arrow-batched slot for a user-supplied scorer.

The native job in ``scoring`` is the default.  When a caller brings its own
per-text scorer (``Series[str] -> Series[float]`` of compound scores), it
runs here as a vectorised pandas UDF: text moves to Python in Arrow batches,
and labelling, guards and everything around it stay JVM-side.

A scorer that is costly to set up (a lexicon, a model) comes as a factory:
it is called once per Python worker, and what it returns serves all batches
and tasks of that worker.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bellwether.functions.sentiment import is_blank_text, label_for_score

Scorer = Callable[[pd.Series], pd.Series]

#: Scorers that factories have made in this Python worker, by the factory's token.
_MADE: dict[str, Scorer] = {}


def made_once(token: str, factory: Callable[[], Scorer]) -> Scorer:
    """The scorer of ``factory`` in this worker, made at its first use."""
    if token not in _MADE:
        _MADE[token] = factory()
    return _MADE[token]


def score_batch(scorer: Scorer, texts: pd.Series) -> pd.Series:
    """Scores of one batch; if the scorer fails on it, row by row, and 0.0 for the rows it fails on."""
    def attempt(some: pd.Series) -> pd.Series:
        return pd.Series(scorer(some), index=some.index, dtype="float64")

    out = pd.Series(0.0, index=texts.index)
    some = texts[texts.notna() & (texts != "")]
    if len(some):
        try:
            out[some.index] = attempt(some)
        except Exception:
            for at in some.index:
                try:
                    out[at] = attempt(some.loc[[at]]).iloc[0]
                except Exception:      # the fallback of a row
                    out[at] = 0.0
    return out.fillna(0.0).clip(-1.0, 1.0)


def score_with(df: DataFrame, scorer: Scorer | None = None, text_col: str = "title",
               factory: Callable[[], Scorer] | None = None) -> DataFrame:
    """Add ``sentiment``, ``confidence`` and ``compound`` using ``scorer``, or the one that ``factory`` makes.

    P11 holds here too: blank text scores 0.0 without calling the scorer.  A
    batch the scorer fails on is scored again row by row, and only the rows
    it fails on score 0.0 (Neutral), so results do not depend on batching.
    A factory that fails fails the job.
    """
    if (scorer is None) == (factory is None):
        raise ValueError("score_with takes a scorer or a factory")
    token = uuid.uuid4().hex

    @F.pandas_udf(T.DoubleType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        use = scorer if factory is None else made_once(token, factory)
        for texts in batches:
            yield score_batch(use, texts)

    compound = F.when(is_blank_text(text_col), F.lit(0.0)).otherwise(run(F.col(text_col)))
    return (df.withColumn("compound", compound)
            .withColumn("sentiment", label_for_score("compound"))
            .withColumn("confidence", F.col("compound").cast("float")))
