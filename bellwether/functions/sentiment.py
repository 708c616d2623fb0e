"""Column functions for the sentiment label and result."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bellwether.constants import LABELS, NEGATIVE_THRESHOLD, NORMALIZATION_ALPHA, POSITIVE_THRESHOLD


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def label_for_score(score: Column | str) -> Column:
    """P10: >= 0.05 Positive, <= -0.05 Negative, otherwise Neutral."""
    s = _c(score)
    positive, negative, neutral = LABELS
    return (F.when(s >= F.lit(POSITIVE_THRESHOLD), F.lit(positive))
            .when(s <= F.lit(NEGATIVE_THRESHOLD), F.lit(negative))
            .otherwise(F.lit(neutral)))


def is_blank_text(text: Column | str) -> Column:
    """P11 guard: null or empty text is not scored."""
    t = _c(text)
    return t.isNull() | (t == F.lit(""))


def compound_from_sum(total: Column | str) -> Column:
    """Normalise an unbounded valence sum into [-1, 1]."""
    s = _c(total).cast("double")
    return s / F.sqrt(s * s + F.lit(NORMALIZATION_ALPHA))


def sentiment_struct(label: Column | str, confidence: Column | str) -> Column:
    """The result as a native struct (JSON only at the edges)."""
    return F.struct(_c(label).alias("sentiment"),
                    _c(confidence).cast("float").alias("confidence"))
