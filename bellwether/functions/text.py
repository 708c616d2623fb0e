"""Column functions for text shaping (P16, P17, P19, P21) and tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bellwether.constants import CARD_DECIMALS, DISPLAY_FORMAT, STORED_DECIMALS, TOKEN_PATTERN


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def capitalize(col: Column | str) -> Column:
    """First character upper-case, the rest lower-case (not per word)."""
    c = _c(col)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def round_stored(col: Column | str, places: int = STORED_DECIMALS) -> Column:
    """Widen to double first, then round half-up."""
    return F.round(_c(col).cast("double"), places)


def escape_html(col: Column | str) -> Column:
    """Escape the three characters that would let markup through a card."""
    c = F.replace(_c(col), F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    return F.replace(c, F.lit(">"), F.lit("&gt;"))


def card_markdown(title: Column | str, source: Column | str, published: Column | str,
                  sentiment: Column | str, confidence: Column | str,
                  link: Column | str) -> Column:
    """The headline card text shown per row (``published`` is a timestamp)."""
    score = F.format_string(f"%.{CARD_DECIMALS}f",
                            F.round(_c(confidence).cast("double"), CARD_DECIMALS))
    parts = ["**", escape_html(title), "**  \n", "_Source_: ", escape_html(source), "  \n", "_Published at_: ",
             F.coalesce(F.date_format(_c(published), DISPLAY_FORMAT), F.lit("NaT")), "  \n",
             "_Sentiment_: ", _c(sentiment), " (", F.when(_c(confidence).isNotNull(), score), ")  \n",
             "[Link to article](", escape_html(link), ")"]
    # a missing field is an empty place on the card, not a missing card
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("")) for p in parts])


def preview(col: Column | str, length: int = 50) -> Column:
    """Short title preview for log lines (display only)."""
    return F.substring(_c(col), 1, length)


def tokens(col: Column | str) -> Column:
    """Word tokens of the whole text, as written."""
    return F.regexp_extract_all(_c(col), F.lit(TOKEN_PATTERN), F.lit(0))


def apostrophe_variants(words):
    """Each word, plus its curly-apostrophe spelling when it has an apostrophe."""
    out = {}
    for w in words:
        out[w] = None
        if "'" in w:
            out[w.replace("'", "’")] = None
    return list(out)
