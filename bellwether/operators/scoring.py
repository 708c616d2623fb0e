"""Rule-based lexicon sentiment scoring, local to each row.

The score of a text depends on that text alone, so with constant tables
(word lists up to ``CONSTANT_BYTES``) the plan is a projection: the text is
split into tokens, the positions of the lexicon words are found with a
hashed set test, and only those few positions look up values, boosters,
negations and contrast.  The scorer is evaluated once per row, whatever
filters and names follow it.  No row is exploded, joined or shuffled, and the
text never leaves its row.  Expressions stay JVM-side.

A lexicon larger than that stays a table: tokens are exploded with a row id,
joined with the tables, summed per row id, and the sums are joined back.
Only ids and tokens are shuffled, besides the rows themselves once for the
join back.  Both plans give the same scores.

All valence arithmetic is DECIMAL, so sums are exact in any order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bellwether import constants as K
from bellwether import schemas
from bellwether.functions.sentiment import compound_from_sum, label_for_score
from bellwether.functions.text import apostrophe_variants, tokens

# A scorer table of at most this many bytes becomes constants of the plan; one
# of at most BROADCAST_BYTES is broadcast; a larger one is a shuffle join.
CONSTANT_BYTES = 1 << 19
BROADCAST_BYTES = 1 << 26

VALUE_TYPE = T.DecimalType(18, 6)
_DEC = f"DECIMAL({VALUE_TYPE.precision},{VALUE_TYPE.scale})"


def _sql_literal(value) -> str:
    if isinstance(value, Decimal):
        return f"{value}BD"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    raise TypeError(f"unsupported constant {value!r}")


def constant_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A small table of constants as a local relation (planned on the
    driver, no job and no Python workers to produce it).

    Its row count is fixed by ``rows``: a proven bound for broadcasting.
    """
    body = ", ".join("(" + ", ".join(_sql_literal(v) for v in row) + ")" for row in rows)
    names = ", ".join(f.name for f in schema.fields)
    df = spark.sql(f"SELECT * FROM VALUES {body} AS t({names})")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def lexicon_frame(spark: SparkSession, lexicon: Mapping[str, str] | None = None) -> DataFrame:
    entries = K.DEFAULT_LEXICON if lexicon is None else lexicon
    return constant_table(spark, list(_variants(entries).items()), schemas.LEXICON)


def booster_frame(spark: SparkSession, boosters: Mapping[str, str] | None = None) -> DataFrame:
    entries = K.DEFAULT_BOOSTERS if boosters is None else boosters
    return constant_table(spark, list(_variants(entries).items()), schemas.BOOSTER)


def negation_frame(spark: SparkSession, negations: Sequence[str] | None = None) -> DataFrame:
    entries = K.DEFAULT_NEGATIONS if negations is None else negations
    return constant_table(spark, [(w,) for w in apostrophe_variants(entries)], schemas.NEGATION)


def _variants(entries: Mapping[str, str]) -> dict[str, Decimal]:
    return {w: Decimal(str(entries[w if w in entries else w.replace("’", "'")]))
            for w in apostrophe_variants(entries)}


Table = DataFrame | Mapping | Sequence


@dataclass
class Scorer:
    """Word lists ready to score with: constants, or a lexicon that stays a table."""

    lexicon: dict[str, Decimal] | DataFrame
    boosters: dict[str, Decimal]
    negations: list[str]
    small: bool = True             # may a lexicon table be broadcast?


def _lowered(entries: dict[str, Decimal]) -> dict[str, Decimal]:
    out = {w.lower(): v for w, v in entries.items()}
    if len(out) != len(entries):
        raise ValueError("a scorer table has a token twice (tokens are compared in lower case)")
    return out


def _constants(table: DataFrame, value: str | None, limit: int) -> tuple[dict[str, Decimal] | None, int]:
    """The table as a dict if it is small, and its bytes; fails on a repeated token."""
    size, n, distinct = table.agg(
        F.coalesce(F.sum(F.octet_length("token") + F.lit(16)), F.lit(0)), F.count("token"),
        F.count_distinct(F.lower("token"))).first()
    if n != distinct:
        raise ValueError("a scorer table has a token twice (tokens are compared in lower case)")
    if size > limit:
        return None, size
    rows = table.where(F.col("token").isNotNull()).select("token", *([value] if value else [])).collect()
    return {r["token"].lower(): Decimal(str(r[value])) if value else Decimal(1) for r in rows}, size


def make_scorer(lexicon: Table | None = None, boosters: Table | None = None,
                negations: Table | None = None) -> Scorer:
    """Check the tables once (a stream does so before it starts) and choose the plan by their bytes."""
    def entries(table: Table | None, default, value: str | None) -> dict[str, Decimal]:
        if isinstance(table, DataFrame):
            found, size = _constants(table, value, CONSTANT_BYTES)
            if found is None:
                raise ValueError(f"a table of {size} bytes is too large for boosters or negations")
            return found
        table = default if table is None else table
        if isinstance(table, Mapping):
            return _lowered(_variants(table))
        return {w.lower(): Decimal(1) for w in apostrophe_variants(table)}

    boost = entries(boosters, K.DEFAULT_BOOSTERS, "inc")
    neg = list(entries(negations, K.DEFAULT_NEGATIONS, None))
    if isinstance(lexicon, DataFrame):
        found, size = _constants(lexicon, "valence", CONSTANT_BYTES)
        if found is None:
            return Scorer(lexicon.select(F.lower("token").alias("token"), "valence"), boost, neg,
                          size <= BROADCAST_BYTES)
        return Scorer(found, boost, neg)
    return Scorer(entries(lexicon, K.DEFAULT_LEXICON, None), boost, neg)


# ---- SQL fragments --------------------------------------------------------------
def _set(words) -> str:
    return "(" + ", ".join(_sql_literal(w) for w in sorted(words)) + ")" if words else "('')"


def _map(entries: Mapping[str, Decimal]) -> str:
    pairs = [f"{_sql_literal(w)}, CAST({v} AS {_DEC})" for w, v in sorted(entries.items())]
    return f"map({', '.join(pairs)})" if pairs else f"map('', CAST(0 AS {_DEC}))"


def _near(distance: int, at: str) -> str:
    return f"get(__low, {at} - {distance})"


def _context(at: str, scorer: Scorer) -> tuple[str, str, str]:
    """What stands around position ``at``: the added magnitude, whether it is negated, its contrast factor."""
    boost = " + ".join(
        f"CAST(coalesce(element_at({_map(scorer.boosters)}, {_near(k + 1, at)}), 0) * {damp}BD AS {_DEC})"
        for k, damp in enumerate(K.BOOSTER_DAMPING))
    capital = f"IF(__mixed AND {_capital(f'get(__toks, {at})')}, {K.CAPITALS_INCREMENT}BD, 0BD)"
    negated = " OR ".join(f"coalesce({_near(k, at)} IN {_set(scorer.negations)}, false)"
                          for k in range(1, K.NEGATION_WINDOW + 1))
    contrast = (f"CASE WHEN __but < 0 THEN 1.0BD WHEN {at} < __but THEN {K.CONTRAST_BEFORE}BD "
                f"ELSE {K.CONTRAST_AFTER}BD END")
    return f"CAST({boost} + {capital} AS {_DEC})", f"({negated})", contrast


def _weigh(value: str, plus: str, negated: str, contrast: str) -> str:
    """What a lexicon word of valence ``value`` adds to the sum."""
    strong = f"CAST({value} + sign({value}) * {plus} AS {_DEC})"
    turned = f"CAST({strong} * IF({negated}, {K.NEGATION_SCALAR}BD, 1BD) AS {_DEC})"
    return f"CAST({turned} * {contrast} AS {_DEC})"


def _capital(token: str) -> str:
    """Is a token of at least two letters written in capitals?"""
    return f"(length({token}) > 1 AND {token} = upper({token}) AND {token} <> lower({token}))"


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def score_text(df: DataFrame, text_col: str = "title", key: str | None = None,
               lexicon: Table | None = None, boosters: Table | None = None,
               negations: Table | None = None, keep_text: bool = True,
               scorer: Scorer | None = None) -> DataFrame:
    """Add ``sentiment``, ``confidence`` (float), ``compound`` and ``n_hits``.

    Every input row yields one output row.  The tables are mappings or word
    lists, or frames with one row per token (``lexicon``: ``token, valence``;
    ``boosters``: ``token, inc``; ``negations``: ``token``); tokens are
    compared in lower case and a repeated one is an error.  A ``scorer`` made
    before takes their place.  ``keep_text=False`` drops the text column.
    ``key`` (unique per row) is needed only by the plan of large lexicons,
    which makes a row id without it.
    """
    s = scorer or make_scorer(lexicon, boosters, negations)
    carried = [_q(c) for c in df.columns if keep_text or c != text_col]
    text = _q(text_col)
    but = f"coalesce(array_max(transform(__low, (t, i) -> IF(t IN {_set(K.CONTRAST_WORDS)}, i, -1))), -1)"
    ready = (df.withColumn("__toks", tokens(F.col(text_col)))
             .withColumn("__low", F.expr("transform(__toks, t -> lower(t))"))
             .withColumn("__but", F.expr(but))
             .withColumn("__mixed", F.expr(f"exists(__toks, t -> NOT {_capital('t')})"))
             .withColumn("__mark", F.expr(
                 f"least(length({text}) - length(replace({text}, '!', '')), {K.EXCLAMATION_LIMIT})")))
    if isinstance(s.lexicon, dict):
        at = f"filter(transform(__low, (t, i) -> IF(t IN {_set(s.lexicon)}, i, NULL)), i -> i IS NOT NULL)"
        value = f"element_at({_map(s.lexicon)}, get(__low, x))"
        summed = ready.withColumn("__hits", F.expr(at)).withColumn("__sum", F.expr(
            f"aggregate(__hits, CAST(0 AS {_DEC}), (acc, x) -> CAST(acc + {_weigh(value, *_context('x', s))} AS {_DEC}))")
        ).withColumn("n_hits", F.expr("CAST(greatest(size(__hits), 0) AS BIGINT)"))
    else:
        summed = _with_table(ready, s, key)
    total = F.expr(f"CAST(__sum + sign(__sum) * __mark * {K.EXCLAMATION_INCREMENT}BD AS {_DEC})")
    # Blank text, or no lexicon hit, scores 0.0
    compound = F.coalesce(compound_from_sum(total), F.lit(0.0))
    # A filter on the label would be pushed below the projection, and the whole
    # scorer put in place of every name in it; nothing is pushed below a generator.
    scored = summed.withColumn("__compound", compound).selectExpr(
        *carried, "inline(array(struct(__compound, coalesce(n_hits, 0) AS n_hits)))")
    return scored.select(
        *carried, label_for_score("__compound").alias("sentiment"),
        F.col("__compound").cast("float").alias("confidence"), F.col("__compound").alias("compound"), "n_hits")


def _with_table(ready: DataFrame, s: Scorer, key: str | None) -> DataFrame:
    """``__sum`` and ``n_hits`` by joins, for a lexicon that is too large for constants."""
    base = ready if key is not None else ready.withColumn("__rid", F.monotonically_increasing_id())
    rid = _q(key or "__rid")
    lexicon = F.broadcast(s.lexicon) if s.small else s.lexicon
    tokens_of = base.selectExpr(f"{rid} AS __id", "__toks", "__low", "__but", "__mixed",
                                "posexplode(__low) AS (__pos, token)")
    plus, negated, contrast = _context("__pos", s)
    near = tokens_of.selectExpr("__id", "token", f"{plus} AS __plus", f"{negated} AS __neg", f"{contrast} AS __contrast")
    sums = near.join(lexicon, "token").groupBy("__id").agg(
        F.expr(f"CAST(sum({_weigh('valence', '__plus', '__neg', '__contrast')}) AS {_DEC})").alias("__sum"),
        F.count(F.lit(1)).alias("n_hits"))
    return base.join(sums, base[key or "__rid"] == sums["__id"], "left").drop("__id")
