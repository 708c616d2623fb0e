"""Operator 6, the stored model: Katz backoff of any order, kept in tables and read to score new texts.

``train`` counts the n-grams of every order up to ``order`` and writes, per
order, two tables that are partitioned by a hash of the history:

* ``grams``: history, word, count and discounted probability,
* ``weights``: history and log10 of its backoff weight.

P_k(w | h) = d c(h, w) / c(h) where the training texts have the n-gram, else
a(h) P_{k-1}(w | h without its first word); a history that they never have
passes the word on as it is, and the last resort is the mass left for unknown
words.  Discounts are those of ``katz.good_turing``, per order; a(h) is what
the discounts left over what the shorter history gives to the words not seen,
so the probabilities after h sum to one.  Every word seen after h is also
seen after the shorter history, so a(h) is one join of two tables.

``score`` resolves each distinct n-gram of the new texts once, order by order
from the longest, and looks the results up per text.  ``katz.score`` is the
bulk path of the registered query (order two, training and scoring in one);
both give the same scores.

Defined cases: null text is an empty text, which has one token, its end; a
model without training texts gives every token the probability one; rows are
scored each, whatever their ids; very long texts are read whole; other
columns are kept by ``score``; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bellwether.llm.common import fresh_name, lookup_join, materialize
from bellwether.llm.katz import KATZ, LARGE, good_turing

PARTITIONS = 64
START, END = "\t", "\n"       # no token has white space
_SPACE = "[\\x20\\x09-\\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass
class Model:
    path: str
    order: int
    tokens: int               # of the training texts, ends included
    unknown: float            # probability of any word that they lack


def words(text: str) -> Column:
    """The tokens of a text and its end."""
    plain = F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER)
    return F.concat(F.filter(F.split(plain, _SPACE), lambda w: w != ""), F.array(F.lit(END)))


def ngrams(tokens: str, order: int) -> Column:
    """(history, word) at every token: the ``order`` - 1 tokens before it, joined by spaces, and itself."""
    padded = f"concat(array_repeat('{START}', {order - 1}), {tokens})"
    history = f"array_join(slice({padded}, i, {order - 1}), ' ')" if order > 1 else "''"
    return F.expr(f"transform(sequence(1, size({tokens})), i -> struct({history} AS h, {tokens}[i - 1] AS w))")


def _write(table: DataFrame, path: str) -> None:
    part = F.pmod(F.xxhash64("h"), F.lit(PARTITIONS)).cast("int")
    table.withColumn("part", part).repartition("part").write.mode("overwrite").partitionBy("part").parquet(path)


SCHEMAS = {"grams": "h string, w string, c long, p double, left double, part int", "weights": "h string, weight double, part int"}


def _read(spark: SparkSession, model: Model, kind: str, k: int) -> DataFrame:
    return spark.read.schema(SCHEMAS[kind]).parquet(f"{model.path}/{kind}-{k}").drop("part")


def train(docs: DataFrame, path: str, order: int = 3, text: str = "text") -> Model:
    """Write the tables of a model of ``docs`` under ``path`` (a shared folder)."""
    spark = docs.sparkSession
    tokens = docs.select(words(text).alias("t"))
    model = Model(path.rstrip("/"), order, 0, 1.0)
    lower: DataFrame | None = None
    for k in range(1, order + 1):
        counts = materialize(tokens.select(F.explode(ngrams("t", k)).alias("g")).groupBy("g.h", "g.w").agg(
            F.count(F.lit(1)).alias("c")), "ngram-counts")
        sizes = {r["r"]: r["n"] for r in counts.where(F.col("c") <= KATZ + 1).groupBy(F.col("c").alias("r")).agg(
            F.count(F.lit(1)).alias("n")).collect()}                              # KATZ + 1 rows
        discount = good_turing([0, *(sizes.get(r, 0) for r in range(1, KATZ + 2))])
        kept = F.lit(None).cast("double")
        for r in range(1, KATZ + 1):
            kept = F.when(F.col("c") == r, F.lit(discount[r] * r)).otherwise(kept)
        kept = F.when(F.col("c") > KATZ, F.col("c") - F.lit(LARGE)).otherwise(kept)
        totals = counts.groupBy("h").agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("n"))
        n_grams = counts.count()
        rated = lookup_join(counts, totals, "h", "n", n_grams) if n_grams else counts.join(totals, "h")
        grams = rated.select("h", "w", "c", (kept / F.col("total")).alias("p"), ((F.col("c") - kept) / F.col("total")).alias("left"))
        _write(grams, f"{model.path}/grams-{k}")
        grams = _read(spark, model, "grams", k)
        if k == 1:
            model.tokens, left = grams.agg(F.coalesce(F.sum("c"), F.lit(0)), F.sum("left")).first()
            model.unknown = left if model.tokens else 1.0
        else:
            # what the shorter history gives to the words that are seen after the longer one
            short = F.regexp_replace("h", "^[^ ]* ?", "")
            seen = grams.select("h", "w", "left", short.alias("s")).join(
                lower.select(F.col("h").alias("s"), "w", F.col("p").alias("q")), ["s", "w"])
            weights = seen.groupBy("h").agg(F.sum("left").alias("left"), F.sum("q").alias("q")).select(
                "h", F.log10(F.col("left") / F.greatest(F.lit(1.0) - F.col("q"), F.lit(1e-300))).alias("weight"))
            _write(weights, f"{model.path}/weights-{k}")
        lower = grams
    return model


def resolve(spark: SparkSession, model: Model, grams: DataFrame) -> DataFrame:
    """log10 P(w | h) of distinct n-grams ``h, w`` of the model's order, order by order: ``h, w, logp``."""
    open_rows = grams.select("h", "w", F.col("h").alias("s"), F.lit(0.0).alias("acc"))
    done: DataFrame | None = None
    for k in range(model.order, 0, -1):
        table = _read(spark, model, "grams", k).select(F.col("h").alias("s"), "w", F.log10("p").alias("own"))
        found = open_rows.join(table, ["s", "w"], "left")
        if k > 1:
            weights = _read(spark, model, "weights", k).select(F.col("h").alias("s"), "weight")
            found = found.join(weights, "s", "left")
        found = materialize(found, "resolved")
        hit = found.where(F.col("own").isNotNull()).select("h", "w", (F.col("acc") + F.col("own")).alias("logp"))
        done = hit if done is None else done.unionByName(hit)
        missed = found.where(F.col("own").isNull())
        if k > 1:
            open_rows = missed.select("h", "w", F.regexp_replace("s", "^[^ ]* ?", "").alias("s"),
                                      (F.col("acc") + F.coalesce("weight", F.lit(0.0))).alias("acc"))
        else:
            last = missed.select("h", "w", (F.col("acc") + F.log10(F.lit(model.unknown))).alias("logp"))
            done = done.unionByName(last)
    return done


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score``: the log10 probability of each row's text under a stored model."""
    spark = docs.sparkSession
    rid, out = fresh_name(docs, "row"), fresh_name(docs, "score")
    rows = materialize(docs.withColumn(rid, F.monotonically_increasing_id()), "rows")      # ids that stay as they are
    used = rows.select(rid, words(text).alias("t")).select(rid, F.explode(ngrams("t", model.order)).alias("g"))
    used = materialize(used.groupBy(rid, "g.h", "g.w").agg(F.count(F.lit(1)).alias("times")), "text-ngrams")
    distinct = used.groupBy("h", "w").agg(F.count(F.lit(1)).alias("n"))
    known = materialize(resolve(spark, model, distinct).join(distinct, ["h", "w"]), "ngram-scores")
    scores = lookup_join(used, known, ["h", "w"], "n", used.count()).groupBy(rid).agg(
        F.sum(F.col("times") * F.col("logp")).alias(out))
    return rows.join(scores, rid).drop(rid)
