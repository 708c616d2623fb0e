"""The corpus pipeline: language ID, exact dedup, near-dedup, decontamination, tokenising.

Every stage works on all rows that the stage before it kept; what it decides
takes effect; all but the last return the columns of ``documents``.  The
stages are written and read again in between, so a lost executor repeats
one stage at most.

Defined cases: documents with null, empty or letterless text have no
language and go in the first stage; of rows that repeat in full one or all
stay, as exact dedup defines; rows with a null id have no near-duplicate
class and are kept by it; very long texts are processed whole; an empty
``documents`` gives an empty result with the same columns, an empty
``benchmark`` removes nothing; further columns pass through unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bellwether.llm import decontaminate, exact_dedup, langid, near_dedup, sentencepiece_scan
from bellwether.llm.common import load, materialize
from bellwether.session import apply_conf

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model rejects go; it learns from the labelled rows of ``docs``."""
    apply_conf(spark)                # also where the stages are called one by one
    return langid.keep_accepted(docs, langid.fit(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate class the row with the least id stays."""
    return near_dedup.keep_one(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; documents that are mostly benchmark go."""
    return decontaminate.remove_spans(docs, load(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document, and the text that they decode to."""
    out = sentencepiece_scan.round_trip(docs)
    return out.select(*[F.col("decoded").alias("text") if c == "text" else F.col(c) for c in docs.columns],
                      "ids", F.size("ids").cast("long").alias("n_pieces"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id), ("exact_dedup", exact), ("near_dedup", near), ("decontaminate", clean),
    ("sentencepiece", encode)]

#: Stages 1, 3 and 5 are not SQL; the tests hold the pipeline against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = materialize(docs, f"stage-{name}")
    return docs
