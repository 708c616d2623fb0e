"""Registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bellwether.llm import (chat_format, decontaminate, exact_dedup, filter_audit, html_extract, katz, langid, near_dedup,
                            quality, sentencepiece_scan, source_divergence, toxicity, url_templates)
from bellwether.llm.common import load

Query = Callable[[SparkSession, str], DataFrame]


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ProbMinHash near-dedup of ``documents``."""
    return near_dedup.query(spark, load(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``benchmark`` passages in ``documents``."""
    return decontaminate.query(spark, load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of ``pages``."""
    return html_extract.query(spark, load(spark, sf_dir, "pages"))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of ``documents``."""
    return langid.query(spark, load(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal texts of ``documents``."""
    return exact_dedup.query(spark, load(spark, sf_dir, "documents"))


def op6_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of ``documents``."""
    return katz.query(spark, load(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of ``documents``."""
    return quality.query(spark, load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of ``documents``."""
    return toxicity.query(spark, load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every perspective of ``conversations``."""
    return chat_format.query(load(spark, sf_dir, "conversations"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of ``documents`` and the round trip."""
    return sentencepiece_scan.query(spark, load(spark, sf_dir, "documents"))


def op11_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the urls of ``pages``."""
    return url_templates.query(spark, load(spark, sf_dir, "pages"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five filters of ``documents`` in every order."""
    return filter_audit.query(spark, load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of ``documents`` differ in their terms."""
    return source_divergence.query(spark, load(spark, sf_dir, "documents"))


def registry() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_near_dedup, op2_decontaminate, op3_html_extract, op4_langid, op5_exact_dedup, op6_katz, op7_quality,
        op8_toxicity, op9_chat_format, op10_sentencepiece, op11_url_templates, op12_filter_audit, op13_source_divergence)}
