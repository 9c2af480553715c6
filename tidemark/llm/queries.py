"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import compression, decontamination, htmltext, langid, licenses, lm, mixing, neardup, pieces
from tidemark.llm import quality_rules, runs, toxicity, trie
from tidemark.llm.columns import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op2_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.evaluate(table(spark, sf_dir, "documents"))


def op3_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.main_text(table(spark, sf_dir, "pages"))


def op4_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, mixing.source_rates(docs))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.decontaminate(docs, benchmark)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.collapse(table(spark, sf_dir, "documents"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"), model or pieces.public_model())


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(trie.rebuilt(table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_kneser_ney": op2_kneser_ney,
    "op3_html_main_text": op3_html_main_text,
    "op4_minhash_near_dup": op4_minhash_near_dup,
    "op5_quality_rules": op5_quality_rules,
    "op6_toxicity": op6_toxicity,
    "op7_mixing": op7_mixing,
    "op8_license_scan": op8_license_scan,
    "op9_decontamination": op9_decontamination,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES: dict[str, str] = {
    "op5_quality_rules": quality_rules.ORACLE,
    "op7_mixing": mixing.ORACLE,
    "op8_license_scan": licenses.ORACLE,
    "op13_prefix_trie": trie.ORACLE,
}
