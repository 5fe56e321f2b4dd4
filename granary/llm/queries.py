"""The registered queries: each applies an operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from granary.llm import chat, collocations, decontam, html, langid, licenses, mixing, ngram_join, packing, pii, quality, resample, suffix
from granary.llm.common import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents", "doc_id", "source", "text"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents", "doc_id", "text"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.dedup(table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return chat.digests(conversations.unionByName(spark.createDataFrame(chat.EXTRA, conversations.schema)))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "text"))


def op12_minimum_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"), ids=False)


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents", "text", "lang"))


QUERIES = {f.__name__: f for f in (op1_language_id, op2_html_extraction, op3_pii, op4_source_mixing, op5_ngram_jaccard_join, op6_license_scan, op7_quality_rules, op8_suffix_dedup, op9_chat_format, op10_decontamination, op11_importance_resampling, op12_minimum_bin_slack, op13_phrase_collocations)}
SQL = {"op4_source_mixing": mixing.SQL, "op5_ngram_jaccard_join": ngram_join.SQL, "op8_suffix_dedup": suffix.SQL, "op9_chat_format": chat.SQL, "op10_decontamination": decontam.SQL, "op11_importance_resampling": resample.SQL, "op13_phrase_collocations": collocations.SQL}
