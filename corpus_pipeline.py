"""Corpus pipeline: language ID, near-duplicates, decontamination, personal data, mixing. Each stage is written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import decontam, langid, mixing, ngram_join, pii
from granary.llm.common import ready
from granary.operators.lineage import settled

#: Documents with a less certain language go, and those without a letter.
MIN_SCORE = 0.4
#: Near duplicates share this percentage of their shingles of so many words.
NEAR_K, NEAR_PERCENT = 5, 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a language; lang becomes the predicted one. Text and the labels of the learning folds are what it learns from. Null, empty or letterless texts go; equal rows are judged alike; an empty table stays empty. All other columns keep their values, also ones named like the prediction's."""
    ready(spark)
    model = langid.train(docs.where(langid.fold("doc_id") != 2).select("doc_id", "text", "lang"))
    aside = {c: f"_granary_{c}" for c in ("lang_pred", "score") if c in docs.columns}
    found = langid.predict(spark, docs.withColumnsRenamed(aside), model).where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE))
    return found.withColumn("lang", F.col("lang_pred")).select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the least doc_id of each group: five-word similarity of 0.8 or more. Without words, each is a group of its own. Of rows with equal doc_id and text the least by all their columns stays. Null doc_ids stay only where no other is in their group."""
    ready(spark)
    kept = ngram_join.similar(docs, k=NEAR_K, percent=NEAR_PERCENT).where(F.col("component_id").eqNullSafe(F.col("doc_id"))).groupBy(F.col("doc_id").alias("_granary_kept")).agg(F.count("*").alias("_granary_rows"))
    found = settled(docs.join(kept, docs["doc_id"].eqNullSafe(F.col("_granary_kept"))))  # both branches below read it, so texts are shuffled once
    again = found.where("_granary_rows > 1").withColumn("_granary_hash", F.xxhash64("text")).groupBy("_granary_kept", "_granary_hash").agg(F.min(F.struct(*docs.columns)).alias("_granary_row"))
    return found.where("_granary_rows = 1").select(*docs.columns).unionAll(again.select("_granary_row.*"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents without a benchmark window; those without text stay. Every row is judged by its text alone, so equal rows stay or go together; other columns stay as they are."""
    ready(spark)
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents, personal data replaced; null texts stay null. Other columns stay, but n_chars follows the text."""
    ready(spark)
    return pii.redact(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document: doc_id, size, source_size, target, taken, repetitions. Rows without text have size 0; null sources are one source; equal rows count each."""
    ready(spark)
    return mixing.mix(docs)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("personal_data", personal_data), ("source_mixing", source_mixing)]
#: SQL can't express the language model or the pattern graph; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    folder = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    docs, at = spark.read.parquet(f"{sf_dir}/documents.parquet"), f"{folder}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{at}/{name}")
        docs = spark.read.parquet(f"{at}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
