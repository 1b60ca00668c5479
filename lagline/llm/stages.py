"""The operators as stages of the corpus pipeline: documents in, the documents they keep out."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagline.llm import decontamination, neardup, packing, pii, toxicity
from lagline.llm.registry import read


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of the labels doesn't reject."""
    return toxicity.remove_toxic(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every component of near duplicates, the one with the smallest id."""
    return neardup.remove_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return decontamination.remove_documents(docs, read(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind; a column n_chars follows the new text."""
    out = docs.withColumn("text", pii.redacted(F.col("text")))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences along a curve; the last stage."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
