"""The corpus pipeline: stages applied one after another, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame; its rows are written as Parquet and
read again as the next one's documents. All but the last give the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lagline.llm import stages
from lagline.session import stage_table

STAGES = [
    ("toxicity", stages.without_toxic),
    ("near_duplicates", stages.without_near_duplicates),
    ("decontamination", stages.without_benchmark),
    ("personal_data", stages.without_personal_data),
    ("packing", stages.packed),
]

# Toxicity is a trained model and packing a curve order; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table; the rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
