"""Queries of this subpackage: name, function of (spark, sf_dir), SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class CorpusQuery:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, CorpusQuery] = {}


def register(name: str, sql: str | None = None):
    def add(run):
        REGISTRY[name] = CorpusQuery(run, sql)
        return run

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def load_all() -> dict[str, CorpusQuery]:
    """Import every module that registers queries."""
    from lagline.llm import queries  # noqa: F401

    return REGISTRY
