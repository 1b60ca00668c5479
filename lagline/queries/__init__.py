"""Registered queries: each operator on the test tables, with SQL giving the same rows.

Keys start with the operator's id of the survey. Results are rounded to 6 digits so that
engines adding doubles in another order agree.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Registered:
    run: Query
    sql: str | None


REGISTRY: dict[str, Registered] = {}


def register(name: str, sql: str | None = None):
    """Register a query function under ``name`` with its SQL, where SQL can express it."""

    def add(run: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Registered(run, sql)
        return run

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round the floating columns; -0.0 becomes 0.0."""
    return df.select(
        *[
            (F.round(F.col(f"`{f.name}`"), digits) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def load_all() -> dict[str, Registered]:
    """Import every module that registers queries."""
    from lagline.queries import cleaning, evaluation, features, learning, profiling, tables  # noqa: F401

    return REGISTRY
