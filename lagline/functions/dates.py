"""Timestamp parsing and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lagline.functions.columns import quoted

PARTS = {
    "year": F.year,
    "month": F.month,
    "day": F.dayofmonth,
    "weekday": F.weekday,  # Monday = 0
    "quarter": F.quarter,
}


def parse_timestamp(column: Column, fmt: str | None = None) -> Column:
    """Timestamp from text; text that does not parse becomes NULL."""
    return F.try_to_timestamp(column, F.lit(fmt)) if fmt else F.try_to_timestamp(column)


def add_date_parts(
    df: DataFrame, column: str, prefix: str, fmt: str | None = None, drop: bool = True
) -> DataFrame:
    """Add year, month, day, weekday and quarter of ``column``; the source goes away."""
    if column not in df.columns:
        return df
    source = quoted(column)
    if isinstance(df.schema[column].dataType, T.StringType):
        source = parse_timestamp(source, fmt)
    parts = [make(source).alias(prefix + name) for name, make in PARTS.items()]
    kept = [quoted(c) for c in df.columns if not (drop and c == column)]
    return df.select(*kept, *parts)
