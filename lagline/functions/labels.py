"""The late label and the checks on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagline.functions.columns import quoted, require_columns


def late_label(real_days: Column, scheduled_days: Column) -> Column:
    """1 if the real days exceed the scheduled days, else 0; a missing side gives 0."""
    return F.coalesce((real_days > scheduled_days).cast("int"), F.lit(0))


def add_late_label(df: DataFrame, real: str, scheduled: str, label: str) -> DataFrame:
    require_columns(df, [real, scheduled])
    return df.withColumn(label, late_label(quoted(real), quoted(scheduled)))


def label_range(df: DataFrame, label: str) -> DataFrame:
    """Smallest and largest label and whether both classes occur; one row."""
    low, high = F.min(quoted(label)), F.max(quoted(label))
    return df.agg(
        low.alias("min_label"), high.alias("max_label"), (low < high).alias("both_classes")
    )


def require_both_classes(df: DataFrame, label: str) -> None:
    row = label_range(df, label).first()
    if not row["both_classes"]:
        raise ValueError(f"label {label!r} has one class only: {row['min_label']}")
