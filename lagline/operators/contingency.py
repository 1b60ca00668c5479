"""Categories against the label: contingency tables, shares and chi-square tests."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagline import fixed_values as fixed
from lagline.functions.columns import long_form, quoted

MARGIN = "All"


def contingency(
    df: DataFrame, columns: Sequence[str], label: str, labels: Sequence = (0, 1)
) -> DataFrame:
    """(column, value, n_<label>..., n) for all columns in one job; NULLs are left out.

    One row per value leaves each task, so hot values do not load the shuffle.
    """
    rows = long_form(df, columns, "string", keep=[label]).where(
        F.col("value").isNotNull() & quoted(label).isNotNull()
    )
    cells = [F.count_if(quoted(label) == F.lit(v)).alias(f"n_{v}") for v in labels]
    return rows.groupBy("column", "value").agg(*cells, F.count(F.lit(1)).alias("n"))


def contingency_with_margins(
    df: DataFrame, columns: Sequence[str], label: str, labels: Sequence = (0, 1)
) -> DataFrame:
    """Contingency table with an ``All`` row per column, by grouping sets on the counts."""
    counts = contingency(df, columns, label, labels)
    sums = [F.sum(c).alias(c) for c in counts.columns[2:]]
    total = F.grouping("value") == 1
    return (
        counts.groupingSets([["column", "value"], ["column"]], "column", "value")
        .agg(F.when(total, F.lit(MARGIN)).otherwise(F.col("value")).alias("category"), *sums)
        .select("column", "category", *counts.columns[2:])
    )


def row_percentages(
    df: DataFrame, columns: Sequence[str], label: str, labels: Sequence = (0, 1), digits: int = 2
) -> DataFrame:
    """Share of each label within a category, in percent."""
    counts = contingency(df, columns, label, labels)
    shares = [F.round(F.col(f"n_{v}") * 100.0 / F.col("n"), digits).alias(f"pct_{v}") for v in labels]
    return counts.select("column", "value", *shares)


def stacked_counts(df: DataFrame, column: str, label: str, labels: Sequence = (0, 1)) -> DataFrame:
    """One row per category, one count column per label."""
    counts = contingency(df, [column], label, labels)
    return counts.select(F.col("value").alias("category"), *[f"n_{v}" for v in labels]).orderBy("category")


def late_share(df: DataFrame, column: str, label: str) -> DataFrame:
    """Share of positive labels per category."""
    return (
        df.groupBy(quoted(column).alias("category"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(quoted(label).cast("bigint")).alias("n_late"))
        .withColumn("late_share", F.col("n_late") / F.col("n"))
        .orderBy("category")
    )


def expected_counts(
    df: DataFrame, columns: Sequence[str], label: str, labels: Sequence = (0, 1)
) -> DataFrame:
    """(column, value, label, observed, expected) under independence."""
    counts = contingency(df, columns, label, labels)
    totals = counts.groupBy("column").agg(
        F.sum("n").alias("total"), *[F.sum(f"n_{v}").alias(f"total_{v}") for v in labels]
    )
    cells = F.array(
        *[
            F.struct(
                F.lit(str(v)).alias("label"),
                F.col(f"n_{v}").alias("observed"),
                F.col(f"total_{v}").alias("label_total"),
            )
            for v in labels
        ]
    )
    return (
        counts.join(totals, "column")
        .select("column", "value", "n", "total", F.inline(cells))
        .where(F.col("label_total") > 0)
        .select(
            "column",
            "value",
            "label",
            "observed",
            (F.col("n") * F.col("label_total") / F.col("total")).alias("expected"),
        )
    )


def chi_square(
    df: DataFrame, columns: Sequence[str], label: str, labels: Sequence = (0, 1)
) -> DataFrame:
    """Chi-square test of independence per column; Yates' correction with one degree."""
    cells = expected_counts(df, columns, label, labels)
    sizes = cells.groupBy("column").agg(
        F.count_distinct("value").alias("n_values"), F.count_distinct("label").alias("n_labels")
    )
    freedom = ((F.col("n_values") - 1) * (F.col("n_labels") - 1)).cast("int")
    gap = F.abs(F.col("observed") - F.col("expected"))
    corrected = F.when(F.col("dof") == 1, gap - F.least(gap, F.lit(0.5))).otherwise(gap)
    tested = (
        cells.join(sizes.select("column", freedom.alias("dof")), "column")
        .groupBy("column", "dof")
        .agg(F.sum(corrected * corrected / F.col("expected")).alias("statistic"))
    )
    p_value = _p_values(F.col("statistic"), F.col("dof"))
    return tested.select("column", "statistic", "dof", p_value.alias("p_value")).withColumn(
        "significant", F.col("p_value") < F.lit(fixed.SIGNIFICANCE)
    )


def chi2_tail(statistic: float, dof: int) -> float:
    """P(chi-square with ``dof`` degrees > statistic), by the finite sum for integer dof."""
    if dof == 0:
        return 1.0
    half = statistic / 2
    if half <= 0:
        return 1.0
    odd = dof % 2
    tail = math.erfc(math.sqrt(half)) if odd else 0.0
    powers = (i + odd / 2 for i in range(dof // 2))
    return min(1.0, tail + sum(math.exp(k * math.log(half) - half - math.lgamma(k + 1)) for k in powers))


def _p_values(statistic: Column, dof: Column) -> Column:
    """``chi2_tail`` for the one result row per tested column."""

    @F.pandas_udf("double")
    def tails(x: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([chi2_tail(float(a), int(b)) for a, b in zip(x, d)])

    return tails(statistic, dof)
