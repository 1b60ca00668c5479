"""Descriptive profile of a table: summaries, distributions, histograms, box plots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lagline import fixed_values as fixed
from lagline.functions.columns import long_form, quoted, rows_per_column, value_counts
from lagline.functions.quantiles import quantiles
from lagline.operators.cleaning import iqr_reach, is_outside


def describe_numeric(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per column."""
    quartiles = quantiles(df, columns, [0.25, 0.5, 0.75], exact)
    aggregated = df.agg(*_moments(columns))
    return rows_per_column(
        aggregated,
        {
            c: {
                "count": F.col(f"_count_{i}"),
                "mean": F.col(f"_mean_{i}"),
                "std": F.col(f"_std_{i}"),
                "min": F.col(f"_min_{i}"),
                "q25": _number(quartiles[c][0]),
                "median": _number(quartiles[c][1]),
                "q75": _number(quartiles[c][2]),
                "max": F.col(f"_max_{i}"),
            }
            for i, c in enumerate(columns)
        },
    )


def min_max_std(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    aggregated = df.agg(*_moments(columns))
    return rows_per_column(
        aggregated,
        {
            c: {"min": F.col(f"_min_{i}"), "max": F.col(f"_max_{i}"), "std": F.col(f"_std_{i}")}
            for i, c in enumerate(columns)
        },
    )


def _moments(columns: Sequence[str]) -> list[Column]:
    made = []
    for i, c in enumerate(columns):
        value = F.nanvl(quoted(c).cast("double"), F.lit(None).cast("double"))
        made += [
            F.count(value).alias(f"_count_{i}"),
            F.avg(value).alias(f"_mean_{i}"),
            F.stddev_samp(value).alias(f"_std_{i}"),
            F.min(value).alias(f"_min_{i}"),
            F.max(value).alias(f"_max_{i}"),
        ]
    return made


def _number(value: float | None) -> Column:
    return F.lit(value).cast("double")


def describe_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, distinct values, most frequent value and its frequency per column."""
    counted = value_counts(df, columns).where(F.col("value").isNotNull())
    best = F.min(F.struct((-F.col("n")).alias("n"), "value"))
    return (
        counted.groupBy("column")
        .agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), best.alias("best"))
        .select(
            "column",
            "count",
            "unique",
            F.col("best.value").alias("top"),
            (-F.col("best.n")).alias("freq"),
        )
    )


def table_info(df: DataFrame) -> DataFrame:
    """Position, name, type and non-null count of every column."""
    aggregated = df.agg(*[F.count(quoted(c)).alias(f"_n_{i}") for i, c in enumerate(df.columns)])
    return rows_per_column(
        aggregated,
        {
            f.name: {
                "position": F.lit(i),
                "type": F.lit(f.dataType.simpleString()),
                "n_non_null": F.col(f"_n_{i}"),
            }
            for i, f in enumerate(df.schema.fields)
        },
    )


def class_distribution(df: DataFrame, column: str) -> DataFrame:
    """Rows and percentage per value of ``column`` (a label or a prediction)."""
    counted = df.groupBy(quoted(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.select("value", "n", (F.col("n") * 100.0 / total).alias("pct")).orderBy("value")


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Counts of classes 0 and 1; balanced if they differ by less than 10% of all rows."""
    counted = df.agg(
        F.count_if(quoted(label) == 0).alias("n_0"),
        F.count_if(quoted(label) == 1).alias("n_1"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    gap = F.abs(F.col("n_0") - F.col("n_1"))
    return counted.withColumn("balanced", gap < F.col("n_rows") * F.lit(fixed.BALANCE_TOLERANCE))


def distinct_counts(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Distinct values per column, without and with NULL counted as a value."""
    if exact:
        return (
            value_counts(df, columns)
            .groupBy("column")
            .agg(F.count("value").alias("n_distinct"), F.count(F.lit(1)).alias("n_with_null"))
        )
    aggregated = df.agg(
        *[e for i, c in enumerate(columns) for e in (
            F.approx_count_distinct(quoted(c)).alias(f"_d_{i}"),
            F.max(quoted(c).isNull().cast("bigint")).alias(f"_null_{i}"),
        )]
    )
    return rows_per_column(
        aggregated,
        {
            c: {
                "n_distinct": F.col(f"_d_{i}"),
                "n_with_null": F.col(f"_d_{i}") + F.coalesce(F.col(f"_null_{i}"), F.lit(0)),
            }
            for i, c in enumerate(columns)
        },
    )


def distinct_value_lists(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Values of columns with at most 10 of them, the first 10 if there are at most 20.

    Ranks stop at 21 per column and task before the shuffle, so a column with many
    values never gathers them.
    """
    distinct = long_form(df, columns, "string").where(F.col("value").isNotNull()).distinct()
    order = W.partitionBy("column").orderBy("value")
    first = distinct.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= fixed.LIST_SOME_UP_TO + 1
    )
    listed = F.sort_array(F.collect_list("value"))
    return (
        first.groupBy("column")
        .agg(listed.alias("found"))
        .select(
            "column",
            F.when(F.size("found") <= fixed.LIST_SOME_UP_TO, F.slice("found", 1, fixed.LIST_ALL_UP_TO)).alias(
                "values"
            ),
        )
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = fixed.HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins per column, the last one closed; empty bins appear with 0.

    All columns share two scans: the bounds, then one count of (column, bin).
    """
    ends = df.agg(*[e for c in columns for e in (F.min(quoted(c)), F.max(quoted(c)))]).first()
    bounds = {}
    for i, c in enumerate(columns):
        if ends[2 * i] is not None:
            low, high = float(ends[2 * i]), float(ends[2 * i + 1])
            bounds[c] = (low - 0.5, high + 0.5) if low == high else (low, high)

    def bin_of(c: str) -> Column:
        low, high = bounds[c]
        place = F.floor((quoted(c).cast("double") - F.lit(low)) / F.lit((high - low) / bins))
        return F.least(place, F.lit(bins - 1)).cast("int")

    binned = df.select(*[bin_of(c).alias(c) for c in bounds])
    counted = (
        long_form(binned, list(bounds), "int")
        .where(F.col("value").isNotNull())
        .groupBy("column", F.col("value").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    grid = [
        (c, b, low + b * (high - low) / bins, low + (b + 1) * (high - low) / bins)
        for c, (low, high) in bounds.items()
        for b in range(bins)
    ]
    edges = df.sparkSession.createDataFrame(
        grid, "column string, bin int, lower double, upper double"
    )
    return edges.join(counted, ["column", "bin"], "left").select(
        "column", "bin", "lower", "upper", F.coalesce("n", F.lit(0).cast("bigint")).alias("n")
    )


def box_summary(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Quartiles, whiskers (most extreme data within 1.5 IQR) and points beyond them."""
    found = quantiles(df, columns, [0.25, 0.5, 0.75], exact)
    aggregates, fields = [], {}
    for i, c in enumerate(c for c in columns if found[c][0] is not None):
        q1, median, q3 = found[c]
        lower, upper = iqr_reach(q1, q3)
        value = quoted(c).cast("double")
        outside = is_outside(value, lower, upper)
        # a whisker never ends inside the box
        low = F.min(F.when(~outside & (value <= F.lit(q1)), value))
        high = F.max(F.when(~outside & (value >= F.lit(q3)), value))
        aggregates += [
            F.coalesce(low, F.lit(q1)).alias(f"_low_{i}"),
            F.coalesce(high, F.lit(q3)).alias(f"_high_{i}"),
            F.count_if(outside).alias(f"_out_{i}"),
        ]
        fields[c] = {
            "q1": _number(q1),
            "median": _number(median),
            "q3": _number(q3),
            "whisker_low": F.col(f"_low_{i}"),
            "whisker_high": F.col(f"_high_{i}"),
            "n_fliers": F.col(f"_out_{i}"),
        }
    return rows_per_column(df.agg(*aggregates), fields)
