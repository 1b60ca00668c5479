"""The exploratory profile of a table as one plan with few scans.

The columns studied are written once as a narrow table. One aggregate over it carries the counts,
moments and quantile sketches of all columns together; the quartiles are then made exact, and one
more aggregate counts outliers and box limits. Categories come from one count of (column, value).
All answers are rows (column, stat, value).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagline import fixed_values as fixed
from lagline.functions.columns import nan_to_null, quoted, value_counts
from lagline.functions.quantiles import quantile_sketches, quantiles
from lagline.operators.cleaning import iqr_reach, is_outside
from lagline.operators.correlation import correlation_pairs
from lagline.session import stage_table

QUARTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75}
TABLE = "*"  # the "column" of answers about the whole table


def profile(
    df: DataFrame,
    numeric: Sequence[str] = fixed.PROFILE_NUMERIC_COLUMNS,
    categories: Sequence[str] = fixed.PROFILE_CATEGORY_COLUMNS,
    label: str | None = fixed.LABEL,
) -> DataFrame:
    """(column, stat, value) for all columns that the table has.

    Numbers: count, nulls, mean, sample deviation, minimum, quartiles, maximum, IQR limits and what
    lies outside, whiskers, correlation with the label. Categories: count, nulls, distinct values,
    frequency of the most frequent one, and the count of each value where they are few. The table:
    rows, and rows of either class.
    """
    numeric, categories = ([c for c in wanted if c in df.columns] for wanted in (numeric, categories))
    label = label if label in df.columns else None
    kept = list(dict.fromkeys([*numeric, *categories, *([label] if label else [])]))
    if not kept:
        return df.agg(F.lit(TABLE).alias("column"), F.lit("n_rows").alias("stat"), F.count(F.lit(1)).cast("double").alias("value"))
    staged = stage_table(nan_to_null(df.select(*[quoted(c) for c in kept])), "profile")

    answers: list[tuple[str, str, float | None]] = []
    value = {c: quoted(c).cast("double") for c in numeric}
    classes = [F.count_if(quoted(label) == y).alias(f"class_{y}") for y in (0, 1)] if label else []
    moments = {
        "count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max,
    }
    wide = [f(value[c]).cast("double").alias(f"{s}|{i}") for i, c in enumerate(numeric) for s, f in moments.items()]
    wide += [F.count_if(quoted(c).isNull()).alias(f"n_null|{i}") for i, c in enumerate(numeric)]
    row = staged.agg(F.count(F.lit(1)).alias("n_rows"), *classes, *wide).first().asDict()
    answers += [(TABLE, name, float(n)) for name, n in row.items() if "|" not in name]
    answers += [(numeric[int(k.split("|")[1])], k.split("|")[0], v) for k, v in row.items() if "|" in k]

    sketches = stage_table(quantile_sketches(staged, numeric), "profile-sketches") if numeric else None
    found = quantiles(staged, numeric, list(QUARTILES.values()), sketches=sketches)
    some = [c for c in numeric if found[c][0] is not None]
    reach = {c: iqr_reach(found[c][0], found[c][2]) for c in some}
    answers += [(c, s, q) for c in numeric for s, q in zip(QUARTILES, found[c])]
    answers += [(c, s, v) for c in some for s, v in zip(("lower", "upper"), reach[c])]
    if some:
        outside = {c: is_outside(value[c], *reach[c]) for c in some}
        box = [
            e
            for i, c in enumerate(some)
            for e in (
                F.count_if(outside[c]).alias(f"n_outside|{i}"),
                F.min(F.when(~outside[c], value[c])).alias(f"whisker_low|{i}"),
                F.max(F.when(~outside[c], value[c])).alias(f"whisker_high|{i}"),
            )
        ]
        row = staged.agg(*box).first().asDict()
        answers += [(some[int(k.split("|")[1])], k.split("|")[0], v) for k, v in row.items()]

    rows = [(c, s, None if v is None else float(v)) for c, s, v in answers]
    out = df.sparkSession.createDataFrame(rows, "column string, stat string, value double")
    if categories:
        out = out.unionAll(_categories(staged, categories))
    if label and numeric:
        pairs = correlation_pairs(staged, [label, *[c for c in numeric if c != label]]).where("i = 0")
        out = out.unionAll(pairs.select(F.col("right").alias("column"), F.lit("label_correlation").alias("stat"), F.col("r").alias("value")))
    return out


def _categories(staged: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Answers about text columns from one count of their values."""
    counted = stage_table(value_counts(staged, columns), "profile-values")
    there = F.col("value").isNotNull()
    sums = counted.groupBy("column").agg(
        F.sum(F.when(there, F.col("n")).otherwise(0)).alias("count"),
        F.sum(F.when(~there, F.col("n")).otherwise(0)).alias("n_null"),
        F.count("value").alias("n_distinct"),
        F.max(F.when(there, F.col("n"))).alias("freq"),
    )
    stats = ["count", "n_null", "n_distinct", "freq"]
    long = sums.unpivot("column", [F.col(s).cast("double").alias(s) for s in stats], "stat", "value")
    few = sums.where(F.col("n_distinct") <= fixed.LIST_ALL_UP_TO).select("column")
    each = counted.where(there).join(few, "column").select("column", F.concat(F.lit("n of "), "value").alias("stat"), F.col("n").cast("double").alias("value"))
    return long.unionAll(each)
