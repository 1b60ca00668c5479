"""Duplicates, missing values, outliers and rare categories.

Fitted operators are ``pyspark.ml`` estimators: fitting is a few aggregates for all
columns together, the fitted model holds only those numbers and applies them as literals
in one projection, so applying never shuffles and also works on streams.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagline import fixed_values as fixed
from lagline.functions.columns import (
    drop_columns,
    nan_to_null,
    numeric_columns,
    quoted,
    rows_per_column,
    string_columns,
)
from lagline.functions.bitset import may_hold, repeated
from lagline.functions.heavy import most_frequent
from lagline.functions.quantiles import quantiles
from lagline.session import stage_table


class _Stage(DefaultParamsReadable, DefaultParamsWritable):
    """Common part of the column stages: keyword parameters and persistence."""

    def _configure(self, **values):
        self._set(**{k: v for k, v in values.items() if v is not None})


def _replace(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    return df.select(*[new[c].alias(c) if c in new else quoted(c) for c in df.columns])


# --- duplicates ---------------------------------------------------------------


def _maybe_copied(df: DataFrame) -> Column | None:
    """Whether a row's hash occurs more than once; ``None`` if none does.

    Only hashes are shuffled for this, and copies collapse before they are.
    """
    hashed = F.xxhash64(*[quoted(c) for c in df.columns])
    again = stage_table(repeated(df.select(hashed.alias("h"))), "repeated-hashes")
    return may_hold(again, "h", hashed)


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Distinct rows; NULLs compare equal.

    Rows are shuffled whole and compared only if another row has the same hash. The rest stays
    where it is, so ``df`` is read twice: stage it first where that is dear.
    """
    return reduce(DataFrame.unionAll, distinct_parts(df))


def distinct_parts(df: DataFrame, shares: int = 1) -> list[DataFrame]:
    """The distinct rows in parts: those without a copy, then the others by hash in ``shares`` parts.

    Where many rows have copies, writing one part after another bounds the rows shuffled at once.
    """
    copied = _maybe_copied(df)
    if copied is None:
        return [df]
    flagged = df.withColumn("_copied", copied)
    alone, copies = flagged.where(~F.col("_copied")).drop("_copied"), flagged.where("_copied").drop("_copied")
    if shares == 1:
        return [alone, copies.dropDuplicates()]
    share = F.pmod(F.xxhash64(*[quoted(c) for c in df.columns]), F.lit(shares))
    return [alone, *[copies.where(share == k).dropDuplicates() for k in range(shares)]]


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row, and their share in percent."""
    copied = _maybe_copied(df)
    flagged = df.withColumn("_copied", F.lit(False) if copied is None else copied)
    alone = flagged.where(~F.col("_copied")).agg(F.count(F.lit(1)).alias("n"), F.count(F.lit(1)).alias("kinds"))
    groups = flagged.where("_copied").groupBy(*[quoted(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("_n"))
    copies = groups.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("kinds"))
    total, again = F.sum("n"), F.sum("n") - F.sum("kinds")
    return alone.unionAll(copies).agg(
        total.alias("n_rows"),
        again.alias("n_duplicates"),
        F.coalesce(F.try_divide(again * 100.0, total), F.lit(0.0)).alias("pct_duplicates"),
    )


# --- missing values -----------------------------------------------------------


def null_counts(df: DataFrame) -> DataFrame:
    """(column, n_null, pct_null) for every column from one scan, most NULLs first; NaN is missing, too."""
    counted = nan_to_null(df).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(quoted(c).isNull()).alias(f"_null_{i}") for i, c in enumerate(df.columns)],
    )
    fields = {
        c: {
            "n_null": F.col(f"_null_{i}"),
            "pct_null": F.try_divide(F.col(f"_null_{i}") * 100.0, F.col("_rows")),
        }
        for i, c in enumerate(df.columns)
    }
    return rows_per_column(counted, fields).orderBy(F.desc("n_null"), "column")


def columns_with_nulls(df: DataFrame) -> DataFrame:
    return null_counts(df).where("n_null > 0")


def total_nulls(df: DataFrame) -> DataFrame:
    return null_counts(df).agg(F.sum("n_null").alias("n_null"))


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, mode, n): the most frequent value, the smallest on ties.

    Found by bounded summaries, so no task holds a column's value map. A column
    without any value has no row here; ``mode_values`` gives it ``'Unknown'``.
    """
    best = most_frequent(df, columns, 1, nulls=False)
    return best.select("column", F.col("value").alias("mode"), "n")


def mode_values(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The mode of each column as a dictionary: one value per column reaches the driver."""
    if not columns:
        return {}
    found = {r["column"]: r["mode"] for r in modes(df, columns).collect()}
    return {c: found.get(c, fixed.UNKNOWN) for c in columns}


def median_values(df: DataFrame, columns: Sequence[str], exact: bool = True) -> dict[str, float]:
    found = quantiles(df, columns, [0.5], exact)
    return {c: found[c][0] for c in columns if found[c][0] is not None}


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _replace(nan_to_null(df), {c: F.coalesce(quoted(c), F.lit(0)) for c in columns})


class GapFillerModel(Model, _Stage):
    """Fills numeric columns with medians and text columns with modes."""

    medians = Param(Params._dummy(), "medians", "median by numeric column")
    modes = Param(Params._dummy(), "modes", "mode by text column")

    def __init__(self, medians: dict | None = None, modes: dict | None = None):
        super().__init__()
        self._configure(medians=medians, modes=modes)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        dataset = nan_to_null(dataset)
        fill = {
            c: F.coalesce(quoted(c).cast("double"), F.lit(float(m)))
            for c, m in self.getOrDefault(self.medians).items()
        }
        fill |= {c: F.coalesce(quoted(c), F.lit(m)) for c, m in self.getOrDefault(self.modes).items()}
        return _replace(dataset, fill)


class GapFiller(Estimator, _Stage):
    """Learns medians of numeric and modes of text columns (all of them by default)."""

    numericCols = Param(Params._dummy(), "numericCols", "numeric columns", TypeConverters.toListString)
    textCols = Param(Params._dummy(), "textCols", "text columns", TypeConverters.toListString)
    exact = Param(Params._dummy(), "exact", "exact medians", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, numericCols=None, textCols=None, exact=True):
        super().__init__()
        self._configure(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> GapFillerModel:
        numeric = self.getOrDefault(self.numericCols) if self.isSet(self.numericCols) else numeric_columns(dataset)
        text = self.getOrDefault(self.textCols) if self.isSet(self.textCols) else string_columns(dataset)
        exact = self.getOrDefault(self.exact) if self.isSet(self.exact) else True
        return GapFillerModel(median_values(dataset, numeric, exact), mode_values(dataset, text))


# --- outliers -----------------------------------------------------------------


def iqr_reach(q1: float, q3: float) -> tuple[float, float]:
    reach = fixed.IQR_FACTOR * (q3 - q1)
    return q1 - reach, q3 + reach


def iqr_limits(
    df: DataFrame, columns: Sequence[str], exact: bool = True
) -> dict[str, dict[str, float]]:
    """Quartiles and Q1 - 1.5 IQR, Q3 + 1.5 IQR per column that has values."""
    limits = {}
    for c, (q1, q3) in quantiles(df, columns, [0.25, 0.75], exact).items():
        if q1 is not None:
            lower, upper = iqr_reach(q1, q3)
            limits[c] = {"q1": q1, "q3": q3, "lower": lower, "upper": upper}
    return limits


def iqr_table(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    limits = iqr_limits(df, columns, exact)
    rows = [(c, b["q1"], b["q3"], b["lower"], b["upper"]) for c, b in limits.items()]
    return df.sparkSession.createDataFrame(
        rows, "column string, q1 double, q3 double, lower double, upper double"
    )


def is_outside(column: Column, lower: float, upper: float) -> Column:
    """Whether a value lies beyond the limits; NULL for missing values, NaN among them."""
    outside = (column < F.lit(lower)) | (column > F.lit(upper))
    return F.when(~F.isnan(column.cast("double")), outside)


def outlier_rows(df: DataFrame, column: str, exact: bool = True) -> DataFrame:
    """Rows whose value lies outside the IQR limits of its column."""
    limits = iqr_limits(df, [column], exact)
    if column not in limits:
        return df.where(F.lit(False))
    b = limits[column]
    return df.where(is_outside(quoted(column), b["lower"], b["upper"]))


def outlier_summary(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Outlier count, percentage and limits per column: one scan after the quartiles."""
    limits = iqr_limits(df, columns, exact)
    present = [c for c in columns if c in limits]
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[
            F.count_if(is_outside(quoted(c), limits[c]["lower"], limits[c]["upper"])).alias(f"_n_{i}")
            for i, c in enumerate(present)
        ],
    )
    return rows_per_column(
        counted,
        {
            c: {
                "n_outliers": F.col(f"_n_{i}"),
                "pct_outliers": F.try_divide(F.col(f"_n_{i}") * 100.0, F.col("_rows")),
                "lower": F.lit(limits[c]["lower"]),
                "upper": F.lit(limits[c]["upper"]),
            }
            for i, c in enumerate(present)
        },
    )


class IqrCapperModel(Model, _Stage):
    """Pulls values outside the learned limits back to the nearer limit."""

    lower = Param(Params._dummy(), "lower", "lower limit by column")
    upper = Param(Params._dummy(), "upper", "upper limit by column")

    def __init__(self, lower: dict | None = None, upper: dict | None = None):
        super().__init__()
        self._configure(lower=lower, upper=upper)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        lower, upper = self.getOrDefault(self.lower), self.getOrDefault(self.upper)

        def cap(c: str) -> Column:
            value = quoted(c).cast("double")
            capped = F.least(F.greatest(value, F.lit(float(lower[c]))), F.lit(float(upper[c])))
            return F.when(value.isNotNull(), capped)  # least/greatest would fill a NULL

        return _replace(dataset, {c: cap(c) for c in lower})


class IqrCapper(Estimator, _Stage):
    """Learns IQR limits of the given columns, or of all numeric ones but ``labelCol``."""

    columns = Param(Params._dummy(), "columns", "columns to cap", TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "label, never capped", TypeConverters.toString)
    exact = Param(Params._dummy(), "exact", "exact quartiles", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, columns=None, labelCol=None, exact=True):
        super().__init__()
        self._configure(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> IqrCapperModel:
        skip = [self.getOrDefault(self.labelCol)] if self.isSet(self.labelCol) else []
        chosen = self.getOrDefault(self.columns) if self.isSet(self.columns) else numeric_columns(dataset, skip)
        exact = self.getOrDefault(self.exact) if self.isSet(self.exact) else True
        limits = iqr_limits(dataset, chosen, exact)
        return IqrCapperModel(
            {c: b["lower"] for c, b in limits.items()}, {c: b["upper"] for c, b in limits.items()}
        )


# --- rare categories ----------------------------------------------------------


def top_values(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """The k most frequent values per column (NULL counts), ties by smaller value.

    Tasks send summaries of bounded size, so a column may have any number of values.
    """
    return most_frequent(df, columns, k)


def keep_or_other(column: Column, kept: Sequence[str], other: str = fixed.OTHER) -> Column:
    """The value if it is listed, else ``other``; NULL also becomes ``other``."""
    return F.when(column.isin(list(kept)), column).otherwise(F.lit(other))


class RareFolderModel(Model, _Stage):
    """Replaces values outside the learned lists; columns without a list stay as they are."""

    kept = Param(Params._dummy(), "kept", "values kept by column; null in a list keeps NULL")

    def __init__(self, kept: dict | None = None):
        super().__init__()
        self._configure(kept=kept)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        def fold(c: str, values: list[str | None]) -> Column:
            folded = keep_or_other(quoted(c), [v for v in values if v is not None])
            return F.when(quoted(c).isNotNull(), folded) if None in values else folded

        return _replace(dataset, {c: fold(c, v) for c, v in self.getOrDefault(self.kept).items()})


class RareFolder(Estimator, _Stage):
    """Learns the ``maxCategories`` most frequent values of columns that have more."""

    columns = Param(Params._dummy(), "columns", "text columns", TypeConverters.toListString)
    maxCategories = Param(Params._dummy(), "maxCategories", "values kept", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, columns=None, maxCategories=fixed.MAX_CATEGORIES):
        super().__init__()
        self._configure(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> RareFolderModel:
        chosen = self.getOrDefault(self.columns) if self.isSet(self.columns) else string_columns(dataset)
        k = self.getOrDefault(self.maxCategories) if self.isSet(self.maxCategories) else fixed.MAX_CATEGORIES
        if not chosen:
            return RareFolderModel({})
        seen: dict[str, list[tuple[int, str | None]]] = {}
        for r in top_values(dataset, chosen, k + 1).collect():  # k + 1 values per column
            seen.setdefault(r["column"], []).append((r["rank"], r["value"]))
        return RareFolderModel(
            {c: [v for rank, v in sorted(rows, key=lambda x: x[0]) if rank <= k] for c, rows in seen.items() if len(rows) > k}
        )


class ColumnDropper(Transformer, _Stage):
    """Drops the listed columns where present."""

    columns = Param(Params._dummy(), "columns", "columns to drop", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, columns=None):
        super().__init__()
        self._configure(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return drop_columns(dataset, self.getOrDefault(self.columns))

