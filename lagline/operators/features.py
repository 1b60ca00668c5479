"""Feature columns: label and date stages, one-hot coding, scaling, selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagline import fixed_values as fixed
from lagline.functions.columns import long_form, numeric_columns, quoted, rows_per_column
from lagline.functions.dates import add_date_parts
from lagline.functions.labels import add_late_label
from lagline.functions.ranks import running_totals
from lagline.operators.cleaning import _replace, _Stage
from lagline.operators.correlation import (
    columns_correlated_with_earlier,
    correlation_pairs,
    vector_selection,
)
from lagline.session import scratch_path

class LateLabeler(Transformer, _Stage):
    """Adds the late label from real and scheduled days, where both columns exist."""

    realCol = Param(Params._dummy(), "realCol", "real days", TypeConverters.toString)
    scheduledCol = Param(Params._dummy(), "scheduledCol", "scheduled days", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label to add", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, realCol=fixed.REAL_DAYS, scheduledCol=fixed.SCHEDULED_DAYS, labelCol=fixed.LABEL):
        super().__init__()
        self._configure(realCol=realCol, scheduledCol=scheduledCol, labelCol=labelCol)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        real, scheduled = self.getOrDefault(self.realCol), self.getOrDefault(self.scheduledCol)
        if real not in dataset.columns:  # new data: the outcome is not known yet
            return dataset
        return add_late_label(dataset, real, scheduled, self.getOrDefault(self.labelCol))


class DateParts(Transformer, _Stage):
    """Replaces a date column by its calendar parts."""

    inputCol = Param(Params._dummy(), "inputCol", "date column", TypeConverters.toString)
    prefix = Param(Params._dummy(), "prefix", "prefix of the new columns", TypeConverters.toString)
    format = Param(Params._dummy(), "format", "pattern of text dates", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=fixed.ORDER_DATE, prefix=fixed.DATE_PART_PREFIX, format=None):
        super().__init__()
        self._configure(inputCol=inputCol, prefix=prefix, format=format)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fmt = self.getOrDefault(self.format) if self.isSet(self.format) else None
        return add_date_parts(dataset, self.getOrDefault(self.inputCol), self.getOrDefault(self.prefix), fmt)


# --- one-hot ------------------------------------------------------------------


def level_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, slot, width): the distinct values of each column, numbered in their order.

    A dictionary of any size: values are sorted over range partitions and numbered by running
    counts, so no task and not the driver holds a column's values. NULL is no level.
    """
    distinct = long_form(df, columns, "string").where(F.col("value").isNotNull()).distinct()
    numbered = running_totals(distinct.withColumn("one", F.lit(1).cast("long")), "column", "value", ["one"], ascending=True)
    return numbered.select("column", "value", (F.col("cum_one") - 1).alias("slot"), F.col("total_one").alias("width"))


def with_level_slots(df: DataFrame, columns: Sequence[str], levels: DataFrame, suffix: str = "_slot") -> DataFrame:
    """Adds ``<column>_slot``, the number of the row's level; NULL for missing and unseen values.

    The sides are joined by value, in the way that their sizes allow.
    """
    for i, c in enumerate(columns):
        value, slot = f"_level_{i}", f"_slot_{i}"
        own = levels.where(F.col("column") == c).select(F.col("value").alias(value), F.col("slot").alias(slot))
        df = df.join(own, quoted(c).cast("string") == F.col(value), "left").drop(value).withColumnRenamed(slot, f"{c}{suffix}")
    return df


def category_levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct values per column, for ``one_hot_wide``, where each becomes a column."""
    levels: dict[str, list[str]] = {c: [] for c in columns}
    for r in level_table(df, columns).orderBy("column", "slot").collect():
        levels[r["column"]].append(r["value"])
    return levels


def one_hot_wide(
    df: DataFrame, levels: dict[str, list[str]], drop_first: bool = False
) -> DataFrame:
    """0/1 columns ``<column>_<value>`` in place of each text column."""
    flags = [
        F.coalesce((quoted(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
        for c, values in levels.items()
        for v in values[1 if drop_first else 0 :]
    ]
    return df.select(*[quoted(c) for c in df.columns if c not in levels], *flags)


class _LevelWriter(DefaultParamsWriter):
    """Saves the dictionary beside the parameters."""

    def saveImpl(self, path: str) -> None:  # noqa: N802
        super().saveImpl(path)
        self.sparkSession.read.parquet(self.instance.getOrDefault("levels")).write.parquet(f"{path}/levels")


class _LevelReader(DefaultParamsReader):
    def load(self, path: str) -> LevelCoderModel:
        stage = super().load(path)
        stage._configure(levels=f"{path}/levels")
        return stage


class LevelCoderModel(Model, _Stage):
    """Codes text columns as sparse vectors by a dictionary table.

    Missing and unseen values, and the first level where ``dropFirst`` is set, become all zeros.
    """

    columns = Param(Params._dummy(), "columns", "text columns", TypeConverters.toListString)
    widths = Param(Params._dummy(), "widths", "levels of each column", TypeConverters.toListInt)
    levels = Param(Params._dummy(), "levels", "path of the dictionary", TypeConverters.toString)
    dropFirst = Param(Params._dummy(), "dropFirst", "no slot for the first level", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, columns=None, widths=None, levels=None, dropFirst=False):
        super().__init__()
        self._configure(**self._input_kwargs)

    def write(self) -> _LevelWriter:
        return _LevelWriter(self)

    @classmethod
    def read(cls) -> _LevelReader:
        return _LevelReader(cls)

    def kept(self) -> dict[str, int]:
        """Slots of each column that has any."""
        first = int(self.getOrDefault(self.dropFirst))
        return {c: w - first for c, w in zip(self.getOrDefault(self.columns), self.getOrDefault(self.widths)) if w > first}

    def outputs(self) -> list[str]:
        return [f"{c}__hot" for c in self.kept()]

    def slot_names(self) -> list[str]:
        """Names of all slots in order, on the driver: for models whose slots are few."""
        levels = SparkSession.active().read.parquet(self.getOrDefault(self.levels))
        found = {(r["column"], r["slot"]): r["value"] for r in levels.collect()}
        first = int(self.getOrDefault(self.dropFirst))
        return [f"{c}_{found[c, s + first]}" for c, n in self.kept().items() for s in range(n)]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        kept, first = self.kept(), int(self.getOrDefault(self.dropFirst))
        if not kept:
            return dataset
        levels = dataset.sparkSession.read.parquet(self.getOrDefault(self.levels))
        coded = with_level_slots(dataset, list(kept), levels, "__index")
        for c, n in kept.items():
            slot = quoted(f"{c}__index") - first
            known = F.when(slot >= 0, slot).otherwise(n).cast("double")  # the encoder drops the slot after the last
            attributes = {"ml_attr": {"type": "nominal", "num_vals": n + 1, "name": c}}
            coded = coded.withColumn(f"{c}__index", known.alias(f"{c}__index", metadata=attributes))
        indexes = [f"{c}__index" for c in kept]
        coder = OneHotEncoder(inputCols=indexes, outputCols=self.outputs(), dropLast=True)
        return coder.fit(coded.limit(0)).transform(coded).drop(*indexes)


def fit_one_hot(df: DataFrame, columns: Sequence[str], drop_first: bool = False) -> tuple[list[LevelCoderModel], list[str]]:
    """The fitted stage coding text columns as sparse vectors, and the names of these.

    One scan learns the levels of all columns; the dictionary is written to the scratch folder.
    """
    if not columns:
        return [], []
    path = scratch_path(df.sparkSession, "levels")
    level_table(df, columns).write.parquet(path)
    found = df.sparkSession.read.parquet(path).groupBy("column").agg(F.first("width").alias("width")).collect()  # a row a column
    widths = {r["column"]: r["width"] for r in found}
    stage = LevelCoderModel(columns=list(columns), widths=[int(widths.get(c, 0)) for c in columns], levels=path, dropFirst=drop_first)
    return [stage], stage.outputs()


# --- scaling ------------------------------------------------------------------


class StandardizerModel(Model, _Stage):
    """Centres and scales columns with learned means and population deviations."""

    means = Param(Params._dummy(), "means", "mean by column")
    scales = Param(Params._dummy(), "scales", "divisor by column")

    def __init__(self, means: dict | None = None, scales: dict | None = None):
        super().__init__()
        self._configure(means=means, scales=scales)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        means, scales = self.getOrDefault(self.means), self.getOrDefault(self.scales)
        return _replace(
            dataset,
            {c: (quoted(c).cast("double") - F.lit(means[c])) / F.lit(scales[c]) for c in means},
        )


class Standardizer(Estimator, _Stage):
    """Learns mean and population deviation; a constant column is only centred."""

    columns = Param(Params._dummy(), "columns", "numeric columns", TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "label, never scaled", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, columns=None, labelCol=None):
        super().__init__()
        self._configure(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> StandardizerModel:
        skip = [self.getOrDefault(self.labelCol)] if self.isSet(self.labelCol) else []
        chosen = self.getOrDefault(self.columns) if self.isSet(self.columns) else numeric_columns(dataset, skip)
        values = [quoted(c).cast("double") for c in chosen]
        if not chosen:
            return StandardizerModel({}, {})
        row = dataset.agg(*[e for v in values for e in (F.avg(v), F.stddev_pop(v))]).first()
        means = {c: float(row[2 * i] or 0.0) for i, c in enumerate(chosen)}
        return StandardizerModel(means, {c: float(row[2 * i + 1] or 1.0) for i, c in enumerate(chosen)})


# --- selection ----------------------------------------------------------------


def column_variances(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Population variance per column, one scan."""
    variances = [F.var_pop(quoted(c).cast("double")).alias(f"_v{i}") for i, c in enumerate(columns)]
    return rows_per_column(
        df.agg(*variances), {c: {"variance": F.col(f"_v{i}")} for i, c in enumerate(columns)}
    )


def low_variance_columns(
    df: DataFrame, columns: Sequence[str], threshold: float = fixed.VARIANCE_THRESHOLD
) -> list[str]:
    """Columns whose population variance does not exceed the threshold."""
    low = column_variances(df, columns).where(F.col("variance") <= threshold).collect()
    names = {r["column"] for r in low}
    return [c for c in columns if c in names]


def correlated_columns(
    df: DataFrame, columns: Sequence[str], threshold: float = fixed.CORRELATION_DEFAULT
) -> list[str]:
    """Columns whose |r| with an earlier column exceeds the threshold."""
    found = columns_correlated_with_earlier(correlation_pairs(df, columns), threshold).collect()
    names = {r["column"] for r in found}
    return [c for c in columns if c in names]


def select_vector_slots(
    df: DataFrame,
    features: str,
    shift: Sequence[float],
    variance_threshold: float,
    correlation_threshold: float,
) -> list[int]:
    """Slots of an assembled vector that vary enough and repeat no earlier slot.

    ``shift`` holds a value near each slot's mean.
    """
    return vector_selection(df, features, shift, variance_threshold, correlation_threshold)
