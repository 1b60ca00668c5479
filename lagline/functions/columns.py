"""Column selection, renaming and per-column summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> Column:
    """Column by exact name, also with dots, spaces or brackets in it."""
    return F.col(quoted_name(name))


def trim_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Numeric columns; booleans do not count as numeric."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in exclude
    ]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in exclude
    ]


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the listed columns that exist; names that do not exist are ignored."""
    return df.select(*[quoted(c) for c in df.columns if c not in set(names)])


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def required_values(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column, present, n_values): whether each required column is there, and how many values it has."""
    counts = {c: F.count(quoted(c)) if c in df.columns else F.lit(0).cast("bigint") for c in names}
    counted = df.agg(F.count(F.lit(1)), *[e.alias(f"_n_{i}") for i, e in enumerate(counts.values())])
    return rows_per_column(counted, {c: {"present": F.lit(c in df.columns), "n_values": F.col(f"_n_{i}")} for i, c in enumerate(names)})


def split_label(df: DataFrame, label: str, key: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Features and label as two projections of the same rows; keys go with both."""
    require_columns(df, [label, *key])
    features = df.select(*[quoted(c) for c in df.columns if c != label])
    return features, df.select(*[quoted(c) for c in [*key, label]])


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in floating columns, so that one missing marker remains."""
    return df.select(
        *[
            F.when(~F.isnan(quoted(f.name)), quoted(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else quoted(f.name)
            for f in df.schema.fields
        ]
    )


def preview(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*[quoted(c) for c in order_by]).limit(n)


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns")
    )


def column_list(df: DataFrame) -> DataFrame:
    """One row per column: position, name and type. Read from the schema alone."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def rows_per_column(
    aggregated: DataFrame, rows: Mapping[str, Mapping[str, Column]], key: str = "column"
) -> DataFrame:
    """Turn a one-row aggregate into one row per source column.

    ``rows`` maps each source column to the named expressions of its output row.
    """
    structs = [
        F.struct(F.lit(name).alias(key), *[e.alias(a) for a, e in fields.items()])
        for name, fields in rows.items()
    ]
    return aggregated.select(F.inline(F.array(*structs)))


def long_form(df: DataFrame, columns: Sequence[str], as_type: str, keep: Sequence[str] = ()) -> DataFrame:
    """Unpivot ``columns`` to (column, value) rows; NULL values stay in."""
    wide = df.select(*[quoted(c) for c in keep], *[quoted(c).cast(as_type).alias(c) for c in columns])
    return wide.unpivot(
        [quoted(c) for c in keep], [quoted(c) for c in columns], "column", "value"
    )


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for all listed columns in one job; NULL counts as a value.

    The count is partial-aggregated before its shuffle, so a value held by a third of
    all rows costs one row per task.
    """
    return (
        long_form(df, columns, "string")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
