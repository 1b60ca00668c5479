"""Pearson correlations between columns and the selections built on them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagline import fixed_values as fixed
from lagline.functions.columns import nan_to_null, quoted
from lagline.session import stage_table

BLOCK = 128  # columns multiplied at once
HELD_BYTES = 64 << 20  # sums a task keeps before it sends them
SUMS = ["n", "sx", "sy", "sxx", "syy", "sxy"]


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(i, j, left, right, r) for i < j over rows where both are present.

    r is NULL where it is undefined (a constant column, or fewer than two rows).
    """
    data = nan_to_null(df.select(*[quoted(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)]))
    means = data.agg(*[F.avg(c) for c in data.columns]).first()
    sums = pair_sums(data, [m or 0.0 for m in means])
    n = F.nullif(F.col("n"), F.lit(0.0))
    var_x = F.col("sxx") - F.col("sx") * F.try_divide(F.col("sx"), n)
    var_y = F.col("syy") - F.col("sy") * F.try_divide(F.col("sy"), n)
    # what is left of a constant column is rounding noise of its square sum
    noise_x, noise_y = F.col("sxx") * 1e-12, F.col("syy") * 1e-12
    covariance = F.col("sxy") - F.col("sx") * F.try_divide(F.col("sy"), n)
    defined = (var_x > noise_x) & (var_y > noise_y)
    pairs = sums.where("i < j").select("i", "j", F.when(defined, covariance / F.sqrt(var_x * var_y)).alias("r"))
    names = F.lit(list(columns))
    return pairs.select("i", "j", names[F.col("i")].alias("left"), names[F.col("j")].alias("right"), "r")


def pair_sums(data: DataFrame, shift: Sequence[float]) -> DataFrame:
    """(i, j, n, sx, sy, sxx, syy, sxy) for i <= j over rows where columns i and j are present.

    ``data`` has number columns, or one array column holding them all. Blocks of columns are
    multiplied batch by batch, values and presence masks apart; a task sends one row per pair,
    and sooner when the sums of all blocks would not fit ``HELD_BYTES``. Nothing of the size of
    the matrix reaches the driver. Values are shifted by ``shift``, which should be near the
    means: it keeps the sums well conditioned and changes nothing else.
    """
    offset = np.asarray(shift, dtype=float)
    cuts = [slice(s, min(s + BLOCK, len(offset))) for s in range(0, len(offset), BLOCK)]
    held_at_most = max(1, HELD_BYTES // (len(SUMS) * BLOCK * BLOCK * 8))

    def rows(held: dict) -> Iterator[pa.RecordBatch]:
        for (left, right), sums in held.items():
            i, j = np.meshgrid(np.arange(left.start, left.stop), np.arange(right.start, right.stop), indexing="ij")
            use = i <= j
            columns = [i[use].astype(np.int32), j[use].astype(np.int32), *[m[use] for m in sums]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["i", "j", *SUMS])
        held.clear()

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            if pa.types.is_list(batch.schema.field(0).type):
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            else:
                x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            x = x.astype(float) - offset
            there = (~np.isnan(x)).astype(float)
            x = np.where(there > 0, x, 0.0)
            for a, left in enumerate(cuts):
                for right in cuts[a:]:
                    xl, xr, tl, tr = x[:, left], x[:, right], there[:, left], there[:, right]
                    sums = np.stack([tl.T @ tr, xl.T @ tr, tl.T @ xr, (xl * xl).T @ tr, tl.T @ (xr * xr), xl.T @ xr])
                    key = (left, right)
                    held[key] = held[key] + sums if key in held else sums
                    if len(held) > held_at_most:
                        yield from rows(held)
        yield from rows(held)

    schema = "i int, j int, " + ", ".join(f"{n} double" for n in SUMS)
    return data.mapInArrow(multiply, schema).groupBy("i", "j").agg(*[F.sum(n).alias(n) for n in SUMS])


def vector_selection(
    df: DataFrame, column: str, shift: Sequence[float], variance_threshold: float, correlation_threshold: float
) -> list[int]:
    """Slots of a vector column that vary enough and follow no earlier slot that does.

    One scan gives the pair sums; variances and pairs stay a table, and the driver gets the numbers
    of the slots that are kept.
    """
    sums = stage_table(pair_sums(df.select(vector_to_array(column).alias("x")), shift), "slot-pairs")
    mean_x, mean_y = F.col("sx") / F.col("n"), F.col("sy") / F.col("n")
    variance = (F.col("sxx") / F.col("n") - mean_x * mean_x).alias("variance")
    varied = sums.where("i = j").select(F.col("i").alias("slot"), variance).where(F.col("variance") > variance_threshold)
    covariance = F.col("sxy") / F.col("n") - mean_x * mean_y
    left = varied.select(F.col("slot").alias("i"), F.col("variance").alias("var_i"))
    right = varied.select(F.col("slot").alias("j"), F.col("variance").alias("var_j"))
    pairs = sums.where("i < j").select("i", "j", covariance.alias("c")).join(left, "i").join(right, "j")
    follows = F.abs(F.col("c") / (F.sqrt("var_i") * F.sqrt("var_j"))) > correlation_threshold
    kept = varied.join(pairs.where(follows).select(F.col("j").alias("slot")).distinct(), "slot", "left_anti")
    return sorted(r["slot"] for r in kept.select("slot").collect())


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long matrix (left, right, r): both triangles and a diagonal of 1."""
    pairs = correlation_pairs(df, columns).select("left", "right", "r")
    mirrored = F.inline(
        F.array(
            F.struct(F.col("left"), F.col("right"), F.col("r")),
            F.struct(F.col("right").alias("left"), F.col("left").alias("right"), F.col("r")),
        )
    )
    diagonal = df.sparkSession.createDataFrame(
        [(c, c, 1.0) for c in columns], "left string, right string, r double"
    )
    return pairs.select(mirrored).unionByName(diagonal)


def target_correlations(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Correlation of every other column with ``target``, largest first."""
    others = [c for c in columns if c != target]
    pairs = correlation_pairs(df, [target, *others])
    return (
        pairs.where(F.col("i") == 0)
        .select(F.col("right").alias("column"), "r")
        .orderBy(F.desc_nulls_last("r"), "column")
    )


def strong_pairs(pairs: DataFrame, threshold: float, or_equal: bool) -> DataFrame:
    """Pairs whose absolute correlation passes the threshold, strongest first."""
    strength = F.abs("r")
    passes = strength >= threshold if or_equal else strength > threshold
    return pairs.where(passes).orderBy(strength.desc(), "left", "right")


def correlation_summary(pairs: DataFrame) -> DataFrame:
    """Range, mean, population deviation and counts over both triangles."""

    def twice(threshold: float):
        return F.count_if(F.abs("r") >= threshold) * 2

    return pairs.agg(
        F.min("r").alias("min_r"),
        F.max("r").alias("max_r"),
        F.avg("r").alias("mean_r"),
        F.stddev_pop("r").alias("std_r"),
        twice(fixed.HIGH_CORRELATION).alias("n_high"),
        twice(fixed.MEDIUM_CORRELATION).alias("n_medium"),
        twice(fixed.LOW_CORRELATION).alias("n_low"),
    )


def columns_correlated_with_earlier(pairs: DataFrame, threshold: float) -> DataFrame:
    """Columns whose |r| with any earlier column exceeds the threshold, dropped or not."""
    return pairs.where(F.abs("r") > threshold).select(F.col("right").alias("column")).distinct()


def prune_for_target(
    df: DataFrame, columns: Sequence[str], target: str, threshold: float = fixed.MEDIUM_CORRELATION
) -> list[str]:
    """Columns to drop so that no kept pair exceeds the threshold.

    Of each pair the column closer to ``target`` stays, the earlier one on ties. Works on
    the collected correlations: columns squared, never rows.
    """
    pairs = correlation_pairs(df, columns).collect()
    strength = {(p["i"], p["j"]): abs(p["r"] or 0.0) for p in pairs}
    t = list(columns).index(target)
    closeness = {k: strength[min(k, t), max(k, t)] for k in range(len(columns)) if k != t}
    dropped: set[int] = set()
    for i in closeness:
        for j in (k for k in closeness if k > i and k not in dropped):
            if i in dropped:
                break
            if strength[i, j] > threshold:
                dropped.add(j if closeness[i] >= closeness[j] else i)
    return [columns[k] for k in sorted(dropped)]
