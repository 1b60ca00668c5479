"""Exact stratified splits and folds by hash cut points.

A row's side depends only on its label and the hash of its key, so both operators are
projections: rows never move, and new rows can be placed the same way.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagline import fixed_values as fixed
from lagline.functions.columns import quoted, require_columns
from lagline.functions.ranks import class_hash_cuts, row_hash

TRAIN, TEST = "train", "test"


def test_rows_by_class(counts: dict[Any, int], test_size: float) -> dict[Any, int]:
    """Test rows per class: ceil(test_size * n) in total, train shares by largest remainder."""
    total = sum(counts.values())
    n_train = total - math.ceil(round(test_size * total, 9))
    shares = {c: n_train * n / total for c, n in counts.items()}
    train = {c: math.floor(s) for c, s in shares.items()}
    order = sorted(counts, key=lambda c: (train[c] - shares[c], c))
    for c in order[: n_train - sum(train.values())]:
        train[c] += 1
    return {c: counts[c] - train[c] for c in counts}


def fold_rows_by_class(counts: dict[Any, int], k: int) -> dict[Any, list[int]]:
    """Rows of each class per fold: the sorted labels dealt out in turn, sizes differ by <= 1."""
    result, start = {}, 0
    for c in sorted(counts):
        end = start + counts[c]
        result[c] = [len(range(start + (f - start) % k, end, k)) for f in range(k)]
        start = end
    return result


def _by_class(label: str, cuts: dict[Any, list[str]], make) -> Column:
    chosen = F.lit(None)
    for value, hashes in cuts.items():
        chosen = F.when(quoted(label) == F.lit(value), make(hashes)).otherwise(chosen)
    return chosen


def stratified_split(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    test_size: float = fixed.TEST_SIZE,
    seed: int = fixed.SEED,
    split_col: str = "split",
) -> DataFrame:
    """Tag each row ``train`` or ``test``; class sizes are exact, rows are chosen by hash."""
    require_columns(df, [label, *keys])
    cuts = class_hash_cuts(
        df, label, keys, seed, lambda n: {c: [m] for c, m in test_rows_by_class(n, test_size).items()}
    )
    hashed = row_hash(keys, seed)
    side = _by_class(label, cuts, lambda h: F.when(hashed <= F.lit(h[0]), TEST).otherwise(TRAIN))
    return df.withColumn(split_col, side)


def stratified_folds(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    k: int,
    seed: int = fixed.SEED,
    fold_col: str = "fold",
) -> DataFrame:
    """Number rows 0..k-1 with every class spread evenly over the folds."""
    require_columns(df, [label, *keys])

    def ranks(counts: dict[Any, int]) -> dict[Any, list[int]]:
        return {
            c: [sum(sizes[: f + 1]) for f in range(k - 1)]
            for c, sizes in fold_rows_by_class(counts, k).items()
        }

    cuts = class_hash_cuts(df, label, keys, seed, ranks)
    hashed = row_hash(keys, seed)
    fold = _by_class(
        label, cuts, lambda hs: sum(((hashed > F.lit(h)).cast("int") for h in hs), F.lit(0))
    )
    return df.withColumn(fold_col, fold)
