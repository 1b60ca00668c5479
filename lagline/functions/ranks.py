"""Distributed ranks: hash cut points per class, and running totals by score.

Neither sorts a class or a model in one task. Cut points come from histograms of a hash
prefix; running totals from range partitions whose totals are added up on their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lagline.functions.columns import quoted, quoted_name
from lagline.session import stage_table

PREFIX_STEP = 3  # hex digits per histogram: 4096 cells
LEAF_ROWS = 1_000
HASH_DIGITS = 32
BEFORE_ALL = ""
AFTER_ALL = "g"  # sorts after every hex digit
PART = "_part"


def row_hash(keys: Sequence[str], seed: int) -> Column:
    """md5 of the key columns and the seed, joined by ``|``: a stable random order.

    Bars and backslashes inside values are escaped, so different keys never join to the same text.
    """
    parts = [F.replace(F.replace(quoted(k).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")) for k in keys]
    return F.md5(F.concat_ws("|", *[F.coalesce(p, F.lit("\\N")) for p in parts], F.lit(str(seed))))


@dataclass
class _Cut:
    label: Any
    rank: int  # rows of the class at or before the cut
    prefix: str = ""
    before: int = 0  # rows of the class before the prefix
    rows: int = 0  # rows of the class within the prefix
    hash: str | None = None


def class_hash_cuts(
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    seed: int,
    plan: Callable[[dict[Any, int]], dict[Any, list[int]]],
) -> dict[Any, list[str]]:
    """Hash values that cut each class after the ranks chosen by ``plan``.

    ``plan`` gets the class counts and returns, per class, how many rows lie at or before
    each cut in hash order. Rows never move: each step counts hash prefixes per class
    (at most 4096 cells per class reach the driver) and narrows to the prefix holding the
    cut, until at most ``LEAF_ROWS`` hashes are left to read. Rows with equal keys stay
    together: a cut that falls among copies lies after the last of them. Rows without a
    label raise a ``ValueError``.
    """
    hashed = df.select(quoted(label).alias("label"), row_hash(keys, seed).alias("hash"))
    cells = _histogram(hashed, 0)
    counts: dict[Any, int] = {}
    for (value, _), n in cells.items():
        counts[value] = counts.get(value, 0) + n
    if None in counts:
        raise ValueError(f"{counts[None]} rows have no {label}: drop or label them first")
    cuts = []
    for value, ranks in plan(counts).items():
        for rank in ranks:
            cut = _Cut(value, rank, rows=counts[value])
            if rank <= 0:
                cut.hash = BEFORE_ALL
            elif rank >= counts[value]:
                cut.hash = AFTER_ALL
            cuts.append(cut)
    _descend([c for c in cuts if c.hash is None], cells)
    while large := [c for c in cuts if c.hash is None and c.rows > LEAF_ROWS]:
        digits = len(large[0].prefix)
        step = [c for c in large if len(c.prefix) == digits]
        if digits >= HASH_DIGITS:  # copies of one key only
            for cut in step:
                cut.hash = cut.prefix
            continue
        _descend(step, _histogram(hashed.where(_within(step)), digits))
    if leaves := [c for c in cuts if c.hash is None]:
        _read_leaves(hashed, leaves)
    result: dict[Any, list[str]] = {}
    for c in cuts:
        result.setdefault(c.label, []).append(c.hash)
    return result


def _within(cuts: list[_Cut]) -> Column:
    condition = F.lit(False)
    for value, prefix in {(c.label, c.prefix) for c in cuts}:
        condition = condition | ((F.col("label") == F.lit(value)) & F.col("hash").startswith(prefix))
    return condition


def _histogram(hashed: DataFrame, digits: int) -> dict[tuple[Any, str], int]:
    prefix = F.substring("hash", 1, digits + PREFIX_STEP).alias("prefix")
    rows = hashed.groupBy("label", prefix).agg(F.count(F.lit(1)).alias("n")).collect()
    return {(r["label"], r["prefix"]): r["n"] for r in rows}


def _descend(cuts: list[_Cut], cells: dict[tuple[Any, str], int]) -> None:
    ordered = sorted(cells.items(), key=lambda cell: cell[0][1])
    for cut in cuts:
        seen, parent = cut.before, cut.prefix
        for (value, prefix), n in ordered:
            if value != cut.label or not prefix.startswith(parent):
                continue
            if cut.rank <= seen + n:
                cut.prefix, cut.before, cut.rows = prefix, seen, n
                break
            seen += n


def _read_leaves(hashed: DataFrame, leaves: list[_Cut]) -> None:
    rows = hashed.where(_within(leaves)).collect()  # at most LEAF_ROWS per cut
    for cut in leaves:
        hashes = sorted(r["hash"] for r in rows if r["label"] == cut.label and r["hash"].startswith(cut.prefix))
        cut.hash = hashes[cut.rank - cut.before - 1]


def _cumulated(batches: Iterator[pa.RecordBatch], group: str, sums: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition with its number and running totals of each group inside it."""
    part, last, carried = TaskContext.get().partitionId(), None, {}
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        groups = batch.column(group).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.append(True, groups[1:] != groups[:-1]))
        lengths = np.diff(np.append(starts, n))
        added = []
        for s in sums:
            total = np.cumsum(batch.column(s).to_numpy(zero_copy_only=False))
            running = total - np.repeat(np.append(0, total)[starts], lengths)
            if carried and groups[0] == last:
                running[: lengths[0]] += carried[s]
            added.append(running)
        last, carried = groups[-1], {s: a[-1] for s, a in zip(sums, added)}
        columns = [*batch.columns, pa.array(np.full(n, part, np.int32)), *map(pa.array, added)]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, PART, *[f"_run_{s}" for s in sums]])


def running_totals(
    df: DataFrame, group: str, order: str, sums: Sequence[str], ascending: bool = False
) -> DataFrame:
    """Add running totals ``cum_<sum>`` within ``group`` by ``order``, and ``total_<sum>``.

    ``df`` holds one row per (group, order). Rows are dealt to range partitions of (group, order),
    as many as the session's shuffles have, fewer where adaptive execution finds them small. Each
    adds up its own rows and is written once; what stands before a partition in its groups is the
    running sum over one row for each partition and group.
    """
    along = [F.col(group).asc(), F.col(order).asc() if ascending else F.col(order).desc()]
    kinds = [f"{quoted_name(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields]
    kinds += [f"{PART} int", *[f"{quoted_name(f'_run_{s}')} {df.schema[s].dataType.simpleString()}" for s in sums]]
    names = list(sums)
    ranged = df.repartitionByRange(*along).sortWithinPartitions(*along)
    ranged = stage_table(ranged.mapInArrow(lambda b: _cumulated(b, group, names), ", ".join(kinds)), "running-totals")
    earlier = W.partitionBy(group).orderBy(PART).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(group)  # over a row per partition
    ends = ranged.groupBy(group, PART).agg(*[F.sum(s).alias(f"_sum_{s}") for s in sums])
    ends = ends.select(
        group,
        PART,
        *[F.coalesce(F.sum(f"_sum_{s}").over(earlier), F.lit(0)).alias(f"_before_{s}") for s in sums],
        *[F.sum(f"_sum_{s}").over(whole).alias(f"total_{s}") for s in sums],
    )
    return ranged.join(ends, [group, PART]).select(
        *df.columns,
        *[(F.col(f"_run_{s}") + F.col(f"_before_{s}")).alias(f"cum_{s}") for s in sums],
        *[f"total_{s}" for s in sums],
    )
