"""Exact quantiles of many columns without a value map of the whole column.

Linear interpolation between the two neighbouring order statistics. A mergeable sketch of every
column, all from one scan, brackets each order statistic; a count shows how many values lie below
and inside the bracket, and the bracket is narrowed until the distinct values inside are few enough
to read. Every step is one scan with partial aggregation for all columns together, and no step
keeps more than ``limit`` values anywhere, however many there are and however they are distributed.

Sketches can be stored and merged over parts of a table (``quantile_sketches``,
``merged_sketches``); given to ``quantiles``, they save the first scan.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import groupby
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagline.functions.columns import nan_to_null, quoted, rows_per_column

SKETCH_SIZE = 4_096  # items of a sketch's levels: ranks within about 0.13 percent
STEPS = 1_000  # shares that brackets are taken from
READ_LIMIT = 10_000
MAX_CUTS = 45


@dataclass
class _Bracket:
    """Search state for the order statistic of 0-based ``rank`` in ``column``.

    The open interval (low, high) holds ``inside`` values and ``below`` values precede it;
    ``None`` leaves a side unbounded. Excluding the ends keeps hot values out of it.
    """

    column: str
    rank: int
    inside: int
    below: int = 0
    low: float | None = None
    high: float | None = None
    margin: int = 2  # in steps of the sketch
    value: float | None = None

    def span(self) -> tuple:
        return self.column, self.low, self.high

    def ends(self) -> tuple[float, float]:
        """Shares of the interval's values between which the rank must lie."""
        return _around((self.rank - self.below + 0.5) / self.inside, self.margin)


def _around(share: float, margin: int) -> tuple[float, float]:
    place = share * STEPS
    low = max(0, math.floor(place) - margin)
    high = min(STEPS, math.ceil(place) + margin)
    return low / STEPS, high / STEPS


def _inside(column: str, low: float | None, high: float | None) -> Column:
    c = quoted(column)
    inside = c.isNotNull()
    if low is not None:
        inside = inside & (c > F.lit(low))
    if high is not None:
        inside = inside & (c < F.lit(high))
    return inside


def quantile_sketches(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n, sketch): values and a quantile sketch of every column, from one scan."""
    data = nan_to_null(df.select(*[quoted(c).cast("double").alias(c) for c in columns]))
    made = [e for i, c in enumerate(columns) for e in (F.count(quoted(c)).alias(f"n_{i}"), F.kll_sketch_agg_double(quoted(c), SKETCH_SIZE).alias(f"s_{i}"))]
    return rows_per_column(data.agg(*made), {c: {"n": F.col(f"n_{i}"), "sketch": F.col(f"s_{i}")} for i, c in enumerate(columns)})


def merged_sketches(*parts: DataFrame) -> DataFrame:
    """The sketches of the rows of all parts together."""
    return reduce(DataFrame.unionAll, parts).groupBy("column").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    exact: bool = True,
    limit: int = READ_LIMIT,
    sketches: DataFrame | None = None,
) -> dict[str, list[float | None]]:
    """Quantiles per column; ``None`` where a column has no value.

    ``exact=False`` returns the sketch values of a single scan. ``sketches`` are those of the same
    rows, where they are kept already.
    """
    if not columns:
        return {}
    columns, probabilities = list(columns), list(probabilities)
    data = nan_to_null(df.select(*[quoted(c).cast("double").alias(c) for c in columns]))
    ends = [_around(p, _Bracket.margin) for p in probabilities]
    shares = sorted({share for pair in ends for share in pair}) if exact else probabilities
    found = sketches if sketches is not None else quantile_sketches(data, columns)
    values = F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(shares)))
    rows = {r["column"]: r for r in found.select("column", "n", values.alias("v")).collect()}  # a row per column
    if not exact:
        return {c: list(rows[c]["v"] or [None] * len(probabilities)) for c in columns}

    counts = {c: rows[c]["n"] for c in columns}
    some = [c for c in columns if counts[c]]
    places = {(c, k): _position(counts[c], p) for c in some for k, p in enumerate(probabilities)}
    brackets, bounds = {}, {}
    for (c, k), (low, high, _) in places.items():
        sketched = dict(zip(shares, rows[c]["v"]))
        for rank in (low, high):
            brackets[c, rank] = _Bracket(c, rank, counts[c])
            bounds[c, rank] = tuple(sketched[share] for share in ends[k])
    if brackets:
        _settle(data, list(brackets.values()), list(bounds.values()))
        _search(data, list(brackets.values()), limit)
    result: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}
    for (c, k), (low, high, weight) in places.items():
        a, b = brackets[c, low].value, brackets[c, high].value
        result[c][k] = a + (b - a) * weight
    return result


def _position(n: int, probability: float) -> tuple[int, int, float]:
    place = (n - 1) * probability
    low = math.floor(place)
    return low, min(low + 1, n - 1), place - low


def _search(data: DataFrame, brackets: list[_Bracket], limit: int) -> None:
    """Narrow until every bracket is settled or few enough values are left to read."""
    while pending := [b for b in brackets if b.value is None and b.inside > limit]:
        _narrow(data, pending)
    if leaves := [b for b in brackets if b.value is None]:
        _read(data, leaves)


def _narrow(data: DataFrame, pending: list[_Bracket]) -> None:
    """Shrink every pending bracket to about 1/400 of its rows: two scans for all.

    One sketch per distinct interval proposes the ends.
    """
    shares: dict[tuple, list[float]] = {}
    for b in pending:
        shares[b.span()] = sorted({*shares.get(b.span(), []), *b.ends()})
    sketches = [
        F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(F.when(_inside(*span), quoted(span[0])), SKETCH_SIZE), F.lit(wanted))
        for span, wanted in shares.items()
    ]
    row = data.agg(*sketches).first()
    values = {span: dict(zip(wanted, found)) for (span, wanted), found in zip(shares.items(), row)}
    _settle(data, pending, [tuple(values[b.span()][s] for s in b.ends()) for b in pending])


def _by_column(cuts: list[tuple[str, float]], most: int) -> list[list[tuple[str, float]]]:
    """Cuts in runs of about ``most`` that keep each column in one run.

    Wider aggregates lose code generation; each run reads its own columns only.
    """
    runs: list[list[tuple[str, float]]] = []
    for _, group in groupby(cuts, key=lambda cut: cut[0]):
        found = list(group)
        if runs and len(runs[-1]) + len(found) <= most:
            runs[-1] += found
        else:
            runs.append(found)
    return runs


def _settle(data: DataFrame, brackets: list[_Bracket], bounds: list[tuple[float, float]]) -> None:
    """Count the proposed ends exactly and move the brackets between them.

    A rank on an end is settled at once; the rest lies strictly between the ends.
    """
    cuts = sorted({(b.column, v) for b, pair in zip(brackets, bounds) for v in pair})
    counted = {}
    for part in _by_column(cuts, MAX_CUTS):
        checks = [e for c, v in part for e in (F.count_if(quoted(c) < F.lit(v)), F.count_if(quoted(c) <= F.lit(v)))]
        seen = data.agg(*checks).first()
        counted |= {cut: (seen[2 * i], seen[2 * i + 1]) for i, cut in enumerate(part)}
    for b, (low, high) in zip(brackets, bounds):
        under_low, to_low = counted[b.column, low]
        under_high, to_high = counted[b.column, high]
        if not under_low <= b.rank < to_high:  # outside the sketch's guarantee: look wider
            b.margin *= 4
        elif b.rank < to_low:
            b.value = low
        elif b.rank >= under_high:
            b.value = high
        else:
            b.low, b.high, b.below, b.inside = low, high, to_low, under_high - to_low


def _read(data: DataFrame, leaves: list[_Bracket]) -> None:
    """Read the distinct values of intervals already known to hold few rows."""
    spans = list(dict.fromkeys(b.span() for b in leaves))
    hits = F.array(
        *[
            F.when(_inside(*span), F.struct(F.lit(i).alias("id"), quoted(span[0]).alias("value")))
            for i, span in enumerate(spans)
        ]
    )
    rows = (
        data.where(reduce(or_, [_inside(*span) for span in spans]))
        .select(F.explode(F.filter(hits, lambda h: h.isNotNull())).alias("hit"))
        .groupBy("hit.id", "hit.value")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()  # at most READ_LIMIT values per interval
    )
    found: dict[tuple, list[tuple[float, int]]] = {span: [] for span in spans}
    for r in rows:
        found[spans[r["id"]]].append((r["value"], r["n"]))
    for b in leaves:
        seen = b.below
        for value, n in sorted(found[b.span()]):
            seen += n
            if b.rank < seen:
                b.value = value
                break
