"""The most frequent values of columns with any number of values, exact.

Each task keeps a summary of at most ``COUNTERS`` counts a column: when there are more, the largest
count that has to go is taken off all of them. What was taken off bounds how much any count of the
task is too small, so sums over the tasks bound every value's count from below and above. Values
whose upper bound reaches the k-th best lower bound are counted exactly in a second scan. Only
summaries are shuffled: tasks times counters rows, however many values a column has.

Where nothing had to go the summaries are the counts already. Where the bounds prove nothing (no
value is frequent enough), all values of the column are counted.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lagline.functions.columns import long_form, quoted, value_counts
from lagline.session import stage_table

COUNTERS = 4_096


def _reduced(counts: dict, most: int) -> tuple[dict, int]:
    """At most ``most`` counts, and what was taken off each."""
    if len(counts) <= most:
        return counts, 0
    cut = sorted(counts.values(), reverse=True)[most]
    return {v: n - cut for v, n in counts.items() if n > cut}, cut


def _summaries(batches: Iterator[pa.RecordBatch], names: Sequence[str], counters: int) -> Iterator[pa.RecordBatch]:
    counts: dict[str, dict] = {}
    taken: dict[str, int] = {}
    for batch in batches:
        for name, values in zip(names, batch.columns):
            own = counts.setdefault(name, {})
            found = pc.value_counts(values)
            for value, n in zip(found.field("values").to_pylist(), found.field("counts").to_pylist()):
                own[value] = own.get(value, 0) + n
            counts[name], cut = _reduced(own, counters)
            taken[name] = taken.get(name, 0) + cut
    for name, own in counts.items():
        rows = [*[(name, v, n, False) for v, n in own.items()], (name, None, taken[name], True)]
        kinds = (pa.string(), pa.string(), pa.int64(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["column", "value", "n", "taken"])


def most_frequent(df: DataFrame, columns: Sequence[str], k: int, nulls: bool = True, counters: int = COUNTERS) -> DataFrame:
    """(column, value, n, rank): the k most frequent values of each column, ties by smaller value.

    NULL counts as a value unless ``nulls`` is false; among ties it comes last.
    """
    wide, names = df.select(*[quoted(c).cast("string").alias(f"c{i}") for i, c in enumerate(columns)]), list(columns)
    schema = "column string, value string, n long, taken boolean"
    counters = max(counters, k)
    summary = stage_table(wide.mapInArrow(lambda b: _summaries(b, names, counters), schema), "value-summaries")
    sums = summary.where("NOT taken").groupBy("column", "value").agg(F.sum("n").alias("n"))
    if not nulls:
        sums = sums.where("value IS NOT NULL")
    lost = {r["column"]: r["lost"] for r in summary.where("taken").groupBy("column").agg(F.sum("n").alias("lost")).collect()}
    counted = sums.where(F.col("column").isin([c for c, n in lost.items() if not n]))
    unsure = [c for c, n in lost.items() if n]
    if unsure:
        by_bound = W.partitionBy("column").orderBy(F.desc("n"))
        least = sums.where(F.col("column").isin(unsure)).withColumn("rank", F.row_number().over(by_bound)).where(F.col("rank") == k)
        least = {r["column"]: r["n"] for r in least.collect()}  # a row per column
        proven = [c for c in unsure if least.get(c, 0) > lost[c]]
        if proven:
            bar = F.create_map(*[F.lit(x) for c in proven for x in (c, least[c] - lost[c])])
            near = sums.where(F.col("column").isin(proven)).where(F.col("n") >= bar[F.col("column")])
            near = stage_table(near.select("column", "value"), "value-candidates")  # its size is known to the join
            rows = long_form(df, proven, "string").withColumnsRenamed({"column": "c", "value": "v"})
            same = (F.col("c") == F.col("column")) & F.col("v").eqNullSafe(F.col("value"))
            exact = rows.join(near, same).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
            counted = counted.unionByName(exact)
        open_ = [c for c in unsure if c not in proven]
        if open_:
            every = value_counts(df, open_)
            counted = counted.unionByName(every if nulls else every.where("value IS NOT NULL"))
    order = W.partitionBy("column").orderBy(F.desc("n"), F.asc_nulls_last("value"))
    return counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
