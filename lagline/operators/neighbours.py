"""Exact k-nearest-neighbour join and classification on a grid of blocks.

Copies collapse on both sides first: a query point is answered once, and a training point carries
the k smallest keys of its rows, since no other of them can be chosen. Training points are then
dealt to P rows and query points to Q columns of a grid; every training point is sent to the Q
blocks of its row and every query point to the P blocks of its column, so each pair meets in one
block and nowhere else, and a task has one block. A block compares its points with numpy, first in
single precision with a bound on its error, then whoever may qualify in double, and keeps the k best
rows of each query; the at most k * P rows left of a query are merged by one sort of a short array.

P and Q follow from the two counts: both sides of a block have about the same number of points, at
most ``block_rows``, so the rows shuffled are about twice the square root of the number of blocks
times those of the two sides (their geometric mean), and no task holds more than a block. Nothing
is dropped without proof, so the result equals comparing everything. Only counts reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from lagline.functions.columns import quoted
from lagline.session import stage_table

BLOCK_ROWS = 16384
CELLS = 1 << 19  # distances that a block holds at once
TILE = 1 << 11  # training points whose distances are added up in the processor's cache
SINGLE = 1e30  # values beyond this are compared in double precision only
METRICS = ("euclidean", "manhattan")


def as_array(df: DataFrame, features: str) -> Column:
    """The feature column as array<double>, from a vector or an array."""
    if isinstance(df.schema[features].dataType, VectorUDT):
        return vector_to_array(quoted(features))
    return quoted(features).cast("array<double>")


def distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """All distances between the rows of two blocks, from plain differences."""
    total = np.zeros((len(a), len(b)))
    for d in range(a.shape[1]):
        gap = a[:, d, None] - b[None, :, d]
        total += gap * gap if metric == "euclidean" else np.abs(gap)
    return np.sqrt(total) if metric == "euclidean" else total


def nearest_neighbours(
    train: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str = "euclidean",
    key: str = "row_id",
    features: str = "features",
    label: str = "label",
    leave_out: str | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The k nearest training rows of every query: (query, rank, distance, neighbour, label).

    Ties go to the smaller neighbour key. With ``leave_out`` (a column of both sides) a
    query skips training rows of its own group: one join serves all folds. Keys identify
    rows on either side.
    """
    points, members = distinct_points(queries, key, features, leave_out)
    found = nearest_of_points(
        train, points, k, metric, key, features, label, leave_out, block_rows
    )
    return members.join(found.withColumnRenamed("query", "point"), "point").drop("point")


def distinct_points(
    queries: DataFrame, key: str, features: str, leave_out: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Queries without repeats, and the (query, point) table leading to them.

    Copies of a query share one answer. They collapse before the shuffle; a point is
    known by the smallest key among its copies.
    """
    group = quoted(leave_out).cast("int") if leave_out else F.lit(0)
    x = as_array(queries, features)
    q = queries.select(quoted(key).alias("query"), F.xxhash64(x).alias("h"), x.alias("x"), group.alias("grp"))
    points = q.groupBy("h", "x", "grp").agg(F.min("query").alias("point"))
    members = q.join(points, ["h", "x", "grp"]).select("query", "point")
    return points.select(F.col("point").alias("query"), "x", "grp"), members


def training_points(
    train: DataFrame, k: int, key: str, features: str, label: str, leave_out: str | None = None
) -> DataFrame:
    """Training rows without repeats: ``x, grp, rows``, the k smallest keys of each with their labels."""
    group = quoted(leave_out).cast("int") if leave_out else F.lit(0)
    x = as_array(train, features)
    t = train.select(
        F.xxhash64(x).alias("h"), x.alias("x"), group.alias("grp"),
        quoted(key).alias("neighbour"), quoted(label).cast("int").alias("label"),
    )
    copies = W.partitionBy("h", "x", "grp").orderBy("neighbour")
    chosen = t.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k)
    rows = F.sort_array(F.collect_list(F.struct("neighbour", "label"))).alias("rows")  # at most k
    return chosen.groupBy("h", "x", "grp").agg(rows)


def grid(n_train: int, n_queries: int, block_rows: int, least: int) -> tuple[int, int]:
    """Rows and columns of the grid: no side of a block is longer than ``block_rows``.

    While there are fewer than ``least`` blocks, the longer side is halved, down to 256 points.
    """
    p, q = max(1, math.ceil(n_train / block_rows)), max(1, math.ceil(n_queries / block_rows))
    while p * q < least and max(n_train / p, n_queries / q) > 256:
        if n_train / p >= n_queries / q:
            p *= 2
        else:
            q *= 2
    return p, q


def nearest_of_points(
    train: DataFrame,
    points: DataFrame,
    k: int,
    metric: str,
    key: str,
    features: str,
    label: str,
    leave_out: str | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``nearest_neighbours`` of the points given by ``distinct_points``."""
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    t = stage_table(training_points(train, k, key, features, label, leave_out), "knn-train")
    points = stage_table(points, "knn-queries")
    n_train, n_queries = t.count(), points.count()
    if n_train == 0:
        raise ValueError("no training rows")
    p, q = grid(n_train, n_queries, block_rows, 4 * t.sparkSession.sparkContext.defaultParallelism)
    left = t.select("x", "grp", "rows", F.pmod(F.xxhash64("h", "grp"), F.lit(p)).alias("p"), _copies(q).alias("q"))
    right = points.select("query", "x", "grp", _copies(p).alias("p"), F.pmod(F.xxhash64("query"), F.lit(q)).alias("q"))
    none = [F.lit(None).cast(side.schema[c].dataType).alias(c) for side, c in ((points, "query"), (t, "rows"))]
    block = (F.col("p") * q + F.col("q")).cast("int").alias("block")
    both = left.select(block, "x", "grp", "rows", none[0]).unionAll(right.select(block, "x", "grp", none[1], "query"))
    row = t.schema["rows"].dataType.elementType
    near = T.StructType([T.StructField("distance", T.DoubleType()), *row.fields])
    result = T.StructType([points.schema["query"], T.StructField("near", T.ArrayType(near))])
    kernel = _block_kernel(k, metric, bool(leave_out), to_arrow_schema(result))
    # Blocks are dealt by their numbers: hashes would put several into one task, and adaptive execution merge small ones.
    best = both.repartitionById(p * q, "block").mapInArrow(_each_block(kernel), result)
    merged = best.groupBy("query").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near"))
    ranked = merged.select("query", F.posexplode("near").alias("place", "row"))
    return ranked.select("query", "row.distance", "row.neighbour", "row.label", (F.col("place") + 1).alias("rank"))


def _copies(n: int) -> Column:
    """One row for each of ``n`` blocks."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.combine_chunks()
    return rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)


def _each_block(kernel):
    """The kernel on the one block of a partition: training points have rows, query points have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            table = pa.Table.from_batches(held)
            trained = pc.is_valid(table["rows"])
            yield from kernel(table.filter(trained), table.filter(pc.invert(trained))).to_batches(max_chunksize=10_000)

    return run


def _block_kernel(k: int, metric: str, leave_out: bool, result: pa.Schema):
    def compare(t: pa.Table, q: pa.Table) -> pa.Table:
        """``query, near`` of one block: the k best training rows of every query point."""
        if not t.num_rows or not q.num_rows:
            return result.empty_table()
        rows = t["rows"].combine_chunks()
        sizes = rows.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        firsts = np.cumsum(sizes) - sizes
        keys, labels = rows.flatten().field("neighbour"), rows.flatten().field("label")
        place = np.empty(len(keys), np.int64)  # of every key among all of the block
        place[pc.sort_indices(keys).to_numpy()] = np.arange(len(keys))
        order = np.argsort(place[firsts])  # equally distant points stand by their smallest keys
        b, grp = _matrix(t["x"])[order], t["grp"].to_numpy()[order]
        sizes, firsts = sizes[order], firsts[order]
        a, own = _matrix(q["x"]), q["grp"].to_numpy()
        found = []
        step = max(1, CELLS // len(b))
        for start in range(0, len(a), step):
            part = slice(start, min(start + step, len(a)))
            skip = own[part, None] == grp[None, :] if leave_out else None
            i, j, d = _closest(a[part], b, k, metric, skip)
            n = sizes[j]
            at = np.repeat(firsts[j] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            i, d = np.repeat(i, n), np.repeat(d, n)
            by = np.lexsort((place[at], d, i))
            i, d, at = i[by], d[by], at[by]
            few = np.arange(len(i)) - np.searchsorted(i, i) < k
            found.append((i[few] + start, d[few], at[few]))
        i, d, at = (np.concatenate(v) for v in zip(*found))
        offsets = np.searchsorted(i, np.arange(len(a) + 1)).astype(np.int32)
        near = pa.StructArray.from_arrays([pa.array(d), keys.take(pa.array(at)), labels.take(pa.array(at))], ["distance", "neighbour", "label"])
        return pa.table({"query": q["query"], "near": pa.ListArray.from_arrays(pa.array(offsets), near)})

    return compare


def _rough_manhattan(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray | float]:
    """Manhattan distances in single precision, and what each row's may be off by at most."""
    if not ((np.abs(a) <= SINGLE).all() and (np.abs(b) <= SINGLE).all()):
        return distances(a, b, "manhattan"), 0.0
    x, y = a.astype(np.float32), np.ascontiguousarray(b.T, np.float32)
    total = np.zeros((len(a), len(b)), np.float32)
    for start in range(0, len(b), TILE):
        part = slice(start, start + TILE)
        some = np.zeros((len(a), y[:, part].shape[1]), np.float32)
        gap = np.empty_like(some)
        for d in range(a.shape[1]):
            np.subtract(x[:, d, None], y[d, None, part], out=gap)
            np.abs(gap, out=gap)
            np.add(some, gap, out=some)
        total[:, part] = some
    # A rounding of either value, of their difference and of each sum, all at most the sums of both.
    single, roundings = np.finfo(np.float32), a.shape[1] + 4
    size = np.abs(a).sum(axis=1)[:, None] + np.abs(b).sum(axis=1).max()
    return total, roundings * (single.eps * size + single.smallest_subnormal)


def _closest(a: np.ndarray, b: np.ndarray, k: int, metric: str, skip: np.ndarray | None):
    """The k best pairs (row, column, distance) per row of ``a``; ties by column order."""
    if metric == "euclidean":
        # matrix product for a first look, plain differences for whoever may qualify
        squares_a, squares_b = (a * a).sum(axis=1), (b * b).sum(axis=1)
        rough = squares_a[:, None] + squares_b[None, :] - 2 * (a @ b.T)
        error = 1e-12 * (squares_a[:, None] + squares_b.max()) * a.shape[1]
    else:
        rough, error = _rough_manhattan(a, b)
    if skip is not None:
        rough = np.where(skip, np.inf, rough)
    if k < b.shape[0]:
        kth = np.partition(rough, k - 1, axis=1)[:, k - 1 : k]
    else:
        kth = np.full((len(a), 1), np.inf)
    i, j = np.nonzero((rough <= kth + 2 * error) & np.isfinite(rough))
    total = np.zeros(len(i))
    for dim in range(a.shape[1]):  # in the order of the features, as a plain sum has it
        gap = a[i, dim] - b[j, dim]
        total += gap * gap if metric == "euclidean" else np.abs(gap)
    d = np.sqrt(total) if metric == "euclidean" else total
    order = np.lexsort((j, d, i))
    i, j, d = i[order], j[order], d[order]
    starts = np.searchsorted(i, np.arange(len(a)))
    keep = np.arange(len(i)) - starts[i] < k
    return i[keep], j[keep], d[keep]


# --- voting -------------------------------------------------------------------


def vote(neighbours: DataFrame, weights: str = "uniform") -> DataFrame:
    """(query, prediction, probability) from neighbours; probability is that of class 1.

    ``distance`` weighs by inverse distance; a neighbour at distance 0 outvotes all
    others. The class with most weight wins, the smaller one on ties; shares that differ
    beyond the twelfth digit only are tied, so the order of adding doesn't decide.
    """
    zero = F.min("distance").over(W.partitionBy("query")) == 0
    if weights == "uniform":
        weight = F.lit(1.0)
    else:
        weight = F.when(zero, (F.col("distance") == 0).cast("double")).otherwise(
            F.try_divide(F.lit(1.0), F.col("distance"))
        )
    votes = neighbours.select("query", "label", weight.alias("weight"))
    by_class = votes.groupBy("query", "label").agg(F.sum("weight").alias("weight"))
    shares = by_class.groupBy("query").agg(
        F.collect_list(F.struct("weight", "label")).alias("classes"), F.sum("weight").alias("total")
    )
    classes = F.transform("classes", lambda c: F.struct(F.round(c["weight"] / F.col("total"), 12).alias("share"), (-c["label"]).alias("minus")))
    positive = F.aggregate("classes", F.lit(0.0), lambda s, c: s + F.when(c["label"] == 1, c["weight"]).otherwise(0.0))
    return shares.select(
        "query", (-F.array_max(classes)["minus"]).alias("prediction"), (positive / F.col("total")).alias("probability")
    )


def vote_all(neighbours: DataFrame, ks: Sequence[int]) -> DataFrame:
    """(query, n_neighbors, weights, probability) for every k and both votings at once.

    Binary labels. Sums per query run where the rank left its rows, without a shuffle.
    """
    sums, rows = [], []
    positive, zero = F.col("label") == 1, F.col("distance") == 0
    inverse = F.when(~zero, F.try_divide(F.lit(1.0), F.col("distance"))).otherwise(0.0)
    for k in ks:
        within = F.col("rank") <= k
        sums += [
            F.count_if(within).alias(f"n_{k}"),
            F.count_if(within & positive).alias(f"pos_{k}"),
            F.count_if(within & zero).alias(f"zero_{k}"),
            F.count_if(within & zero & positive).alias(f"zero_pos_{k}"),
            F.sum(F.when(within, inverse)).alias(f"w_{k}"),
            F.sum(F.when(within & positive, inverse)).alias(f"w_pos_{k}"),
        ]
        by_distance = F.when(
            F.col(f"zero_{k}") > 0, F.try_divide(F.col(f"zero_pos_{k}").cast("double"), F.col(f"zero_{k}"))
        ).otherwise(F.try_divide(F.coalesce(F.col(f"w_pos_{k}"), F.lit(0.0)), F.col(f"w_{k}")))
        for name, p in (
            ("uniform", F.try_divide(F.col(f"pos_{k}").cast("double"), F.col(f"n_{k}"))),
            ("distance", by_distance),
        ):
            rows.append(
                F.struct(F.lit(k).alias("n_neighbors"), F.lit(name).alias("weights"), p.alias("probability"))
            )
    return neighbours.groupBy("query").agg(*sums).select("query", F.inline(F.array(*rows)))


@dataclass
class KnnClassifier:
    """A k-nearest-neighbour model: its training rows and its parameters."""

    train: DataFrame
    n_neighbors: int = 5
    weights: str = "uniform"
    metric: str = "euclidean"
    key: str = "row_id"
    features: str = "features"
    label: str = "label"

    def params(self) -> dict:
        return {"metric": self.metric, "n_neighbors": self.n_neighbors, "weights": self.weights}

    def transform(self, queries: DataFrame) -> DataFrame:
        """(key, prediction, probability) for every query row."""
        points, members = distinct_points(queries, self.key, self.features)
        found = nearest_of_points(
            self.train, points, self.n_neighbors, self.metric, self.key, self.features, self.label
        )
        votes = vote(found, self.weights).withColumnRenamed("query", "point")
        return members.join(votes, "point").drop("point").withColumnRenamed("query", self.key)

    def save(self, path: str) -> None:
        rows = self.train.select(quoted(self.key), quoted(self.features), quoted(self.label))
        rows.write.mode("overwrite").parquet(f"{path}/rows")
        columns = {"key": self.key, "features": self.features, "label": self.label}
        settings = [{**self.params(), **columns}]
        self.train.sparkSession.createDataFrame(settings).write.mode("overwrite").json(f"{path}/settings")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "KnnClassifier":
        s = spark.read.json(f"{path}/settings").first()
        return KnnClassifier(
            spark.read.parquet(f"{path}/rows"), int(s["n_neighbors"]), s["weights"], s["metric"],
            s["key"], s["features"], s["label"],
        )
