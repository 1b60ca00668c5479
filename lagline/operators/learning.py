"""Classifiers: class weights, grids, cross-validation, scoring.

Folds come from an exact stratified fold column; the search score is the F1 of class 1.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark.ml import Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagline import fixed_values as fixed
from lagline.functions.columns import quoted
from lagline.operators.boosting import NO_FOLD, BoostedTrees, Fit, grow
from lagline.operators.neighbours import (
    KnnClassifier,
    distinct_points,
    nearest_of_points,
    vote_all,
)
from lagline.operators.splitting import stratified_folds
from lagline.session import stage_table

WEIGHT, FOLD = "class_weight", "fold"


@dataclass
class Search:
    """Outcome of a grid search."""

    best_params: dict[str, Any]
    best_score: float
    scores: list[tuple[dict[str, Any], float]] = field(default_factory=list)
    model: Any = None


def grid_points(grid: dict[str, Sequence]) -> list[dict[str, Any]]:
    """All combinations, names in sorted order, the last name varying fastest."""
    names = sorted(grid)
    return [dict(zip(names, values)) for values in product(*(grid[n] for n in names))]


def _best(scores: list[tuple[dict[str, Any], float]]) -> tuple[dict[str, Any], float]:
    return max(scores, key=lambda s: s[1])  # the first point on ties


# --- class weights ------------------------------------------------------------


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight): n_rows / (n_classes * n), so every class weighs the same."""
    counts = df.groupBy(quoted(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))
    share = totals.select(F.col("rows") / F.col("classes")).scalar()
    return counts.withColumn("weight", share / F.col("n"))


def add_class_weight(df: DataFrame, label: str, column: str = WEIGHT) -> DataFrame:
    """Weight of the row's class, as literals: one number per class reaches the driver."""
    weight = F.lit(None).cast("double")
    for r in class_weights(df, label).collect():
        weight = F.when(quoted(label) == F.lit(r["label"]), F.lit(r["weight"])).otherwise(weight)
    return df.withColumn(column, weight)


# --- estimators ---------------------------------------------------------------


def logistic(
    params: dict[str, Any], n_rows: int, features: str, label: str, weight: str | None = WEIGHT
) -> LogisticRegression:
    """Logistic regression with an L1 or L2 penalty of inverse strength ``C``.

    ``C`` weighs the summed loss, Spark's ``regParam`` the penalty against the mean loss.
    """
    model = LogisticRegression(
        featuresCol=features,
        labelCol=label,
        regParam=1.0 / (params["C"] * n_rows),
        elasticNetParam=1.0 if params["penalty"] == "l1" else 0.0,
        maxIter=int(params.get("max_iter", 200)),
        standardization=False,
        tol=1e-6,
    )
    return model.setWeightCol(weight) if weight else model


def boosted(
    params: dict[str, Any], features: str, label: str, seed: int = fixed.SEED, keys: Sequence[str] | None = None
) -> BoostedTrees:
    """Second-order boosted trees with row and feature samples per tree."""
    return BoostedTrees(featuresCol=features, labelCol=label, keyCols=list(keys) if keys else None, params_=json.dumps(params), seed=seed)


# --- searches -----------------------------------------------------------------


def positive_f1(label: str) -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(
        labelCol=label, predictionCol="prediction", metricName="fMeasureByLabel", metricLabel=1.0
    )


def _fold_scores(estimator, maps_of, folded: DataFrame, label: str, fold: int, parallelism: int) -> list[float]:
    """F1 on the rows of a fold of every point, fitted on all other rows weighted by their own classes.

    Points that differ in their steps alone follow the same path: a fit that ended before its last step serves those with more.
    """
    train = add_class_weight(folded.where(F.col(FOLD) != fold), label).persist()
    held = folded.where(F.col(FOLD) == fold).persist()
    try:
        maps = maps_of(train.count())
        scores = [0.0] * len(maps)
        paths: dict[tuple, list[int]] = {}
        for i in sorted(range(len(maps)), key=lambda i: maps[i][estimator.maxIter]):
            paths.setdefault(tuple(v for p, v in maps[i].items() if p != estimator.maxIter), []).append(i)

        def score_path(path: list[int]) -> None:
            ended = False
            for before, i in zip([None, *path], path):
                if ended:  # the fit before stopped by itself: more steps allowed give the same model
                    scores[i] = scores[before]
                    continue
                model = estimator.fit(train, maps[i])
                ended = model.summary.totalIterations < maps[i][estimator.maxIter]
                scores[i] = positive_f1(label).evaluate(model.transform(held))

        with ThreadPool(parallelism) as pool:
            pool.map(score_path, paths.values(), chunksize=1)
        return scores
    finally:
        train.unpersist()
        held.unpersist()


def search_logistic(
    train: DataFrame,
    label: str,
    keys: Sequence[str],
    features: str = "features",
    grid: dict[str, Sequence] = fixed.LOGISTIC_GRID,
    folds: int = fixed.OTHER_FOLDS,
    seed: int = fixed.SEED,
    parallelism: int = 4,
) -> Search:
    """Cross-validated choice among all points of the grid; the model is refitted on all rows.

    Class weights and the strength of the penalty come from each fold's own training rows.
    """
    folded = stage_table(stratified_folds(train, label, keys, folds, seed), "logistic-folds")
    points = grid_points({"max_iter": [200], **grid})
    base = logistic(points[0], 1, features, label)

    def maps_of(rows: int) -> list[dict]:
        return [
            {
                base.regParam: 1.0 / (p["C"] * rows),
                base.elasticNetParam: 1.0 if p["penalty"] == "l1" else 0.0,
                base.maxIter: int(p["max_iter"]),
            }
            for p in points
        ]

    by_fold = [_fold_scores(base, maps_of, folded, label, f, parallelism) for f in range(folds)]
    scores = [(p, sum(found) / folds) for p, found in zip(points, zip(*by_fold))]
    best, score = _best(scores)
    weighted = add_class_weight(folded, label)
    return Search(best, score, scores, logistic(best, folded.count(), features, label).fit(weighted))


def search_boosted(
    train: DataFrame,
    label: str,
    keys: Sequence[str],
    features: str = "features",
    grid: dict[str, Sequence] = fixed.BOOSTED_GRID,
    folds: int = fixed.OTHER_FOLDS,
    seed: int = fixed.SEED,
) -> Search:
    """Cross-validated choice of the boosting parameters; the best point's model of all rows.

    The ensembles of all points and folds, and those of all rows, grow in the same jobs.
    """
    folded = stage_table(stratified_folds(train, label, keys, folds, seed), "boosting-folds")
    points = grid_points(grid)
    fits = [Fit(p, f) for p in points for f in (*range(folds), NO_FOLD)]
    models = dict(zip([(i, f) for i in range(len(points)) for f in (*range(folds), NO_FOLD)], grow(folded, fits, features, label, keys, seed, FOLD)))
    scores = []
    for i, point in enumerate(points):
        parts = [models[i, f].transform(folded.where(F.col(FOLD) == f)).select(FOLD, label, "prediction") for f in range(folds)]
        scores.append((point, _mean_f1(reduce(DataFrame.unionAll, parts), label)))
    best, score = _best(scores)
    return Search(best, score, scores, models[points.index(best), NO_FOLD])


def _mean_f1(scored: DataFrame, label: str) -> float:
    """Mean over the folds of the F1 of class 1."""
    y, p = quoted(label) == 1, F.col("prediction") == 1
    f1 = F.coalesce(F.try_divide(2.0 * F.count_if(y & p), F.count_if(y) + F.count_if(p)), F.lit(0.0))
    return scored.groupBy(FOLD).agg(f1.alias("f1")).agg(F.avg("f1")).first()[0]


def knn_fold_scores(
    train: DataFrame,
    label: str,
    keys: Sequence[str],
    features: str = "features",
    key: str = "row_id",
    grid: dict[str, Sequence] = fixed.KNN_GRID,
    folds: int = fixed.KNN_FOLDS,
    seed: int = fixed.SEED,
) -> DataFrame:
    """F1 of class 1 per (metric, n_neighbors, weights, fold).

    One neighbour join per metric, with each row's own fold left out and the largest k,
    serves every fold, k and voting.
    """
    folded = stratified_folds(train, label, keys, folds, seed)
    truth = folded.select(quoted(key).alias("query"), quoted(label).alias("label"), FOLD)
    points, members = distinct_points(folded, key, features, FOLD)
    # identical rows of a fold share their votes: count them instead of repeating the votes
    weights = members.join(truth, "query").groupBy("point", FOLD, "label").agg(F.count(F.lit(1)).alias("n"))
    scored = None
    for metric in grid["metric"]:
        found = nearest_of_points(
            folded, points, max(grid["n_neighbors"]), metric, key, features, label, leave_out=FOLD
        )
        votes = vote_all(found, grid["n_neighbors"]).where(F.col("weights").isin(list(grid["weights"])))
        votes = votes.withColumn("metric", F.lit(metric))
        scored = votes if scored is None else scored.unionByName(votes)
    # an even vote goes to class 0, in whichever order its weights were added
    y, p = F.col("label") == 1, F.round("probability", 12) > 0.5

    def rows(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    return (
        scored.withColumnRenamed("query", "point")
        .join(weights, "point")
        .groupBy("metric", "n_neighbors", "weights", FOLD)
        .agg(
            F.coalesce(
                F.try_divide(2.0 * rows(y & p), (rows(y) + rows(p)).cast("double")), F.lit(0.0)
            ).alias("f1_score")
        )
    )


def search_knn(
    train: DataFrame,
    label: str,
    keys: Sequence[str],
    features: str = "features",
    key: str = "row_id",
    grid: dict[str, Sequence] = fixed.KNN_GRID,
    folds: int = fixed.KNN_FOLDS,
    seed: int = fixed.SEED,
) -> Search:
    """Cross-validated choice of k, voting and distance."""
    by_fold = knn_fold_scores(train, label, keys, features, key, grid, folds, seed)
    means = by_fold.groupBy("metric", "n_neighbors", "weights").agg(F.avg("f1_score").alias("s")).collect()
    found = {(r["metric"], r["n_neighbors"], r["weights"]): r["s"] for r in means}
    scores = [(p, found[p["metric"], p["n_neighbors"], p["weights"]]) for p in grid_points(grid)]
    best, score = _best(scores)
    model = KnnClassifier(train, best["n_neighbors"], best["weights"], best["metric"], key, features, label)
    return Search(best, score, scores, model)


# --- scoring ------------------------------------------------------------------


def score(model: Model, df: DataFrame, name: str, label: str, keep: Sequence[str] = ()) -> DataFrame:
    """Long predictions of one ``pyspark.ml`` model: (model, keep..., label, prediction, probability)."""
    scored = model.transform(df)
    has = "probability" in scored.columns
    probability = vector_to_array("probability")[1] if has else F.lit(None).cast("double")
    return scored.select(
        F.lit(name).alias("model"),
        *[quoted(c) for c in keep],
        quoted(label).cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        probability.alias("probability"),
    )


def score_knn(model: KnnClassifier, df: DataFrame, name: str, label: str, keep: Sequence[str] = ()) -> DataFrame:
    """Long predictions of a neighbour model."""
    rows = df.select(*dict.fromkeys([model.key, *keep, label]))
    scored = model.transform(df).join(rows, model.key)
    return scored.select(
        F.lit(name).alias("model"),
        *[quoted(c) for c in keep],
        quoted(label).cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        "probability",
    )


def feature_table(df: DataFrame, names: Sequence[str], values: Sequence[float], value: str) -> DataFrame:
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return df.sparkSession.createDataFrame(rows, f"feature string, {value} double")


def coefficient_table(model, names: Sequence[str], df: DataFrame) -> DataFrame:
    """Coefficients by absolute size."""
    table = feature_table(df, names, model.coefficients.toArray(), "coefficient")
    return table.withColumn("abs_coefficient", F.abs("coefficient")).orderBy(
        F.desc("abs_coefficient"), "feature"
    )


def importance_table(model, names: Sequence[str], df: DataFrame) -> DataFrame:
    """Feature importances, largest first; they sum to 1."""
    table = feature_table(df, names, model.featureImportances.toArray(), "importance")
    return table.orderBy(F.desc("importance"), "feature")
