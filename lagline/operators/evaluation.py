"""Evaluation of any number of scored models in one pass.

Input is the long table (model, label, prediction, probability); probability is NULL for
models that give none. Every metric is an aggregation grouped by model, so a table of
any size costs one partial-aggregated shuffle of a few rows per task and model.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lagline import fixed_values as fixed
from lagline.functions.ranks import running_totals

CONFUSION = ["tn", "fp", "fn", "tp"]


def _ratio(top: Column, bottom: Column) -> Column:
    """top / bottom as double, 0 where the bottom is 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


# --- counts and metrics from counts -------------------------------------------


def confusion_counts(predictions: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """tn, fp, fn, tp per model."""
    y, p = F.col("label"), F.col("prediction")
    return predictions.groupBy(*by).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def confusion_percentages(predictions: DataFrame) -> DataFrame:
    """Each confusion cell as percent of its true class; NULL for an absent class."""
    counts = confusion_counts(predictions)

    def share(cell: str, other: str) -> Column:
        return F.try_divide(F.col(cell) * 100.0, F.col(cell) + F.col(other)).alias(f"{cell}_pct")

    return counts.select(
        "model", *CONFUSION, share("tn", "fp"), share("fp", "tn"), share("fn", "tp"), share("tp", "fn")
    )


def count_metrics(counts: DataFrame) -> DataFrame:
    """All metrics that follow from confusion counts; a zero denominator gives 0."""
    tn, fp, fn, tp = (F.col(c) for c in CONFUSION)
    recall, specificity = _ratio(tp, tp + fn), _ratio(tn, tn + fp)
    return counts.withColumns(
        {
            "accuracy": _ratio(tp + tn, tp + tn + fp + fn),
            "precision": _ratio(tp, tp + fp),
            "recall": recall,
            "f1_score": _ratio(2 * tp, 2 * tp + fp + fn),
            "specificity": specificity,
            "sensitivity": recall,
            # area under the ROC of 0/1 predictions: undefined with one class only
            "hard_roc_auc": F.when((tp + fn > 0) & (tn + fp > 0), (recall + specificity) / 2),
        }
    )


def classification_metrics(predictions: DataFrame) -> DataFrame:
    metrics = count_metrics(confusion_counts(predictions))
    return metrics.select("model", "accuracy", "precision", "recall", "f1_score")


def hard_roc_auc(predictions: DataFrame) -> DataFrame:
    """Area under the ROC curve of the hard predictions."""
    return count_metrics(confusion_counts(predictions)).select("model", "hard_roc_auc")


def rates(predictions: DataFrame) -> DataFrame:
    return count_metrics(confusion_counts(predictions)).select("model", "specificity", "sensitivity")


def classification_report(predictions: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, plus accuracy and both averages.

    Works for any number of classes: it starts from counts of (label, prediction).
    """
    cells = predictions.groupBy("model", "label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = cells.select(
        "model",
        F.inline(
            F.array(
                F.struct(F.col("label").cast("string").alias("class"), F.col("n").alias("support"),
                         F.lit(0).cast("bigint").alias("predicted"), hit.cast("bigint").alias("tp")),
                F.struct(F.col("prediction").cast("string").alias("class"), F.lit(0).cast("bigint").alias("support"),
                         F.col("n").alias("predicted"), F.lit(0).cast("bigint").alias("tp")),
            )
        ),
    )
    support, predicted, tp = F.sum("support"), F.sum("predicted"), F.sum("tp")
    classes = sides.groupBy("model", "class").agg(
        _ratio(tp, predicted).alias("precision"),
        _ratio(tp, support).alias("recall"),
        _ratio(2 * tp, support + predicted).alias("f1_score"),
        support.alias("support"),
        tp.alias("tp"),
    )
    n = F.sum("support")
    accuracy = _ratio(F.sum("tp"), n)
    scores = ["precision", "recall", "f1_score"]

    def row(name: str, values: Sequence[Column]) -> Column:
        named = [v.alias(s) for s, v in zip(scores, values)]
        return F.struct(F.lit(name).alias("class"), *named, n.alias("support"))

    averages = classes.groupBy("model").agg(
        F.array(
            row("accuracy", [accuracy] * 3),
            row("macro avg", [F.avg(s) for s in scores]),
            row("weighted avg", [_ratio(F.sum(F.col(s) * F.col("support")), n) for s in scores]),
        ).alias("rows")
    )
    return classes.select("model", "class", *scores, "support").unionByName(
        averages.select("model", F.inline("rows"))
    )


# --- curves -------------------------------------------------------------------


def score_steps(predictions: DataFrame) -> DataFrame:
    """Per (model, probability): positives, negatives and running totals from the top.

    Rows collapse to distinct probabilities first, then run in range partitions, so neither
    a popular probability nor a large model ends up in one task.
    """
    y = F.col("label")
    steps = (
        predictions.where(F.col("probability").isNotNull())
        .groupBy("model", "probability")
        .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
        .where(F.col("pos") + F.col("neg") > 0)
    )
    return running_totals(steps, "model", "probability", ["pos", "neg"])


def ranking_metrics(predictions: DataFrame) -> DataFrame:
    """Exact ROC-AUC (ties count half) and average precision per model.

    Both are sums over distinct probabilities: AUC = sum neg_i (tp_before + pos_i / 2) /
    (P N), AP = sum pos_i / P * tp_i / (tp_i + fp_i).
    """
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    above, n_pos, n_neg = F.col("cum_pos"), F.sum("pos"), F.sum("neg")
    won = F.sum(neg * (above - pos / 2))
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return score_steps(predictions).groupBy("model").agg(
        F.try_divide(won, n_pos.cast("double") * n_neg).alias("roc_auc"),
        F.coalesce(F.try_divide(F.sum(pos * precision), n_pos), F.lit(0.0)).alias("avg_precision"),
    )


def roc_auc(predictions: DataFrame) -> DataFrame:
    return ranking_metrics(predictions).select("model", "roc_auc")


def average_precision(predictions: DataFrame) -> DataFrame:
    return ranking_metrics(predictions).select("model", "avg_precision")


def roc_curve(predictions: DataFrame) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct probability, and the start at (0, 0)."""
    point = F.struct(
        F.col("probability").alias("threshold"),
        F.try_divide(F.col("cum_neg").cast("double"), F.col("total_neg")).alias("fpr"),
        F.try_divide(F.col("cum_pos").cast("double"), F.col("total_pos")).alias("tpr"),
    )
    start = F.struct(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return _points(predictions, point, start)


def pr_curve(predictions: DataFrame) -> DataFrame:
    """(threshold, precision, recall) per distinct probability, and the end at (1, 0)."""
    found = F.col("cum_pos") + F.col("cum_neg")
    recall = F.try_divide(F.col("cum_pos").cast("double"), F.col("total_pos"))
    point = F.struct(
        F.col("probability").alias("threshold"),
        (F.col("cum_pos") / found).alias("precision"),
        F.coalesce(recall, F.lit(1.0)).alias("recall"),
    )
    end = F.struct(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return _points(predictions, point, end)


def _points(predictions: DataFrame, point: Column, extra: Column) -> DataFrame:
    """One point per step; the top step of each model also gives the extra point."""
    top = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
    rows = F.when(top, F.array(point, extra)).otherwise(F.array(point))
    return score_steps(predictions).select("model", F.inline(rows))


def prevalence(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("model").agg(F.avg(F.col("label").cast("double")).alias("prevalence"))


def calibration_bin(probability: Column, bins: int = fixed.CALIBRATION_BINS) -> Column:
    """Bin number with right-closed bins: how many inner edges lie below the value."""
    step = 1.0 / bins  # edges as multiples of the step, as an evenly spaced grid has them
    edges = [i * step for i in range(1, bins)]
    return sum(((F.lit(e) < probability).cast("int") for e in edges), F.lit(0))


def calibration_curve(predictions: DataFrame, bins: int = fixed.CALIBRATION_BINS) -> DataFrame:
    """Mean probability and share of positives per non-empty bin."""
    scored = predictions.where(F.col("probability").isNotNull())
    return scored.groupBy("model", calibration_bin(F.col("probability"), bins).alias("bin")).agg(
        F.avg("probability").alias("mean_probability"),
        F.avg(F.col("label").cast("double")).alias("positive_share"),
        F.count(F.lit(1)).alias("n"),
    )


# --- comparison ---------------------------------------------------------------


def side_counts(predictions: DataFrame) -> DataFrame:
    """Confusion counts of the train and the test rows, one row per model."""
    y, p = F.col("label"), F.col("prediction")
    cells = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    return predictions.groupBy("model").agg(
        *[
            F.count_if((F.col("split") == side) & (y == truth) & (p == guess)).alias(f"{side}_{name}")
            for side in ("train", "test")
            for name, (truth, guess) in cells.items()
        ]
    )


def _side_metric(side: str, metric: str) -> Column:
    """A metric of one side; NULL where the side has no rows."""
    tn, fp, fn, tp = (F.col(f"{side}_{c}") for c in CONFUSION)
    top, bottom = {
        "accuracy": (tp + tn, tp + tn + fp + fn),
        "precision": (tp, tp + fp),
        "recall": (tp, tp + fn),
        "f1_score": (2 * tp, 2 * tp + fp + fn),
        "specificity": (tn, tn + fp),
        "sensitivity": (tp, tp + fn),
    }[metric]
    return F.when(tn + fp + fn + tp > 0, _ratio(top, bottom))


def _gap() -> Column:
    return (_side_metric("train", "accuracy") - _side_metric("test", "accuracy")).alias("overfitting_gap")


def overfitting_gap(predictions: DataFrame) -> DataFrame:
    """Train and test accuracy and F1 per model and their gap; NULL without train rows."""
    metrics = [
        _side_metric(side, metric).alias(f"{side}_{metric}")
        for side in ("train", "test")
        for metric in ("accuracy", "f1_score")
    ]
    return side_counts(predictions).select("model", *metrics, _gap())


def business_value(
    predictions: DataFrame,
    cost_fp: float = fixed.COST_FALSE_POSITIVE,
    cost_fn: float = fixed.COST_FALSE_NEGATIVE,
    benefit_tp: float = fixed.BENEFIT_TRUE_POSITIVE,
) -> DataFrame:
    """Costs, benefit, net value and return on cost in percent (0 without cost)."""
    return business_from_counts(confusion_counts(predictions), cost_fp, cost_fn, benefit_tp)


def business_from_counts(
    counts: DataFrame,
    cost_fp: float = fixed.COST_FALSE_POSITIVE,
    cost_fn: float = fixed.COST_FALSE_NEGATIVE,
    benefit_tp: float = fixed.BENEFIT_TRUE_POSITIVE,
) -> DataFrame:
    names = {"fp": "false_positives", "fn": "false_negatives", "tp": "true_positives", "tn": "true_negatives"}
    return counts.select("model", *[F.col(c).alias(n) for c, n in names.items()], *[e.alias(n) for n, e in money_columns(cost_fp, cost_fn, benefit_tp).items()])


def money_columns(
    cost_fp: float = fixed.COST_FALSE_POSITIVE,
    cost_fn: float = fixed.COST_FALSE_NEGATIVE,
    benefit_tp: float = fixed.BENEFIT_TRUE_POSITIVE,
) -> dict[str, Column]:
    """Costs, benefit, net value and return from the confusion counts of a row."""
    of_fp, of_fn, gain = F.col("fp") * F.lit(float(cost_fp)), F.col("fn") * F.lit(float(cost_fn)), F.col("tp") * F.lit(float(benefit_tp))
    cost = of_fp + of_fn
    return {
        "cost_false_positives": of_fp,
        "cost_false_negatives": of_fn,
        "benefit_true_positives": gain,
        "total_cost": cost,
        "total_benefit": gain,
        "net_business_value": gain - cost,
        "roi": _ratio((gain - cost) * 100, cost),
    }


def comparison_table(predictions: DataFrame, digits: int = 4) -> DataFrame:
    """One row per model: test metrics, train metrics, gap and ranking metrics, rounded."""
    wanted = [
        *(("train", m) for m in ("accuracy", "f1_score")),
        *(("test", m) for m in ("accuracy", "f1_score", "precision", "recall", "specificity", "sensitivity")),
    ]
    metrics = [_side_metric(side, metric).alias(f"{side}_{metric}") for side, metric in wanted]
    counted = side_counts(predictions).select("model", *metrics, _gap())
    ranked = ranking_metrics(predictions.where(F.col("split") == "test")).select(
        "model",
        F.col("roc_auc").alias("test_roc_auc"),
        F.col("avg_precision").alias("test_avg_precision"),
    )
    table = counted.join(ranked, "model", "left")
    return table.select(
        "model",
        *[F.round(c, digits).alias(c) for c in table.columns if c != "model"],
        F.col("test_roc_auc").isNotNull().alias("has_probabilities"),
    )


def basic_comparison(predictions: DataFrame, digits: int = 4) -> DataFrame:
    """One row per model with hard-prediction metrics and the probability flag."""
    has = predictions.groupBy("model").agg((F.count("probability") > 0).alias("has_probabilities"))
    metrics = count_metrics(confusion_counts(predictions))
    named = ["accuracy", "precision", "recall", "f1_score"]
    return metrics.select(
        "model",
        *[F.round(c, digits).alias(c) for c in named],
        F.round("hard_roc_auc", digits).alias("roc_auc"),
    ).join(has, "model")


def business_comparison(predictions: DataFrame, digits: int = 2) -> DataFrame:
    """Net value, return and error counts per model, rounded."""
    value = business_value(predictions)
    return value.select(
        "model",
        F.round("net_business_value", digits).alias("net_business_value"),
        F.round("roi", digits).alias("roi"),
        "false_positives",
        "false_negatives",
    )


def best_by_metric(table: DataFrame, exclude: Sequence[str] = ("overfitting_gap", "has_probabilities")) -> DataFrame:
    """(metric, model, value): the best model for every metric; the first name on ties."""
    metrics = [c for c in table.columns if c != "model" and c not in exclude]
    long = table.unpivot("model", [F.col(m).cast("double").alias(m) for m in metrics], "metric", "value")
    order = W.partitionBy("metric").orderBy(F.desc("value"), "model")
    return (
        long.where(F.col("value").isNotNull())
        .withColumn("place", F.row_number().over(order))
        .where("place = 1")
        .select("metric", "model", "value")
    )


def smallest_gap(table: DataFrame) -> DataFrame:
    """The model whose overfitting gap is closest to 0."""
    gaps = table.where(F.col("overfitting_gap").isNotNull())
    return gaps.orderBy(F.abs("overfitting_gap"), "model").limit(1).select("model", "overfitting_gap")


def recommend(business: DataFrame) -> DataFrame:
    """The model with the largest net value; the first name on ties."""
    return business.orderBy(F.desc("net_business_value"), "model").limit(1).select(
        "model", "net_business_value", "roi"
    )


def metrics_for_chart(table: DataFrame) -> DataFrame:
    """Test metrics with missing values shown as 0."""
    shown = ["test_accuracy", "test_precision", "test_recall", "test_f1_score", "test_roc_auc"]
    return table.select("model", *[F.coalesce(F.col(m), F.lit(0.0)).alias(m) for m in shown])
