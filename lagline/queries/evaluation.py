"""Queries on evaluation (M)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lagline.operators import evaluation as ev
from lagline.plans.examples import PREDICTIONS_SQL, example_predictions
from lagline.queries import register, rounded
from lagline.queries.sql import (
    BUSINESS_SQL,
    COMPARISON_SQL,
    CONFUSION_SQL,
    REPORT_SQL,
    metrics_columns_sql,
    ranking_sql,
)
from lagline.sources.tables import LINES_SQL

BASE = f"WITH {LINES_SQL}, {PREDICTIONS_SQL}"
COUNTED = f"{BASE}, {CONFUSION_SQL}, m AS (SELECT {metrics_columns_sql()} FROM confusion)"


def _register(name: str, operator, sql: str, digits: int = 6):
    @register(name, sql)
    def query(spark, sf):
        return rounded(operator(example_predictions(spark, sf)), digits)

    return query


_register("m1_confusion_counts", ev.confusion_counts, f"{BASE}, {CONFUSION_SQL} SELECT * FROM confusion")
_register(
    "m2_confusion_percentages",
    ev.confusion_percentages,
    f"""{COUNTED} SELECT model, tn, fp, fn, tp, round(tn * 100.0 / nullif(tn + fp, 0), 6) AS tn_pct,
    round(fp * 100.0 / nullif(tn + fp, 0), 6) AS fp_pct, round(fn * 100.0 / nullif(fn + tp, 0), 6) AS fn_pct,
    round(tp * 100.0 / nullif(fn + tp, 0), 6) AS tp_pct FROM m""",
)
_register(
    "m3_classification_metrics",
    ev.classification_metrics,
    f"""{COUNTED} SELECT model, round(accuracy, 6) AS accuracy, round("precision", 6) AS "precision",
    round(recall, 6) AS recall, round(f1_score, 6) AS f1_score FROM m""",
)
_register(
    "m4_roc_auc",
    ev.roc_auc,
    f"{BASE}, {ranking_sql()} SELECT model, round(roc_auc, 6) AS roc_auc FROM ranking",
)
_register(
    "m5_hard_roc_auc",
    ev.hard_roc_auc,
    f"{COUNTED} SELECT model, round(hard_roc_auc, 6) AS hard_roc_auc FROM m",
)
_register(
    "m6_classification_report",
    ev.classification_report,
    f"""{BASE}, {REPORT_SQL} SELECT model, class, round("precision", 6) AS "precision", round(recall, 6) AS recall,
    round(f1_score, 6) AS f1_score, support FROM report""",
)
_register(
    "m7_rates",
    ev.rates,
    f"{COUNTED} SELECT model, round(specificity, 6) AS specificity, round(sensitivity, 6) AS sensitivity FROM m",
)
_register(
    "m8_average_precision",
    ev.average_precision,
    f"{BASE}, {ranking_sql()} SELECT model, round(avg_precision, 6) AS avg_precision FROM ranking",
)


def _roc_points(predictions):
    """The starting threshold (infinity) is shown as missing."""
    points = ev.roc_curve(predictions)
    finite = F.when(F.col("threshold") < float("inf"), F.col("threshold"))
    return points.withColumn("threshold", finite)


_register(
    "m9_roc_curve",
    _roc_points,
    f"""{BASE}, {ranking_sql()} SELECT model, probability AS threshold, round(cum_neg / total_neg, 6) AS fpr,
    round(cum_pos / total_pos, 6) AS tpr FROM steps
    UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM steps""",
)
_register(
    "m10_precision_recall_curve",
    ev.pr_curve,
    f"""{BASE}, {ranking_sql()} SELECT model, probability AS threshold, round(cum_pos / (cum_pos + cum_neg), 6) AS "precision",
    round(cum_pos / total_pos, 6) AS recall FROM steps
    UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), CAST(1 AS DOUBLE), CAST(0 AS DOUBLE) FROM steps""",
)
_register(
    "m11_prevalence",
    ev.prevalence,
    f"{BASE} SELECT model, round(avg(label), 6) AS prevalence FROM predictions GROUP BY model",
)
EDGES = [i * 0.1 for i in range(1, 10)]
_register(
    "m12_calibration_curve",
    ev.calibration_curve,
    f"""{BASE}, b AS (SELECT *, {' + '.join(f'CAST(probability > CAST({e!r} AS DOUBLE) AS INT)' for e in EDGES)} AS bin
      FROM predictions WHERE probability IS NOT NULL)
    SELECT model, CAST(bin AS INT) AS bin, round(avg(probability), 6) AS mean_probability,
           round(avg(label), 6) AS positive_share, count(*) AS n FROM b GROUP BY model, bin""",
)
_register(
    "m13_overfitting_gap",
    ev.overfitting_gap,
    f"""{BASE}, s AS (SELECT model, split, avg(CAST(label = prediction AS INT)) AS accuracy,
      coalesce(2 * count(*) FILTER (label = 1 AND prediction = 1) / nullif(count(*) FILTER (label = 1) + count(*) FILTER (prediction = 1), 0), 0) AS f1
      FROM predictions GROUP BY model, split)
    SELECT a.model, round(b.accuracy, 6) AS train_accuracy, round(b.f1, 6) AS train_f1_score,
           round(a.accuracy, 6) AS test_accuracy, round(a.f1, 6) AS test_f1_score,
           round(b.accuracy - a.accuracy, 6) AS overfitting_gap
    FROM s a JOIN s b ON a.model = b.model AND a.split = 'test' AND b.split = 'train'""",
)
_register(
    "m14_business_value",
    ev.business_value,
    f"{BASE}, {CONFUSION_SQL}, {BUSINESS_SQL} SELECT * REPLACE (round(roi, 6) AS roi) FROM business",
)
_register(
    "m15_comparison_table",
    ev.comparison_table,
    f"{BASE}, {COMPARISON_SQL} SELECT * FROM comparison",
)
_register(
    "m15_basic_comparison",
    ev.basic_comparison,
    f"""{COUNTED} SELECT model, round(accuracy, 4) AS accuracy, round("precision", 4) AS "precision", round(recall, 4) AS recall,
    round(f1_score, 4) AS f1_score, round(hard_roc_auc, 4) AS roc_auc, model <> 'rule' AS has_probabilities FROM m""",
)
_register(
    "m15_business_comparison",
    ev.business_comparison,
    f"""{BASE}, {CONFUSION_SQL}, {BUSINESS_SQL} SELECT model, round(net_business_value, 2) AS net_business_value,
    round(roi, 2) AS roi, false_positives, false_negatives FROM business""",
)

RANKED = [
    "train_accuracy", "train_f1_score", "test_accuracy", "test_f1_score", "test_precision",
    "test_recall", "test_specificity", "test_sensitivity", "test_roc_auc", "test_avg_precision",
]
_register(
    "m16_best_by_metric",
    lambda p: ev.best_by_metric(ev.comparison_table(p)),
    f"""{BASE}, {COMPARISON_SQL}, long AS ({' UNION ALL '.join(f"SELECT '{m}' AS metric, model, {m} AS value FROM comparison" for m in RANKED)})
    SELECT metric, model, value FROM (
      SELECT *, row_number() OVER (PARTITION BY metric ORDER BY value DESC, model) AS place FROM long WHERE value IS NOT NULL)
    WHERE place = 1""",
)
_register(
    "m17_recommended_model",
    lambda p: ev.recommend(ev.business_value(p)),
    f"""{BASE}, {CONFUSION_SQL}, {BUSINESS_SQL} SELECT model, net_business_value, round(roi, 6) AS roi FROM business
    ORDER BY net_business_value DESC, model LIMIT 1""",
)
