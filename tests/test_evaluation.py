import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lagline.operators import evaluation as ev
from lagline.plans.evaluate import evaluate, report_lines, save_tables

# Published test metrics, and the only confusion counts that give them.
PUBLISHED = {
    "knn": dict(
        tp=14743, fp=4531, fn=5937, tn=10893, accuracy=0.7100598271659649, precision=0.7649164677804295,
        recall=0.7129110251450677, f1_score=0.7379986985032788, hard_roc_auc=0.7095740291700441, net=-473000.0,
    ),
    "logistic_regression": dict(
        tp=12108, fp=2534, fn=8572, tn=12890, accuracy=0.6923886549966762, precision=0.8269362109001502,
        recall=0.5854932301740813, f1_score=0.6855783930694751, net=-2117800.0,
    ),
    "xgboost": dict(
        tp=12900, fp=2261, fn=7780, tn=13163, accuracy=0.7218867715488588, precision=0.8508673570344965,
        recall=0.6237911025145068, f1_score=0.7198459864401104, hard_roc_auc=0.7386006861120252, net=-1536100.0,
    ),
}
SCHEMA = "model string, split string, label int, prediction int, probability double"


@pytest.fixture(scope="module")
def published(spark):
    cells = [
        (m, y, p, v[c]) for m, v in PUBLISHED.items() for c, y, p in (("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0), ("tn", 0, 0))
    ]
    df = spark.createDataFrame(cells, "model string, label int, prediction int, n int")
    return df.select("model", "label", "prediction", F.explode(F.sequence(F.lit(1), "n"))).select("model", "label", "prediction")


def test_published_metrics(published):
    for r in ev.count_metrics(ev.confusion_counts(published)).collect():
        want = PUBLISHED[r["model"]]
        for name in ("accuracy", "precision", "recall", "f1_score", "hard_roc_auc"):
            if name in want:
                assert math.isclose(r[name], want[name], rel_tol=1e-14), (r["model"], name)


def test_published_money(published):
    value = ev.business_value(published)
    assert {r["model"]: r["net_business_value"] for r in value.collect()} == {m: v["net"] for m, v in PUBLISHED.items()}
    best = ev.recommend(value).first()
    assert best["model"] == "knn" and round(best["roi"], 4) == -13.8239


def frame(spark, rows):
    return spark.createDataFrame([("m", "test", y, int(p > 0.5), p) for y, p in rows], SCHEMA)


def test_average_precision_is_a_step_sum(spark):
    rows = frame(spark, [(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)])
    got = ev.ranking_metrics(rows).first()
    assert math.isclose(got["avg_precision"], 5 / 6) and got["roc_auc"] == 0.75


def test_ties_count_half(spark):
    rows = frame(spark, [(0, 0.5), (1, 0.5), (0, 0.2), (1, 0.9)])
    assert ev.roc_auc(rows).first()["roc_auc"] == 0.875
    points = {(r["fpr"], r["tpr"]) for r in ev.roc_curve(rows).collect()}
    assert points == {(0.0, 0.0), (0.0, 0.5), (0.5, 1.0), (1.0, 1.0)}
    curve = {(r["precision"], r["recall"]) for r in ev.pr_curve(rows).collect()}
    assert curve == {(1.0, 0.0), (1.0, 0.5), (2 / 3, 1.0), (0.5, 1.0)}


def test_auc_against_all_pairs_and_monotone_maps(spark):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 400)
    p = np.round(np.clip(rng.normal(0.4 + 0.2 * y, 0.25), 0, 1), 2)
    pos, neg = p[y == 1], p[y == 0]
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    rows = frame(spark, [(int(a), float(b)) for a, b in zip(y, p)])
    assert math.isclose(ev.roc_auc(rows).first()["roc_auc"], want, rel_tol=1e-12)
    squeezed = rows.withColumn("probability", F.pow("probability", 5))
    assert math.isclose(ev.roc_auc(squeezed).first()["roc_auc"], want, rel_tol=1e-12)


def test_one_class_and_no_hits(spark):
    only_zero = frame(spark, [(0, 0.1), (0, 0.2)])
    got = ev.count_metrics(ev.confusion_counts(only_zero)).first()
    assert (got["precision"], got["recall"], got["f1_score"], got["accuracy"]) == (0.0, 0.0, 0.0, 1.0)
    assert got["hard_roc_auc"] is None and ev.roc_auc(only_zero).first()["roc_auc"] is None
    cells = ev.confusion_percentages(only_zero).first()
    assert cells["tn_pct"] == 100.0 and cells["tp_pct"] is None
    assert ev.business_value(only_zero).first()["roi"] == 0.0


def test_calibration_bins_are_right_closed(spark):
    values = [0.0, 0.1, 0.3, 0.30000000001, 0.7, 1.0]
    edges = np.linspace(0, 1, 11)[1:-1]
    df = spark.createDataFrame([(v,) for v in values], "p double").select(ev.calibration_bin(F.col("p")).alias("b"))
    assert [r["b"] for r in df.collect()] == np.searchsorted(edges, values).tolist()


def test_report_for_three_classes(spark):
    rows = [("m", y, p) for y, p in [(0, 0), (0, 1), (1, 1), (2, 2), (2, 0), (2, 2)]]
    got = {r["class"]: r for r in ev.classification_report(spark.createDataFrame(rows, "model string, label int, prediction int")).collect()}
    assert math.isclose(got["2"]["f1_score"], 0.8) and got["2"]["support"] == 3
    assert math.isclose(got["accuracy"]["f1_score"], 4 / 6)
    assert math.isclose(got["macro avg"]["recall"], (0.5 + 1 + 2 / 3) / 3)


def test_whole_evaluation(spark, sf, tmp_path):
    from lagline.plans.examples import example_predictions

    predictions = example_predictions(spark, sf).cache()
    result = evaluate(predictions)
    table = {r["model"]: r for r in result.comparison.collect()}
    assert not table["rule"]["has_probabilities"] and table["rule"]["test_roc_auc"] is None
    n = predictions.groupBy("model").count().first()["count"]
    cells = ev.confusion_counts(predictions).first()
    assert sum(cells[c] for c in ev.CONFUSION) == n
    gaps = [abs(r["overfitting_gap"]) for r in table.values()]
    assert abs(ev.smallest_gap(result.comparison).first()["overfitting_gap"]) == min(gaps)
    save_tables(result, str(tmp_path))
    saved = spark.read.option("header", True).csv(str(tmp_path / "model_comparison"))
    assert saved.count() == 3 and saved.columns == result.comparison.columns
    assert report_lines(predictions).count() == 15
