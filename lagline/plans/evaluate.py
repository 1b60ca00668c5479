"""Comparison of scored models and the tables and texts reported about them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagline import fixed_values as fixed
from lagline.operators import evaluation as ev
from lagline.session import stage_table
from lagline.sources.delimited import write_csv


@dataclass
class Evaluation:
    """Result tables for all models of a long predictions table."""

    comparison: DataFrame
    business: DataFrame
    best: DataFrame
    recommended: DataFrame
    reports: DataFrame


def evaluate(predictions: DataFrame) -> Evaluation:
    """All tables of the evaluation; every one is an aggregate of ``predictions``.

    Pass a persisted or written table: it is scanned once per result.
    """
    test = predictions.where(F.col("split") == "test")
    comparison = ev.comparison_table(predictions)
    business = ev.business_value(test)
    return Evaluation(
        comparison,
        business,
        ev.best_by_metric(comparison),
        ev.recommend(business),
        detailed_reports(test),
    )


def detailed_reports(predictions: DataFrame) -> DataFrame:
    """(model, section, item, value): report, confusion cells and rates per model."""
    report = ev.classification_report(predictions).select(
        "model", F.lit("report").alias("section"), "class",
        F.expr("stack(4, 'precision', precision, 'recall', recall, 'f1_score', f1_score, 'support', double(support)) AS (measure, value)"),
    )
    report = report.select("model", "section", F.concat_ws(" ", "class", "measure").alias("item"), "value")
    counts = ev.count_metrics(ev.confusion_counts(predictions))
    cells = counts.unpivot(
        "model", [F.col(c).cast("double").alias(c) for c in ["tn", "fp", "fn", "tp", "specificity", "sensitivity"]],
        "item", "value",
    )
    section = F.when(F.col("item").isin(ev.CONFUSION), "confusion").otherwise("rates")
    return report.unionByName(cells.select("model", section.alias("section"), "item", "value"))


def report_lines(predictions: DataFrame) -> DataFrame:
    """(model, line): one readable sentence per result, for all models.

    Built from the small result tables as text columns; write it with ``write.text``.
    """
    counts = ev.count_metrics(ev.confusion_counts(predictions))
    priced = counts.withColumns(ev.money_columns())

    def line(text: str, *columns: Column) -> Column:
        return F.format_string(text, *columns)

    on_time, late = fixed.CLASS_NAMES[0], fixed.CLASS_NAMES[1]
    lines = F.array(
        line(f"{on_time}: %d right, %d wrong", F.col("tn"), F.col("fp")),
        line(f"{late}: %d right, %d wrong", F.col("tp"), F.col("fn")),
        line("accuracy %.4f, precision %.4f, recall %.4f, F1 %.4f",
             *[F.col(c) for c in ("accuracy", "precision", "recall", "f1_score")]),
        line("specificity %.4f, sensitivity %.4f", F.col("specificity"), F.col("sensitivity")),
        line("net value %.2f, return %.2f%%", F.col("net_business_value"), F.col("roi")),
    )
    return priced.select("model", F.posexplode(lines).alias("position", "line"))


def consolidated_report(predictions: DataFrame) -> DataFrame:
    """(section, item, line): what one report says about all models together.

    Every test and train metric and all money figures per model, the best model of every metric and
    by money, the recommended model with the reasons, and what was compared. Made from the small
    result tables, which are written once; write it with ``write.text``.
    """
    test = predictions.where(F.col("split") == "test")
    comparison = stage_table(ev.comparison_table(predictions), "comparison")
    business = stage_table(ev.business_comparison(test), "business")
    metrics = [c for c in comparison.columns if c not in ("model", "has_probabilities")]

    def lines(df: DataFrame, section: str, item: Column | str, text: Column) -> DataFrame:
        return df.select(F.lit(section).alias("section"), (F.col(item) if isinstance(item, str) else item).alias("item"), text.alias("line"))

    long = comparison.unpivot("model", [F.col(m) for m in metrics], "metric", "value")
    technical = F.when(F.col("value").isNull(), "not available").otherwise(F.format_string("%.4f", "value"))
    money = F.format_string("net value %.2f, return %.2f%%, %d false alarms, %d missed", "net_business_value", "roi", "false_positives", "false_negatives")
    best = ev.best_by_metric(comparison)
    first = ev.recommend(business)
    others = business.join(first.select(F.col("model").alias("chosen"), F.col("net_business_value").alias("most")), F.col("model") != F.col("chosen"))
    reasons = {
        "net value": F.format_string("largest net value: %.2f", "net_business_value"),
        "return": F.format_string("return on cost: %.2f%%", "roi"),
    }
    chosen = first.join(comparison, "model")
    size = comparison.agg(F.count(F.lit(1)).alias("n"), F.count_if("has_probabilities").alias("p"))
    parts = [
        lines(long, "technical", F.concat_ws(" ", "model", "metric"), technical),
        lines(business, "business", "model", money),
        lines(best, "best by metric", "metric", F.format_string("%s (%.4f)", "model", "value")),
        lines(first, "best by money", F.lit("net value"), F.format_string("%s (%.2f)", "model", "net_business_value")),
        lines(first, "recommendation", F.lit("model"), F.col("model")),
        *[lines(first, "recommendation", F.lit(k), v) for k, v in reasons.items()],
        lines(chosen, "recommendation", F.lit("quality"), F.format_string("accuracy %.4f, F1 %.4f", "test_accuracy", "test_f1_score")),
        lines(others, "recommendation", F.concat(F.lit("against "), "model"), F.format_string("%.2f more net value", F.col("most") - F.col("net_business_value"))),
        lines(size, "compared", F.lit("models"), F.format_string("%d models, %d with probabilities", "n", "p")),
    ]
    return reduce(DataFrame.unionAll, parts)


def save_tables(result: Evaluation, path: str) -> None:
    """Comparison, business and best-model tables as CSV folders."""
    write_csv(result.comparison, f"{path}/model_comparison")
    write_csv(result.business, f"{path}/business_metrics_comparison")
    write_csv(result.best, f"{path}/best_models")
    write_csv(result.recommended, f"{path}/recommended_model")
    write_csv(result.reports, f"{path}/detailed_reports")
