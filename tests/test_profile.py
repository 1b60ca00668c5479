"""The profile plan, the checks and the consolidated report."""

import pytest
from pyspark.sql import functions as F

from lagline.operators import evaluation as ev
from lagline.plans.evaluate import consolidated_report
from lagline.plans.examples import LINES_CONFIG, example_predictions, raw_lines
from lagline.plans.prepare import prepare
from lagline.plans.profile import profile


def table(spark):
    rows = [(float(i), None if i % 4 == 0 else i * 2.0, "a" if i % 3 else None, f"v{i}", i % 2) for i in range(40)]
    rows.append((1000.0, float("nan"), "b", "v1", 1))
    return spark.createDataFrame(rows, "x double, y double, kind string, many string, late int")


def test_profile_reads_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = table(spark)
    found = {(r["column"], r["stat"]): r["value"] for r in profile(df.mapInArrow(counted, df.schema), ["x", "y", "gone"], ["kind", "many"], "late").collect()}
    assert seen.value == df.count()
    assert found["x", "n_outside"] == 1 and found["x", "whisker_high"] == 39 and found["x", "max"] == 1000
    assert found["y", "n_null"] == 11 and found["kind", "n_null"] == 14 and found["kind", "n of a"] == 26
    assert found["many", "n_distinct"] == 40 and ("many", "n of v1") not in found
    assert found["*", "class_1"] == 21 and found["*", "n_rows"] == 41
    assert not any(c == "gone" for c, _ in found)


def test_profile_of_nothing(spark):
    found = {(r["column"], r["stat"]): r["value"] for r in profile(table(spark).where("false"), ["x"], ["kind"], "late").collect()}
    assert found["*", "n_rows"] == 0 and found["x", "mean"] is None and found["x", "median"] is None
    assert profile(table(spark), [], [], None).count() == 1


def test_checks_of_the_written_rows(spark, sf):
    raw = raw_lines(spark, sf).withColumn("tax", F.when(F.col("l_linenumber") != 2, F.col("tax")))
    done = prepare(raw, LINES_CONFIG)
    found = {r["check"]: r["value"] for r in done.checks.table(spark).collect()}
    assert found["rows"] == done.rows.count() == found["class_0"] + found["class_1"]
    assert found["null tax"] > 0 and found["null sales"] == 0
    with pytest.raises(ValueError, match="one class only"):
        prepare(raw.withColumn("real_days", F.lit(0)), LINES_CONFIG)


def test_consolidated_report_names_the_recommended_model(spark, sf):
    predictions = example_predictions(spark, sf)
    lines = consolidated_report(predictions).collect()
    best = ev.recommend(ev.business_value(predictions.where("split = 'test'"))).first()["model"]
    said = {(r["section"], r["item"]): r["line"] for r in lines}
    assert len(said) == len(lines) and said["recommendation", "model"] == best
    assert said["technical", "rule test_roc_auc"] == "not available"
    assert sum(r["section"] == "recommendation" and r["item"].startswith("against") for r in lines) == 2
