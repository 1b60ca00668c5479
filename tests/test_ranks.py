import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lagline.functions import ranks
from lagline.operators.splitting import (
    fold_rows_by_class,
    stratified_folds,
    stratified_split,
    test_rows_by_class as rows_by_class,
)


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    data = [(i, int(rng.random() < 0.3)) for i in range(1237)]
    return spark.createDataFrame(data, "id long, label int").cache()


@pytest.mark.parametrize("leaf", [1000, 3])
def test_split_sizes_are_exact_and_stable(rows, monkeypatch, leaf):
    monkeypatch.setattr(ranks, "LEAF_ROWS", leaf)
    split = stratified_split(rows, "label", ["id"])
    got = {(r["label"], r["split"]): r["n"] for r in split.groupBy("label", "split").agg(F.count("*").alias("n")).collect()}
    counts = {c: got[c, "train"] + got[c, "test"] for c in (0, 1)}
    assert {c: got[c, "test"] for c in (0, 1)} == rows_by_class(counts, 0.2)
    assert got[0, "test"] + got[1, "test"] == math.ceil(0.2 * 1237)
    again = stratified_split(rows.repartition(7), "label", ["id"])
    assert sorted(split.collect()) == sorted(again.collect())
    other = stratified_split(rows, "label", ["id"], seed=43)
    assert sorted(split.collect()) != sorted(other.collect())


@pytest.mark.parametrize("k", [3, 5])
def test_folds_are_even(rows, k):
    folded = stratified_folds(rows, "label", ["id"], k)
    got = {(r["label"], r["fold"]): r["n"] for r in folded.groupBy("label", "fold").agg(F.count("*").alias("n")).collect()}
    for c in (0, 1):
        sizes = [got[c, f] for f in range(k)]
        assert max(sizes) - min(sizes) <= 1
    totals = [got[0, f] + got[1, f] for f in range(k)]
    assert max(totals) - min(totals) <= 1 and sum(totals) == 1237


def test_fold_sizes_by_dealing():
    assert fold_rows_by_class({0: 4, 1: 3}, 3) == {0: [2, 1, 1], 1: [1, 1, 1]}


def test_largest_remainder():
    assert rows_by_class({0: 5, 1: 5}, 0.2) == {0: 1, 1: 1}
    assert rows_by_class({0: 7, 1: 4}, 0.2) == {0: 2, 1: 1}


@pytest.mark.parametrize("leaf", [1000, 3])
def test_copies_at_a_cut_stay_together(spark, monkeypatch, leaf):
    monkeypatch.setattr(ranks, "LEAF_ROWS", leaf)
    data = [(i // 10, i % 2) for i in range(400)]  # five copies of every key and label
    rows = spark.createDataFrame(data, "id long, label int")
    split = stratified_split(rows, "label", ["id"], test_size=0.21)
    sides = split.groupBy("id", "label").agg(F.count_distinct("split").alias("n"))
    assert [r["n"] for r in sides.collect()] == [1] * 80
    # 42 rows asked of each class: the cut moves to the end of the ninth group of five
    assert {r["label"]: r["count"] for r in split.where("split = 'test'").groupBy("label").count().collect()} == {0: 45, 1: 45}


def test_rows_without_label_are_refused(spark):
    rows = spark.createDataFrame([(1, 0), (2, 1), (3, None), (4, None)], "id long, label int")
    with pytest.raises(ValueError, match="2 rows have no label"):
        stratified_split(rows, "label", ["id"])


def test_running_totals(spark):
    rng = np.random.default_rng(3)
    # most scores crowd near 0, and each group has its own number of them
    pdf = pd.DataFrame({"model": rng.choice(["a", "b"], 5000, p=[0.9, 0.1]), "p": rng.random(5000) ** 9}).drop_duplicates()
    pdf["n"] = rng.integers(0, 5, len(pdf))
    found = ranks.running_totals(spark.createDataFrame(pdf), "model", "p", ["n"]).toPandas()
    want = pdf.sort_values("p", ascending=False)
    want["cum_n"] = want.groupby("model")["n"].cumsum()
    merged = found.merge(want, on=["model", "p"], suffixes=("", "_want"))
    assert len(merged) == len(pdf) and (merged["cum_n"] == merged["cum_n_want"]).all()
    assert (merged["total_n"] == merged.groupby("model")["n"].transform("sum")).all()


@pytest.mark.parametrize("partitions", [1, 3, 10_000])
def test_running_totals_over_many_partitions(spark, monkeypatch, partitions):
    """The number of range partitions follows the session and the rows, and never changes the totals."""
    df = spark.range(30_000).select((F.col("id") % 7).cast("string").alias("model"), (F.col("id") / 7).alias("p"), (F.col("id") % 3).alias("n"))
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    seen = {}
    stage = ranks.stage_table
    monkeypatch.setattr(ranks, "stage_table", lambda df, name: seen.setdefault("plan", df) and stage(df, name))
    try:
        found = ranks.running_totals(df, "model", "p", ["n"], ascending=True)
        planned = seen["plan"]._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in planned
        assert partitions == 1 or ("rangepartitioning(model" in planned and f", {partitions})" in planned)
        got = found.toPandas().sort_values(["model", "p"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    assert len(got) == 30_000
    assert (got["cum_n"] == got.groupby("model")["n"].cumsum()).all()
    assert (got["total_n"] == got.groupby("model")["n"].transform("sum")).all()


def test_keys_with_bars_hash_apart(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("a\\", "|b|c"), ("a\\|b", "c"), ("\\N", "c"), (None, "c"), ("1", "c")]
    found = spark.createDataFrame(rows, "a string, b string").select(ranks.row_hash(["a", "b"], 1).alias("h"))
    assert found.distinct().count() == len(rows)
