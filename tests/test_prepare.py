"""The whole preparation against a plain pandas computation, and its life after saving."""

import importlib
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lagline import fixed_values as fixed
from lagline.operators import cleaning, learning
from lagline.plans import train as training
from lagline.plans.evaluate import evaluate
from lagline.plans.examples import LINES_CONFIG, RAW_COLUMNS, raw_lines
from lagline.plans.prepare import FEATURES, PrepareConfig, prepare, prepare_new
from lagline.sources import tables
from lagline.sources.prepared import load_stages, save_stages
from lagline.sources.tables import LINE_KEY, order_lines
from lagline.streaming.scoring import score_new, write_scores

prepare_plan = importlib.import_module("lagline.plans.prepare")


@pytest.fixture(scope="module")
def lines(spark, sf):
    return raw_lines(spark, sf).cache()


@pytest.fixture(scope="module")
def done(lines):
    return prepare(lines, LINES_CONFIG)


def by_hand(pdf, split):
    """The same preparation with pandas, given which rows are test rows."""
    num = [c for c in pdf.columns if pd.api.types.is_numeric_dtype(pdf[c]) and c != "late"]
    text = [c for c in pdf.columns if not pd.api.types.is_numeric_dtype(pdf[c])]
    x = pdf[num].astype(float)
    q1, q3 = x.quantile(0.25), x.quantile(0.75)
    x = x.clip(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1), axis=1)
    parts = [x]
    for c in text:
        counts = pdf[c].value_counts()
        values = pdf[c]
        if len(counts) > 15:
            top = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:15]
            values = values.where(values.isin([k for k, _ in top]), "Other")
        parts.append(pd.get_dummies(values, prefix=c).astype(float))
    full = pd.concat(parts, axis=1)
    train = full[split == "train"]
    kept = [c for c in full if train[c].var(ddof=0) > 0.01]
    r = train[kept].corr().abs().to_numpy()
    kept = [c for j, c in enumerate(kept) if not (r[:j, j] > 0.9).any()]
    scaled = full[kept].copy()
    for c in set(kept) & set(num):
        scaled[c] = (full[c] - train[c].mean()) / (train[c].std(ddof=0) or 1.0)
    return scaled


def test_equals_pandas(lines, done):
    raw = lines.toPandas()
    raw["late"] = (raw.real_days > raw.scheduled_days).astype(int)
    for name, part in (("year", "year"), ("month", "month"), ("day", "day"), ("weekday", "dayofweek"), ("quarter", "quarter")):
        raw[f"order_{name}"] = getattr(raw.order_ts.dt, part)
    raw = raw.drop(columns=["real_days", "order_ts", *LINE_KEY]).drop_duplicates().drop(columns=["region"])
    rows = done.rows.select("late", "split", vector_to_array(FEATURES).alias("f")).toPandas()
    got = pd.DataFrame(np.vstack(rows.f), columns=done.feature_names)
    assert len(got) == len(raw)
    n_test = int(np.ceil(0.2 * len(raw)))
    assert (rows.split == "test").sum() == n_test
    assert done.rows.select("row_id").distinct().count() == len(raw)
    keyed = prepare_new(lines.drop("real_days"), done.stages, [*LINE_KEY, "sales"]).toPandas()
    full = lines.toPandas().merge(keyed, on=[*LINE_KEY, "sales"])  # two lines share a key
    # equal features lead back to the split of the prepared rows
    side = {tuple(np.round(f, 7)): s for f, s in zip(rows.f, rows.split)}
    full["split"] = [side[tuple(np.round(v.toArray(), 7))] for v in full.features]
    full["late"] = (full.real_days > full.scheduled_days).astype(int)
    for name, part in (("year", "year"), ("month", "month"), ("day", "day"), ("weekday", "dayofweek"), ("quarter", "quarter")):
        full[f"order_{name}"] = getattr(full.order_ts.dt, part)
    vectors, split = full.features, full.split
    plain = full.drop(columns=["real_days", "order_ts", "features", "split", "region", *LINE_KEY])
    want = by_hand(plain, split)
    assert sorted(want.columns) == sorted(done.feature_names)
    have = pd.DataFrame(np.vstack([v.toArray() for v in vectors]), columns=done.feature_names)
    assert np.allclose(have[want.columns], want, atol=1e-8)


def test_train_only_fit_and_bad_options(lines):
    from dataclasses import replace

    with pytest.raises(ValueError, match="fit_rows"):
        prepare(lines, replace(LINES_CONFIG, fit_rows="test"))
    with pytest.raises(ValueError, match="missing required"):
        prepare(lines.drop("real_days"), LINES_CONFIG)
    data = prepare(lines, replace(LINES_CONFIG, fit_rows="train", exact=False))
    assert data.rows.count() > 0 and "sales" in data.feature_names


def test_published_column_names(spark, sf):
    """Order lines under the names of the raw order table, with the default configuration."""
    names = {
        "real_days": fixed.REAL_DAYS, "scheduled_days": fixed.SCHEDULED_DAYS, "priority": "Shipping Mode",
        "market": "Market", "region": "Order City", "segment": "Customer Segment", "product": "Product Name",
        "sales": "Sales", "quantity": "Order Item Quantity", "discount": "Order Item Discount", "l_orderkey": "Order Id",
    }
    lines = order_lines(spark, sf, [*names, "order_ts", "balance"])
    raw = lines.select(
        *[F.col(c).alias(n) for c, n in names.items()],
        F.when(F.col("order_ts").isNotNull(), F.date_format("order_ts", "M/d/yyyy HH:mm")).alias(fixed.ORDER_DATE),
        F.when(F.col("balance") > 5000, F.col("balance")).alias("Order Zipcode"),
        F.when(F.col("quantity") > 10, F.col("quantity")).alias("Days with gaps"),
        F.lit("secret").alias("Customer Password"),
    )
    data = prepare(raw, PrepareConfig(date_format="M/d/yyyy HH:mm"))
    assert data.label == "demora" and "order_year" in data.feature_names
    gone = {"Customer Password", "Order Id", "Order Zipcode", fixed.REAL_DAYS}
    assert not gone & set(data.feature_names)
    assert any(n.startswith("Shipping Mode_") for n in data.feature_names)
    assert "Product Name_Other" in data.feature_names
    values = data.rows.select(F.explode(vector_to_array(FEATURES)).alias("v"))
    assert values.where("v is null or isnan(v)").count() == 0


def test_models_learn_save_and_score_streams(spark, sf, lines, done, tmp_path):
    found = training.train("logistic_regression", done, with_train_rows=True, grid={"C": [0.01], "penalty": ["l1", "l2"], "max_iter": [100]}, folds=2)
    majority = done.test().agg(F.greatest(F.avg("late"), 1 - F.avg("late"))).first()[0]
    assert found.metrics["accuracy"] > majority + 0.1 and found.metrics["roc_auc"] > 0.8
    assert found.features.first()["feature"] == "order_year"
    assert len(found.scores) == 2 and set(found.params) == {"C", "penalty", "max_iter"}
    agree = (F.col("probability") > 0.5).cast("int") == F.col("prediction")
    assert found.predictions.where(~agree).count() == 0

    path = str(tmp_path / "run")
    training.save(found, spark, path)
    save_stages(done.stages, done.feature_names, path)
    assert training.load_params(spark, path) == found.params
    assert spark.read.option("header", True).csv(f"{path}/features").count() == len(done.feature_names)
    stages, names = load_stages(spark, path)
    assert names == done.feature_names
    model = training.load_model(spark, "logistic_regression", path)
    again = training.score_rows(model, done.rows, "logistic_regression", "late")
    assert sorted(again.collect()) == sorted(found.predictions.select(again.columns).collect())

    unseen = lines.drop("real_days")
    source = str(tmp_path / "source")
    unseen.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(unseen.schema).option("maxFilesPerTrigger", 1).parquet(source)
    scored = score_new(stream, stages, model, LINE_KEY)
    write_scores(scored, str(tmp_path / "sink"), str(tmp_path / "check")).awaitTermination(120)
    batch = score_new(unseen, stages, model, LINE_KEY)
    assert sorted(spark.read.parquet(str(tmp_path / "sink")).collect()) == sorted(batch.collect())


def test_boosted_trees_and_comparison(spark, done):
    grid = {"n_estimators": [3], "max_depth": [2, 3], "learning_rate": [0.3], "subsample": [0.8], "colsample_bytree": [0.8]}
    trees = training.train("boosted_trees", done, with_train_rows=True, grid=grid, folds=2)
    assert trees.params["max_depth"] in (2, 3) and len(trees.scores) == 2
    total = trees.features.agg(F.sum("importance")).first()[0]
    assert abs(total - 1) < 1e-9
    knn = training.train("knn", done, grid={"n_neighbors": [3], "weights": ["uniform"], "metric": ["manhattan"]}, folds=2)
    both = trees.predictions.unionByName(knn.predictions)
    table = {r["model"]: r for r in evaluate(both).comparison.collect()}
    assert table["knn"]["train_accuracy"] is None and table["boosted_trees"]["overfitting_gap"] is not None
    with pytest.raises(ValueError, match="unknown model"):
        training.train("svm", done)


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)], "y int")
    weighted = learning.add_class_weight(df, "y")
    sums = {r["y"]: r["s"] for r in weighted.groupBy("y").agg(F.sum("class_weight").alias("s")).collect()}
    assert sums == {0: pytest.approx(5.0), 1: pytest.approx(5.0)}


def test_grid_order():
    points = learning.grid_points({"b": [1, 2], "a": ["x", "y"]})
    assert points == [{"a": "x", "b": 1}, {"a": "x", "b": 2}, {"a": "y", "b": 1}, {"a": "y", "b": 2}]


def test_pruned_preparation(spark, sf):
    """Columns that another one speaks for are left out of the features, and new rows still fit."""
    raw = raw_lines(spark, sf).withColumn("sales_twice", F.col("sales") * 2 + F.col("quantity"))
    whole, pruned = (prepare(raw, replace(LINES_CONFIG, prune_threshold=t, correlation_threshold=1.1)) for t in (None, 0.5))
    gone = set(whole.feature_names) - set(pruned.feature_names)
    assert gone & {"sales", "sales_twice"} and not {"sales", "sales_twice"} <= gone
    assert "scheduled_days" in pruned.feature_names
    assert len(pruned.rows.first()["features"]) == len(pruned.feature_names)
    assert prepare_new(raw.drop("real_days").limit(3), pruned.stages, LINE_KEY).count() == 3


def test_class_weights_of_each_fold(spark):
    """The logistic search weighs a fold's training rows by their own classes."""
    rng = np.random.default_rng(2)
    rows = [(i, Vectors.dense(rng.normal(size=2) + (i % 5 == 0)), int(i % 5 == 0)) for i in range(300)]
    df = spark.createDataFrame(rows, ["row_id", "features", "y"])
    grid = {"C": [0.1, 10.0], "penalty": ["l2"], "max_iter": [50]}
    found = learning.search_logistic(df, "y", ["row_id"], grid=grid)
    folded = learning.stratified_folds(df, "y", ["row_id"], 3)
    for point, score in found.scores:
        own = []
        for f in range(3):
            train = learning.add_class_weight(folded.where(F.col("fold") != f), "y")
            model = learning.logistic(point, train.count(), "features", "y").fit(train)
            own.append(learning.positive_f1("y").evaluate(model.transform(folded.where(F.col("fold") == f))))
        assert abs(score - sum(own) / 3) < 1e-9
    assert found.best_score == max(s for _, s in found.scores)


def test_search_fits_once_what_ended_before_its_last_step(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 3))
    y = (x[:, 0] + rng.normal(scale=0.7, size=300) > 0).astype(int)
    df = spark.createDataFrame([(i, Vectors.dense(v), int(c)) for i, (v, c) in enumerate(zip(x, y))], ["row_id", "features", "y"])
    fits = []
    fit = learning.LogisticRegression.fit
    monkeypatch.setattr(learning.LogisticRegression, "fit", lambda self, data, params=None: fits.append(params) or fit(self, data, params))
    grid = {"C": [0.1, 10.0], "penalty": ["l2"], "max_iter": [1, 200, 500]}
    found = learning.search_logistic(df, "y", ["row_id"], grid=grid)
    assert len(found.scores) == 6
    assert len(fits) == 2 * 3 * 2 + 1  # one step isn't enough, 200 are; the last fit is of the best point
    by_point = {(p["C"], p["max_iter"]): s for p, s in found.scores}
    assert all(by_point[c, 200] == by_point[c, 500] for c in (0.1, 10.0))


def test_lines_joined_in_shares_are_the_same_lines(spark, sf):
    whole = sorted(map(tuple, tables.order_lines(spark, sf, RAW_COLUMNS).collect()))
    read = tables.staged_lines(spark, sf, RAW_COLUMNS, share_bytes=20_000)
    assert sorted(map(tuple, read.collect())) == whole
    shares = [tables.order_lines(spark, sf, ["l_orderkey"], (k, 5)).count() for k in range(5)]
    assert sum(shares) == len(whole) and all(0 < n < len(whole) / 2 for n in shares)


def test_preparation_keeps_no_table_that_nothing_reads(spark, sf, monkeypatch):
    """The distinct rows go when the prepared rows are written; these don't need them."""
    removed = []
    kept = prepare_plan.remove
    monkeypatch.setattr(prepare_plan, "remove", lambda spark, path: removed.append(path) or kept(spark, path))
    done = prepare(raw_lines(spark, sf), LINES_CONFIG)
    assert len(removed) == 1 and "distinct-rows" in removed[0]
    files = spark._jvm.org.apache.hadoop.fs.Path(removed[0])
    assert not files.getFileSystem(spark._jsc.hadoopConfiguration()).exists(files)
    assert done.rows.count() == done.checks.found["rows"]


def test_copies_compared_in_shares_leave_the_same_rows(spark, monkeypatch, lines, done):
    rows = [(i % 4, None if i % 3 else "x", i % 5) for i in range(200)] + [(i, "alone", -1) for i in range(100, 140)]
    df = spark.createDataFrame(rows, "a int, b string, c int").repartition(5)
    parts = cleaning.distinct_parts(df, 3)
    assert len(parts) == 4 and all(p.count() < len(set(rows)) for p in parts)
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r) for p in parts for r in p.collect()), key=key) == sorted(set(rows), key=key)
    monkeypatch.setattr(prepare_plan, "shares_of", lambda *_: 4)
    shared = prepare(lines.unionAll(lines), LINES_CONFIG)
    ids = lambda d: sorted((r["row_id"], r["split"]) for r in d.rows.select("row_id", "split").collect())
    assert ids(shared) == ids(done) and shared.feature_names == done.feature_names
