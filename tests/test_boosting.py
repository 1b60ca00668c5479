"""Boosted trees against a plain version, and what must not change their results."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lagline.operators import boosting, learning
from lagline.session import scratch_dir

PARAMS = {"n_estimators": 6, "max_depth": 3, "learning_rate": 0.3, "subsample": 1.0, "colsample_bytree": 1.0}


def table(n=600, seed=3):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 9, n), rng.integers(0, 2, n), rng.integers(0, 30, n), np.full(n, 4)]).astype(float)
    y = (x[:, 0] + 5 * x[:, 1] + rng.normal(scale=2, size=n) > 6).astype(int)
    return x, y


def frame(spark, x, y):
    rows = [(i, [float(v) for v in r], int(c), i % 3) for i, (r, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "row_id long, features array<double>, label int, fold int")


def plain_margins(x, y, params):
    """Exact greedy second-order boosting, node by node."""
    margin = np.zeros(len(y))

    def score(g, h):
        return g * g / (h + 1)

    def grow(rows, depth, g, h, out):
        best = (0.0, None, None)
        if depth:
            for f in range(x.shape[1]):
                for cut in np.unique(x[rows, f])[:-1]:
                    left = rows[x[rows, f] <= cut]
                    right = rows[x[rows, f] > cut]
                    if h[left].sum() >= 1 and h[right].sum() >= 1:
                        gain = (score(g[left].sum(), h[left].sum()) + score(g[right].sum(), h[right].sum()) - score(g[rows].sum(), h[rows].sum())) / 2
                        if round(gain, 6) > round(best[0], 6):
                            best = (gain, f, cut)
        if best[1] is None:
            out[rows] = -params["learning_rate"] * g[rows].sum() / (h[rows].sum() + 1)
            return
        side = x[rows, best[1]] <= best[2]
        grow(rows[side], depth - 1, g, h, out)
        grow(rows[~side], depth - 1, g, h, out)

    for _ in range(params["n_estimators"]):
        p = 1 / (1 + np.exp(-margin))
        out = np.zeros(len(y))
        grow(np.arange(len(y)), params["max_depth"], p - y, p * (1 - p), out)
        margin += out
    return margin


def probabilities(model, df):
    scored = model.transform(df).select("row_id", vector_to_array("probability")[1].alias("p"), "prediction")
    return {r["row_id"]: r["p"] for r in scored.collect()}


def test_equals_plain_boosting(spark):
    x, y = table()
    df = frame(spark, x, y).repartition(5)
    got = probabilities(learning.boosted(PARAMS, "features", "label", keys=["row_id"]).fit(df), df)
    want = 1 / (1 + np.exp(-plain_margins(x, y, PARAMS)))
    assert np.allclose([got[i] for i in range(len(y))], want, atol=1e-5)


def test_samples_do_not_depend_on_partitions(spark):
    x, y = table()
    params = PARAMS | {"subsample": 0.7, "colsample_bytree": 0.5}
    trees = [
        learning.boosted(params, "features", "label", keys=["row_id"]).fit(frame(spark, x, y).repartition(n)).getOrDefault("nodes")
        for n in (1, 7)
    ]
    assert trees[0] == trees[1]


def test_folds_grow_as_if_alone(spark):
    x, y = table()
    df = frame(spark, x, y)
    fits = [boosting.Fit(PARAMS, 1), boosting.Fit(PARAMS | {"max_depth": 2, "n_estimators": 3}), boosting.Fit(PARAMS)]
    together = boosting.grow(df, fits, "features", "label", ["row_id"], 42, "fold")
    assert [len(m.trees()) for m in together] == [6, 3, 6]
    # the cut points are those of all rows, so compare on features with few values
    alone = learning.boosted(PARAMS, "features", "label", keys=["row_id"]).fit(df.where("fold <> 1"))
    a, b = probabilities(together[0], df), probabilities(alone, df)
    assert max(abs(a[i] - b[i]) for i in a) < 1e-5


def test_state_is_cut_and_goes_on(spark, monkeypatch):
    x, y = table(200)
    df = frame(spark, x, y)
    whole = learning.boosted(PARAMS, "features", "label", keys=["row_id"]).fit(df).getOrDefault("nodes")
    monkeypatch.setattr(boosting, "CUT_ROUNDS", 2)
    assert learning.boosted(PARAMS, "features", "label", keys=["row_id"]).fit(df).getOrDefault("nodes") == whole


def test_saved_in_a_pipeline(spark, tmp_path):
    x, y = table(200)
    df = frame(spark, x, y)
    model = Pipeline(stages=[learning.boosted(PARAMS, "features", "label")]).fit(df)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert probabilities(again, df) == probabilities(model, df)
    importances = model.stages[0].featureImportances.toArray()
    assert importances.sum() == pytest.approx(1) and importances[3] == 0


def test_odd_values(spark):
    """One class, one row, values that are no numbers, constant features."""
    df = spark.createDataFrame([(i, [float("nan") if i % 2 else 1.0, 2.0], 1) for i in range(20)], "row_id long, features array<double>, label int")
    one_class = learning.boosted(PARAMS, "features", "label", keys=["row_id"]).fit(df)
    assert all(p > 0.5 for p in probabilities(one_class, df).values())
    mixed = df.withColumn("label", F.when(F.isnan(F.col("features")[0]), 0).otherwise(1))
    found = learning.boosted(PARAMS, "features", "label", keys=["row_id"]).fit(mixed)
    assert all((p < 0.5) == (i % 2 == 1) for i, p in probabilities(found, mixed).items())
    with pytest.raises(ValueError, match="no training rows"):
        learning.boosted(PARAMS, "features", "label", keys=["row_id"]).fit(df.where("row_id < 0"))


def test_search_keeps_the_better_point(spark):
    x, y = table()
    grid = {"n_estimators": [2], "max_depth": [1, 3], "learning_rate": [0.3], "subsample": [1.0], "colsample_bytree": [1.0]}
    found = learning.search_boosted(frame(spark, x, y).drop("fold"), "label", ["row_id"], grid=grid)
    assert found.best_score == max(s for _, s in found.scores) > 0.6
    assert len(found.model.trees()) == 2


def test_features_that_never_meet_share_a_column():
    rng = np.random.default_rng(5)
    n, sizes = 500, [9, 3, 3, 3, 256, 1]
    hot = rng.integers(0, 4, n)
    bins = np.stack([rng.integers(0, 9, n), hot == 1, hot == 2, 2 * (hot == 3), rng.integers(0, 256, n), np.zeros(n)]).astype(np.uint8)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    rows = [{"bins": bins.tobytes()}]
    (together,) = boosting._together(iter(rows), len(bins))
    shared = boosting.Shared.of(together > 0, sizes)
    assert len(set(shared.column[1:4])) == 1 and len(shared.offsets) - 1 < len(sizes)
    codes, w, node = shared.codes(bins), rng.integers(0, 1000, n).astype(float), rng.integers(0, 2, n)
    sums = np.zeros((1, 2, shared.offsets[-1]))
    for c in range(len(codes)):
        np.add.at(sums[0], (node, shared.offsets[c] + codes[c]), w)
    got = shared.by_bin(sums, np.arange(len(sizes)), offsets)[0]
    for f in range(len(sizes)):
        plain = np.zeros((2, sizes[f]))
        np.add.at(plain, (node, bins[f]), w)
        assert (got[:, offsets[f] : offsets[f + 1]] == plain).all()


def test_siblings_follow_from_their_parent():
    rng = np.random.default_rng(6)
    left, right = rng.integers(0, 99, (2, 2, 3, 7)).astype(float)
    lighter = np.array([True, False, True])
    summed = np.where(lighter[None, :, None], left, right)
    got = boosting._with_siblings(summed, left + right, lighter)
    assert (got[:, 0::2] == left).all() and (got[:, 1::2] == right).all()


def test_rows_of_codes_walk_as_rows_of_bins():
    rng = np.random.default_rng(7)
    n, sizes = 400, np.array([9, 3, 3, 3, 256])
    hot = rng.integers(0, 4, n)
    bins = np.stack([rng.integers(0, 9, n), hot == 1, 2 * (hot == 2), 2 * (hot == 3), rng.integers(0, 256, n)]).astype(np.uint8)
    (together,) = boosting._together(iter([{"bins": bins.tobytes()}]), len(bins))
    shared = boosting.Shared.of(together > 0, sizes)
    assert len(shared.offsets) - 1 < len(sizes)
    tree = boosting.Tree.empty(5)
    for i in range(25):  # the nodes after these are leaves
        tree.feature[i] = rng.integers(0, len(sizes))
        tree.bin[i] = rng.integers(0, sizes[tree.feature[i]] - 1)
    tree.feature[4] = -1  # a leaf in the middle
    for depth in range(6):
        assert (boosting._walked(shared.codes(bins), boosting._steps(tree, shared, sizes), depth) == tree.leaves(bins, depth)).all()


def test_old_checkpoints_do_not_pile_up(spark, monkeypatch):
    x, y = table(200)
    monkeypatch.setattr(boosting, "CUT_ROUNDS", 2)
    spark.sparkContext.setCheckpointDir(scratch_dir(spark))
    held = spark._jvm.org.apache.hadoop.fs.Path(spark.sparkContext.getCheckpointDir())
    files = held.getFileSystem(spark._jsc.hadoopConfiguration())

    def checkpoints():
        return sum(f.getPath().getName().startswith("rdd-") for f in files.listStatus(held))

    before = checkpoints()
    learning.boosted(PARAMS, "features", "label", keys=["row_id"]).fit(frame(spark, x, y))
    assert checkpoints() == before


def test_small_parts_are_dealt_to_the_cores(spark, monkeypatch):
    """Tasks are as many as cores, however many small files the rows come in."""
    x, y = table(300)
    parts = []
    kept = boosting._held
    monkeypatch.setattr(boosting, "_held", lambda rdd: parts.append(rdd.getNumPartitions()) or kept(rdd))
    df = frame(spark, x, y).repartition(40)
    monkeypatch.setattr(boosting, "stage_table", lambda df, name: df)
    learning.boosted(PARAMS | {"n_estimators": 1}, "features", "label", keys=["row_id"]).fit(df)
    assert set(parts) == {spark.sparkContext.defaultParallelism}
    assert boosting._tasks(spark, 100 * boosting.TASK_BYTES) == 100
