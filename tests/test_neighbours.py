import numpy as np
import pytest
from pyspark.sql import functions as F

from lagline.operators import learning, neighbours as nn
from lagline.operators.splitting import stratified_folds


def data(seed, n_train=300, n_query=80, dims=3):
    """Clustered points; a third of the training rows are copies of one point."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(scale=4, size=(6, dims))
    train = centres[rng.integers(0, 6, n_train)] + rng.normal(size=(n_train, dims))
    train[: n_train // 3] = train[0]
    queries = centres[rng.integers(0, 6, n_query)] + rng.normal(size=(n_query, dims))
    queries[:20] = train[rng.integers(0, n_train, 20)]  # distance 0
    queries[20:30] = queries[0]
    return train, rng.integers(0, 2, n_train), queries


def frames(spark, train, labels, queries):
    t = [(i, [float(v) for v in x], int(y)) for i, (x, y) in enumerate(zip(train, labels))]
    q = [(i, [float(v) for v in x]) for i, x in enumerate(queries)]
    schema = "row_id long, features array<double>"
    return spark.createDataFrame(t, schema + ", label int"), spark.createDataFrame(q, schema)


def brute_force(train, queries, k, metric, skip=None):
    gap = queries[:, None, :] - train[None, :, :]
    d = np.sqrt((gap**2).sum(-1)) if metric == "euclidean" else np.abs(gap).sum(-1)
    if skip is not None:
        d = np.where(skip, np.inf, d)
    # equal distances may differ in the last digit between two ways of adding
    order = np.array([np.lexsort((np.arange(len(train)), np.round(row, 9))) for row in d])
    return order[:, :k], np.take_along_axis(d, order, 1)[:, :k]


@pytest.mark.parametrize("metric", nn.METRICS)
@pytest.mark.parametrize("block_rows", [16384, 50, 2])
def test_equals_comparing_everything(spark, metric, block_rows):
    train, labels, queries = data(11)
    t, q = frames(spark, train, labels, queries)
    found = nn.nearest_neighbours(t, q, 7, metric, block_rows=block_rows).toPandas()
    ids, dist = brute_force(train, queries, 7, metric)
    assert len(found) == 7 * len(queries)
    for i, rows in found.sort_values("rank").groupby("query"):
        assert rows["neighbour"].tolist() == ids[i].tolist()
        assert np.allclose(rows["distance"], dist[i], atol=1e-9)


def test_fewer_rows_than_neighbours(spark):
    train, labels, queries = data(12, n_train=4)
    t, q = frames(spark, train, labels, queries[:3])
    assert nn.nearest_neighbours(t, q, 9).count() == 12
    assert nn.nearest_neighbours(t, q, 9, block_rows=1).count() == 12


@pytest.mark.parametrize("metric", nn.METRICS)
def test_own_group_is_left_out(spark, metric):
    train, labels, _ = data(13)
    groups = np.arange(len(train)) % 4
    rows = [(i, [float(v) for v in x], int(y), int(g)) for i, (x, y, g) in enumerate(zip(train, labels, groups))]
    t = spark.createDataFrame(rows, "row_id long, features array<double>, label int, fold int")
    found = nn.nearest_neighbours(t, t, 5, metric, leave_out="fold", block_rows=50).toPandas()
    ids, _ = brute_force(train, train, 5, metric, groups[:, None] == groups[None, :])
    for i, part in found.sort_values("rank").groupby("query"):
        assert part["neighbour"].tolist() == ids[i].tolist()


def test_grid_shuffles_few_copies():
    """Blocks are bounded, and the copies sent stay near twice the square root of the blocks."""
    for n_train, n_queries in ((10**6, 10**6), (10**7, 10**4), (300, 90_000), (1, 1)):
        p, q = nn.grid(n_train, n_queries, 16384, 32)
        assert n_train / p <= 16384 and n_queries / q <= 16384
        sent, rows = n_train * q + n_queries * p, (n_train * n_queries) ** 0.5
        assert sent <= 2.9 * rows * (p * q) ** 0.5 or p * q <= 64


def test_no_staged_visits(spark, monkeypatch):
    """Only the two sides are written, each once and without copies."""
    train, labels, queries = data(14, n_train=2000, dims=2)
    t, q = frames(spark, train, labels, queries)
    seen = {}
    stage = nn.stage_table
    monkeypatch.setattr(nn, "stage_table", lambda df, name, *a: seen.setdefault(name, stage(df, name, *a)))
    nn.nearest_neighbours(t, q, 3, block_rows=100).count()
    assert set(seen) == {"knn-train", "knn-queries"}
    assert seen["knn-train"].count() == len(np.unique(train, axis=0))
    assert seen["knn-queries"].count() == len(np.unique(queries, axis=0))


def test_text_keys_and_hot_copies(spark):
    """Keys may be text; of many copies the smallest keys are chosen."""
    rows = [(f"k{i:04d}", [1.0, 2.0], i % 2) for i in range(3000)] + [("a", [5.0, 5.0], 1)]
    t = spark.createDataFrame(rows, "row_id string, features array<double>, label int").repartition(6)
    q = spark.createDataFrame([("q", [1.0, 2.0])], "row_id string, features array<double>")
    found = nn.nearest_neighbours(t, q, 4).orderBy("rank").collect()
    assert [r["neighbour"] for r in found] == ["k0000", "k0001", "k0002", "k0003"]


def test_votes(spark):
    rows = [  # query 1: plain votes; query 2: a neighbour at distance 0; query 3: an even vote
        (1, 1, 1.0, 1), (1, 2, 2.0, 0), (1, 3, 4.0, 0),
        (2, 1, 0.0, 1), (2, 2, 0.1, 0), (2, 3, 0.1, 0),
        (3, 1, 1.0, 1), (3, 2, 1.0, 0),
    ]
    found = spark.createDataFrame(rows, "query long, rank int, distance double, label int")
    uniform = {r["query"]: (r["prediction"], round(r["probability"], 4)) for r in nn.vote(found).collect()}
    assert uniform == {1: (0, 0.3333), 2: (0, 0.3333), 3: (0, 0.5)}
    near = {r["query"]: (r["prediction"], round(r["probability"], 4)) for r in nn.vote(found, "distance").collect()}
    assert near == {1: (1, 0.5714), 2: (1, 1.0), 3: (0, 0.5)}
    every = {(r["query"], r["n_neighbors"], r["weights"]): r["probability"] for r in nn.vote_all(found, [1, 3]).collect()}
    assert every[1, 1, "uniform"] == 1.0 and round(every[1, 3, "distance"], 4) == 0.5714
    assert every[2, 3, "distance"] == 1.0 and every[3, 3, "uniform"] == 0.5


def test_saved_model_gives_the_same_scores(spark, tmp_path):
    train, labels, queries = data(15)
    t, q = frames(spark, train, labels, queries)
    model = nn.KnnClassifier(t, 5, "distance", "manhattan")
    model.save(str(tmp_path / "knn"))
    again = nn.KnnClassifier.load(spark, str(tmp_path / "knn"))
    assert sorted(again.transform(q).collect()) == sorted(model.transform(q).collect())
    assert again.params() == model.params()


def test_search_equals_fitting_every_point(spark):
    """The shared neighbour joins give the fold scores of separate fits."""
    train, _, _ = data(16, n_train=200)
    labels = (train[:, 0] + np.random.default_rng(1).normal(size=len(train)) > 0).astype(int)
    t, _ = frames(spark, train, labels, train[:1])
    grid = {"n_neighbors": [1, 4], "weights": ["uniform", "distance"], "metric": ["manhattan"]}
    scores = {
        (r["n_neighbors"], r["weights"], r["fold"]): r["f1_score"]
        for r in learning.knn_fold_scores(t, "label", ["row_id"], grid=grid, folds=2).collect()
    }
    folded = stratified_folds(t, "label", ["row_id"], 2).cache()
    for k, weights in ((4, "distance"),):
        for fold in range(2):
            model = nn.KnnClassifier(folded.where(F.col("fold") != fold), k, weights, "manhattan")
            held = folded.where(F.col("fold") == fold)
            votes = model.transform(held).join(held.select("row_id", "label"), "row_id").toPandas()
            tp = ((votes.label == 1) & (votes.prediction == 1)).sum()
            f1 = 2 * tp / ((votes.label == 1).sum() + (votes.prediction == 1).sum())
            assert abs(scores[k, weights, fold] - f1) < 1e-12
    found = learning.search_knn(t, "label", ["row_id"], grid=grid, folds=2)
    assert found.best_score == max(s for _, s in found.scores)


@pytest.mark.parametrize("scale", [1.0, 1e-41, 1e20, 1e300])
def test_single_precision_keeps_every_neighbour(scale):
    rng = np.random.default_rng(8)
    b = (1000 + rng.integers(0, 50, (300, 7)) * 1e-4) * scale
    a = (1000 + rng.integers(0, 50, (40, 7)) * 1e-4) * scale
    rough, error = nn._rough_manhattan(a, b)
    exact = nn.distances(a, b, "manhattan")
    assert rough.dtype == (np.float32 if scale < 1e30 else np.float64)
    assert (np.abs(rough - exact) <= error).all()
    i, j, d = nn._closest(a, b, 5, "manhattan", None)
    want = [np.lexsort((np.arange(len(b)), row))[:5] for row in exact]
    assert (j.reshape(-1, 5) == want).all() and (d == exact[i, j]).all()


def test_a_task_has_one_block(spark, monkeypatch):
    seen = nn._block_kernel
    monkeypatch.setattr(nn, "_block_kernel", lambda *given: _with_sizes(seen(*given)))
    train, labels, queries = data(4)
    t, q = frames(spark, train, labels, queries)
    found = nn.nearest_neighbours(t, q, 3, "manhattan", block_rows=50).collect()
    want, _ = brute_force(train, queries, 3, "manhattan")
    assert len(found) == 3 * len(queries)
    assert all(want[r["query"], r["rank"] - 1] == r["neighbour"] for r in found)


def _with_sizes(kernel):
    def run(t, q):
        assert t.num_rows <= 100 and q.num_rows <= 100  # several blocks of 50 points would be more
        return kernel(t, q)

    return run
