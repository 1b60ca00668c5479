"""Queries on learning and scoring (L), and on saved models."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lagline.operators import learning, splitting
from lagline.operators import neighbours as nn
from lagline.plans import train as train_plan
from lagline.plans.examples import LINES_CONFIG, raw_lines
from lagline.plans.prepare import FEATURES, ROW_ID, SPLIT, prepare, prepare_new
from lagline.queries import register, rounded
from lagline.queries.sql import BINARY_EMBEDDINGS_SQL, DISTANCE, folds_sql, knn_vote_sql, split_sql
from lagline.queries.tables import _binary_embeddings
from lagline.session import scratch_path
from lagline.sources.delimited import write_csv
from lagline.sources.prepared import load_stages, save_stages
from lagline.sources.tables import LINE_KEY, LINES_SQL, read_table, staged_lines
from lagline.streaming.scoring import score_new

# --- nearest neighbours -------------------------------------------------------

VECTORS_SQL = BINARY_EMBEDDINGS_SQL.replace("CAST(label < 5 AS INT) AS label", "label")


def _vectors(spark, sf):
    vectors = read_table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.col("embedding").alias("features"), "label"
    )
    return splitting.stratified_split(vectors, "label", ["row_id"])


def _register_knn(metric: str, weights: str, k: int):
    name = f"l1_knn_{metric}_{weights}"

    @register(
        name,
        f"""WITH {VECTORS_SQL}, {knn_vote_sql(metric, k, weights)}
        SELECT row_id, prediction, round(probability, 6) AS probability FROM votes""",
    )
    def knn(spark, sf):
        rows = _vectors(spark, sf)
        model = nn.KnnClassifier(rows.where("split = 'train'"), k, weights, metric)
        return rounded(model.transform(rows.where("split = 'test'")))

    return knn


for _metric, _weights, _k in (
    ("euclidean", "uniform", 5),
    ("euclidean", "distance", 9),
    ("manhattan", "uniform", 7),
    ("manhattan", "distance", 15),
):
    _register_knn(_metric, _weights, _k)


@register(
    "l1_neighbours_of_all",
    f"""WITH {VECTORS_SQL}, n AS (
      SELECT q.row_id AS query, t.row_id AS neighbour, t.label, {DISTANCE['euclidean']} AS d
      FROM split q, train_rows t),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY d, neighbour) AS INT) AS rank FROM n)
    SELECT query, rank, neighbour, label, round(d, 6) AS distance FROM r WHERE rank <= 3""",
)
def neighbours_of_all(spark, sf):
    rows = _vectors(spark, sf)
    found = nn.nearest_neighbours(rows.where("split = 'train'"), rows, 3)
    return rounded(found.select("query", "rank", "neighbour", "label", "distance"))


def _lines_as_rows(spark, sf):
    """Order lines as vectors of year, scheduled days, quantity and discount."""
    lines = staged_lines(spark, sf, [*LINE_KEY, "order_ts", "scheduled_days", "quantity", "discount", "late"])
    vector = F.array(
        F.year("order_ts").cast("double"),
        F.col("scheduled_days").cast("double"),
        F.col("quantity") / 10,
        F.col("discount") * 10,
    )
    rows = lines.select(F.concat_ws("-", *LINE_KEY).alias("row_id"), vector.alias("features"), F.col("late").alias("label"))
    return splitting.stratified_split(rows, "label", ["row_id"])


@register("l1_knn_order_lines")
def knn_order_lines(spark, sf):
    """Late lines by their 15 nearest: many copies of few points, in hot cells."""
    rows = _lines_as_rows(spark, sf)
    model = nn.KnnClassifier(rows.where("split = 'train'"), 15, "distance", "manhattan")
    return rounded(learning.score_knn(model, rows.where("split = 'test'"), "knn", "label", ["row_id"]))


POINT_NUMBERS = ["scheduled_days", "order_year", "order_month", "order_weekday"]
POINT_FLAGS = [("market", v) for v in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")] + [
    ("segment", v) for v in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
]
POINT_CONTENT = ["scheduled_days", "market", "segment", "order_year", "order_month", "order_day", "order_weekday", "order_quarter"]
POINT_SLOTS = [*POINT_NUMBERS, *[f"{c}_{v[:4]}" for c, v in POINT_FLAGS]]


def _reach_sql(c: str) -> str:
    return f"quantile_cont(CAST({c} AS DOUBLE), 0.25) AS {c}_1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS {c}_3"


def _capped_sql(c: str) -> str:
    return f"least(greatest({c}, {c}_1 - 1.5 * ({c}_3 - {c}_1)), {c}_3 + 1.5 * ({c}_3 - {c}_1)) AS {c}"


# The whole preparation of distinct order points, ending in ``test_rows`` and ``train_rows`` with a column per slot.
POINTS_SQL = f"""
{LINES_SQL},
moved AS (SELECT *, date_trunc('quarter', order_ts) AS quarter_ts FROM lines),
parts AS (
  SELECT DISTINCT scheduled_days, market, segment, late, year(quarter_ts) AS order_year, month(quarter_ts) AS order_month,
         day(quarter_ts) AS order_day, isodow(quarter_ts) - 1 AS order_weekday, quarter(quarter_ts) AS order_quarter FROM moved),
keyed AS (SELECT *, md5(concat_ws('|', {', '.join(POINT_CONTENT)}, late, '42')) AS row_id FROM parts),
{split_sql('keyed', 'late', ['row_id'])},
reach AS (SELECT {', '.join(_reach_sql(c) for c in POINT_NUMBERS)} FROM split),
capped AS (SELECT row_id, split, late AS label, market, segment, {', '.join(_capped_sql(c) for c in POINT_NUMBERS)} FROM split, reach),
scale AS (SELECT {', '.join(f'avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s' for c in POINT_NUMBERS)} FROM capped WHERE split = 'train'),
slots AS (
  SELECT row_id, split, label, {', '.join(f'round(({c} - {c}_m) / {c}_s, 6) AS {c}' for c in POINT_NUMBERS)},
         {', '.join(f"CAST({c} = '{v}' AS DOUBLE) AS {c}_{v[:4]}" for c, v in POINT_FLAGS)} FROM capped, scale),
train_rows AS (SELECT * FROM slots WHERE split = 'train'),
test_rows AS (SELECT * FROM slots WHERE split = 'test')"""

POINT_DISTANCE = {
    "manhattan": " + ".join(f"abs(q.{c} - t.{c})" for c in POINT_SLOTS),
    "euclidean": "sqrt(" + " + ".join(f"(q.{c} - t.{c}) * (q.{c} - t.{c})" for c in POINT_SLOTS) + ")",
}


def _raw_points(spark, sf, keys=()):
    raw = staged_lines(spark, sf, [*keys, "real_days", "scheduled_days", "order_ts", "market", "segment"])
    return raw.withColumn("order_ts", F.date_trunc("quarter", "order_ts"))


def _fitted_points(spark, sf):
    return prepare(_raw_points(spark, sf), replace(LINES_CONFIG, drop=["real_days"], drop_geography=[]))


def _points(spark, sf):
    """Distinct order points (quarter, scheduled days, market, segment, label) by the whole preparation."""
    slots = F.transform(vector_to_array(FEATURES), lambda x: F.round(x, 6) + F.lit(0.0)).alias("features")
    return _fitted_points(spark, sf).rows.select(ROW_ID, SPLIT, F.col("late").alias("label"), slots)


@register(
    "l1_knn_prepared",
    f"""WITH {POINTS_SQL}, {knn_vote_sql('manhattan', 15, 'distance').replace(DISTANCE['manhattan'], POINT_DISTANCE['manhattan'])}
    SELECT row_id, prediction, round(probability, 6) AS probability FROM votes""",
)
def knn_prepared(spark, sf):
    """The published neighbour parameters on prepared features."""
    rows = _points(spark, sf)
    model = nn.KnnClassifier(rows.where("split = 'train'"), 15, "distance", "manhattan")
    return rounded(model.transform(rows.where("split = 'test'")))


KNN_VOTES_SQL = f"WITH {POINTS_SQL}, {knn_vote_sql('manhattan', 15, 'distance').replace(DISTANCE['manhattan'], POINT_DISTANCE['manhattan'])}"


def _scored_points(spark, sf):
    rows = _points(spark, sf)
    model = nn.KnnClassifier(rows.where("split = 'train'"), 15, "distance", "manhattan")
    return learning.score_knn(model, rows.where("split = 'test'"), "knn", "label", [ROW_ID])


@register(
    "l7_knn_predictions",
    f"{KNN_VOTES_SQL} SELECT label, CAST(prediction AS INT) AS prediction, count(*) AS n FROM votes JOIN test_rows USING (row_id) GROUP BY ALL",
)
def knn_predictions(spark, sf):
    """Hard predictions of the neighbour model beside the true classes."""
    return _scored_points(spark, sf).groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


@register(
    "l8_knn_probabilities",
    f"""{KNN_VOTES_SQL} SELECT CAST(prediction AS INT) AS prediction, count(*) AS n, round(min(probability), 6) AS lowest,
      round(avg(probability), 6) AS mean, round(max(probability), 6) AS highest FROM votes GROUP BY prediction""",
)
def knn_probabilities(spark, sf):
    """Positive-class probabilities of the neighbour model by predicted class."""
    p = F.col("probability")
    stats = [F.count(p).alias("n"), F.min(p).alias("lowest"), F.avg(p).alias("mean"), F.max(p).alias("highest")]
    return rounded(_scored_points(spark, sf).groupBy("prediction").agg(*stats))


# --- class weights and folds --------------------------------------------------


@register(
    "l3_class_weights",
    """SELECT toxic AS label, count(*) AS n,
       round((SELECT count(*) / count(DISTINCT toxic) FROM labels) / count(*), 6) AS weight FROM labels GROUP BY toxic""",
)
def class_weights(spark, sf):
    return rounded(learning.class_weights(read_table(spark, sf, "labels"), "toxic"))


@register(
    "l3_weighted_rows",
    """WITH w AS (SELECT toxic, (SELECT count(*) / count(DISTINCT toxic) FROM labels) / count(*) AS weight FROM labels GROUP BY toxic)
    SELECT doc_id, toxic, round(weight, 6) AS class_weight FROM labels JOIN w USING (toxic)""",
)
def weighted_rows(spark, sf):
    labels = read_table(spark, sf, "labels").select("doc_id", "toxic")
    return rounded(learning.add_class_weight(labels, "toxic"))


@register(
    "l5_folds_of_five",
    f"WITH {folds_sql('labels', 'toxic', ['doc_id'], 5)} SELECT doc_id, toxic, fold FROM folds",
)
def folds_of_five(spark, sf):
    labels = read_table(spark, sf, "labels").select("doc_id", "toxic")
    return splitting.stratified_folds(labels, "toxic", ["doc_id"], 5)


@register(
    "l5_folds_of_three",
    f"""WITH {LINES_SQL}, {folds_sql('lines', 'late', LINE_KEY, 3)}
    SELECT late, fold, count(*) AS n, round(avg(sales), 6) AS mean_sales FROM folds GROUP BY late, fold""",
)
def folds_of_three(spark, sf):
    lines = staged_lines(spark, sf, [*LINE_KEY, "late", "sales"])
    folded = splitting.stratified_folds(lines, "late", LINE_KEY, 3)
    counted = folded.groupBy("late", "fold").agg(F.count(F.lit(1)).alias("n"), F.avg("sales").alias("mean_sales"))
    return rounded(counted)


# --- searches -----------------------------------------------------------------


def _grid_scores_sql(ks: list[int], rows: str = BINARY_EMBEDDINGS_SQL, distance: dict[str, str] = DISTANCE) -> str:
    """F1 per metric, k, voting and fold over the training rows, own fold left out."""
    near = " UNION ALL ".join(
        f"""SELECT '{m}' AS metric, q.row_id, q.fold, q.label AS truth, t.label, t.row_id AS neighbour, {d} AS d
        FROM folds q JOIN folds t ON q.fold <> t.fold"""
        for m, d in distance.items()
    )
    grid = " UNION ALL ".join(f"SELECT {k} AS k" for k in ks)
    return f"""
    WITH {rows}, {folds_sql('train_rows', 'label', ['row_id'], 5)}, near AS ({near}),
    placed AS (SELECT *, row_number() OVER (PARTITION BY metric, row_id ORDER BY d, neighbour) AS place FROM near),
    top AS (SELECT p.*, k FROM placed p JOIN ({grid}) g ON place <= k),
    weighed AS (
      SELECT *, 1.0 AS uniform, CAST(CASE WHEN min(d) OVER (PARTITION BY metric, row_id, k) = 0 THEN CAST(d = 0 AS INT)
             ELSE 1 / nullif(d, 0) END AS DOUBLE) AS distance FROM top),
    votes AS (
      SELECT metric, row_id, fold, truth, k, 'uniform' AS weights, sum(uniform * label) / sum(uniform) AS p
      FROM weighed GROUP BY ALL
      UNION ALL SELECT metric, row_id, fold, truth, k, 'distance', sum(distance * label) / sum(distance) FROM weighed GROUP BY ALL)
    SELECT metric, CAST(k AS INT) AS n_neighbors, weights, fold,
      round(coalesce(2.0 * count(*) FILTER (truth = 1 AND round(p, 12) > 0.5) / nullif(count(*) FILTER (truth = 1) + count(*) FILTER (round(p, 12) > 0.5), 0), 0), 6) AS f1_score
    FROM votes GROUP BY metric, k, weights, fold"""


@register("l6_knn_grid_scores", _grid_scores_sql([3, 5, 7, 9, 11, 15, 20]))
def knn_grid_scores(spark, sf):
    """The whole neighbour grid, five folds: one neighbour join per metric."""
    train = _binary_embeddings(spark, sf).where("split = 'train'")
    return rounded(learning.knn_fold_scores(train, "label", ["row_id"]))


PREPARED_GRID = {"metric": ["manhattan"], "n_neighbors": [3, 5, 7, 9, 11, 15, 20], "weights": ["uniform", "distance"]}


@register("l6_knn_prepared_scores", _grid_scores_sql(PREPARED_GRID["n_neighbors"], POINTS_SQL, {"manhattan": POINT_DISTANCE["manhattan"]}))
def knn_prepared_scores(spark, sf):
    """Fold scores of the neighbour grid on prepared features, one distance."""
    train = _points(spark, sf).where("split = 'train'")
    return rounded(learning.knn_fold_scores(train, "label", [ROW_ID], grid=PREPARED_GRID))


def _prepared(spark, sf):
    return prepare(raw_lines(spark, sf), LINES_CONFIG)


LOGISTIC_PARAMS = {"C": 0.001, "penalty": "l1", "max_iter": 200}
BOOSTED_PARAMS = {"n_estimators": 200, "max_depth": 5, "learning_rate": 0.1, "subsample": 0.8, "colsample_bytree": 0.8}


@register("l2_logistic_regression")
def logistic_regression(spark, sf):
    """Balanced logistic regression with the published parameters; scored test rows."""
    data = _prepared(spark, sf)
    model = _fit_logistic(data)
    return rounded(learning.score(model, data.test(), "logistic_regression", data.label, [ROW_ID, SPLIT]))


def _fit_logistic(data):
    train = learning.add_class_weight(data.train(), data.label)
    return learning.logistic(LOGISTIC_PARAMS, train.count(), FEATURES, data.label).fit(train)


def _fit_boosted(data):
    return learning.boosted(BOOSTED_PARAMS, FEATURES, data.label, keys=[ROW_ID]).fit(data.train())


@register("l4_boosted_trees")
def boosted_trees(spark, sf):
    """Boosted trees with the published number of rounds; scored test rows."""
    data = _prepared(spark, sf)
    return rounded(learning.score(_fit_boosted(data), data.test(), "boosted_trees", data.label, [ROW_ID, SPLIT]))


def _one_round_sql(depth: int) -> str:
    """One tree from margins of 0: the best cut of every node by second-order gain, level by level."""
    names = [*POINT_NUMBERS, *[f"{c}_{v}" for c, v in POINT_FLAGS]]
    parts = [f"WITH {POINTS_SQL}, rows_0 AS (SELECT *, 0 AS node FROM train_rows)"]
    for level in range(depth):
        long = " UNION ALL ".join(
            f"SELECT node, {i} AS f, {c} AS v, sum(0.5 - label) AS g, 0.25 * count(*) AS h FROM rows_{level} GROUP BY node, {c}"
            for i, c in enumerate(POINT_SLOTS)
        )
        chosen = " ".join(f"WHEN {i} THEN r.{c}" for i, c in enumerate(POINT_SLOTS))
        parts.append(f"""
        sums_{level} AS (
          SELECT *, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER (PARTITION BY node, f) AS ga, sum(h) OVER (PARTITION BY node, f) AS ha
          FROM ({long}) WINDOW w AS (PARTITION BY node, f ORDER BY v)),
        gains_{level} AS (
          SELECT *, round((gl * gl / (hl + 1) + (ga - gl) * (ga - gl) / (ha - hl + 1) - ga * ga / (ha + 1)) / 2, 9) AS gain
          FROM sums_{level} WHERE hl >= 1 AND ha - hl >= 1),
        best_{level} AS (
          SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, v) AS place FROM gains_{level})
          WHERE place = 1 AND gain > 0),
        rows_{level + 1} AS (
          SELECT r.* EXCLUDE (node), 2 * r.node + 1 + CAST(CASE f {chosen} END > v AS INT) AS node
          FROM rows_{level} r JOIN best_{level} b ON r.node = b.node)""")
    nodes = " UNION ALL ".join(f"SELECT node, sum(0.5 - label) AS g, 0.25 * count(*) AS h FROM rows_{i} GROUP BY node" for i in range(depth + 1))
    cuts = " UNION ALL ".join(f"SELECT node, f, v, gain FROM best_{i}" for i in range(depth))
    feature = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names))
    return ", ".join(parts) + f""", nodes AS ({nodes}), cuts AS ({cuts})
    SELECT CAST(0 AS INT) AS tree, CAST(n.node AS INT) AS node, CASE f {feature} END AS feature,
           v AS threshold, round(gain, 6) AS gain, round(-0.1 * g / (h + 1), 6) AS value
    FROM nodes n LEFT JOIN cuts c ON n.node = c.node"""


@register("l4_one_round", _one_round_sql(3))
def one_round(spark, sf):
    """The first tree on prepared points, without samples: its cuts, gains and leaf values."""
    train = _points(spark, sf).where("split = 'train'")
    params = {"n_estimators": 1, "max_depth": 3, "learning_rate": 0.1, "subsample": 1.0, "colsample_bytree": 1.0}
    model = learning.boosted(params, FEATURES, "label", keys=[ROW_ID]).fit(train)
    names = [*POINT_NUMBERS, *[f"{c}_{v}" for c, v in POINT_FLAGS]]
    return rounded(model.tree_table(train, names))


IMPORTANCES_SQL = f"""WITH tree AS ({_one_round_sql(3)}), means AS (SELECT feature, avg(gain) AS gain FROM tree WHERE feature IS NOT NULL GROUP BY feature),
    names AS (SELECT unnest([{', '.join(f"'{n}'" for n in [*POINT_NUMBERS, *[f'{c}_{v}' for c, v in POINT_FLAGS]])}]) AS feature)
    SELECT feature, round(coalesce(gain / (SELECT sum(gain) FROM means), 0), 4) AS importance FROM names LEFT JOIN means USING (feature)"""


def _one_round_importances(spark, sf):
    train = _points(spark, sf).where("split = 'train'")
    params = {"n_estimators": 1, "max_depth": 3, "learning_rate": 0.1, "subsample": 1.0, "colsample_bytree": 1.0}
    model = learning.boosted(params, FEATURES, "label", keys=[ROW_ID]).fit(train)
    return learning.importance_table(model, [*POINT_NUMBERS, *[f"{c}_{v}" for c, v in POINT_FLAGS]], train)


@register("l10_one_round_importances", IMPORTANCES_SQL)
def one_round_importances(spark, sf):
    """Mean gains of the first tree's features, as shares."""
    return rounded(_one_round_importances(spark, sf), 4)


@register("s8_importances_saved", IMPORTANCES_SQL)
def importances_saved(spark, sf):
    """The importance table written as text and read again."""
    table, path = _one_round_importances(spark, sf), scratch_path(spark, "importances")
    write_csv(table, path)
    return rounded(spark.read.option("header", True).schema(table.schema).csv(path), 4)


@register("f10_prepared_points", f"WITH {POINTS_SQL} SELECT row_id, split, label, [{', '.join(POINT_SLOTS)}]::VARCHAR AS features FROM slots")
def prepared_points(spark, sf):
    """Every slot of the whole preparation of distinct order points."""
    return _points(spark, sf).select(ROW_ID, SPLIT, "label", _shown("features"))


NEW_LINES_SQL = f"""WITH {POINTS_SQL}, new_parts AS (
      SELECT *, year(quarter_ts) AS order_year, month(quarter_ts) AS order_month, isodow(quarter_ts) - 1 AS order_weekday FROM moved),
    new_capped AS (SELECT {', '.join(LINE_KEY)}, market, segment, {', '.join(_capped_sql(c) for c in POINT_NUMBERS)} FROM new_parts, reach),
    new_slots AS (SELECT {', '.join(LINE_KEY)}, {', '.join(f'round(({c} - {c}_m) / {c}_s, 6) AS {c}' for c in POINT_NUMBERS)},
      {', '.join(f"CAST({c} = '{v}' AS DOUBLE) AS {c}_{v[:4]}" for c, v in POINT_FLAGS)} FROM new_capped, scale)
    SELECT {', '.join(LINE_KEY)}, [{', '.join(POINT_SLOTS)}]::VARCHAR AS features FROM new_slots"""


def _shown(features: str):
    """Numbers of a vector as text, in the form that the SQL gives them."""
    return F.concat(F.lit("["), F.array_join(F.transform(features, lambda x: x.cast("string")), ", "), F.lit("]")).alias("features")


@register("f9_new_points_prepared", NEW_LINES_SQL)
def new_points_prepared(spark, sf):
    """All order lines without their outcome, prepared by the stages fitted on distinct points."""
    stages = _fitted_points(spark, sf).stages
    unseen = _raw_points(spark, sf, LINE_KEY).drop("real_days")
    vectors = prepare_new(unseen, stages, LINE_KEY)
    vectors = vectors.withColumn("features", F.transform(vector_to_array("features"), lambda x: F.round(x, 6) + F.lit(0.0)))
    return vectors.select(*LINE_KEY, _shown("features"))


@register("l6_boosted_search")
def boosted_search(spark, sf):
    """Cross-validated F1 of every point of the boosting grid, all rounds."""
    data = _prepared(spark, sf)
    found = learning.search_boosted(data.train(), data.label, [ROW_ID])
    rows = [(int(p["n_estimators"]), int(p["max_depth"]), float(s)) for p, s in found.scores]
    return rounded(spark.createDataFrame(rows, "n_estimators int, max_depth int, f1_score double"), 4)


@register("l6_logistic_search")
def logistic_search(spark, sf):
    """Cross-validated F1 of every point of the grid."""
    data = _prepared(spark, sf)
    found = learning.search_logistic(data.train(), data.label, [ROW_ID])
    rows = [(float(p["C"]), int(p["max_iter"]), p["penalty"], float(s)) for p, s in found.scores]
    return rounded(spark.createDataFrame(rows, "C double, max_iter int, penalty string, f1_score double"), 4)


@register("l7_hard_predictions")
def hard_predictions(spark, sf):
    """Predictions per class of the logistic model beside the true classes."""
    data = _prepared(spark, sf)
    scored = learning.score(_fit_logistic(data), data.test(), "logistic_regression", data.label)
    return scored.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


@register("l8_probabilities")
def probabilities(spark, sf):
    """Positive-class probabilities, and that 0.5 separates the predictions."""
    data = _prepared(spark, sf)
    scored = learning.score(_fit_logistic(data), data.test(), "logistic_regression", data.label)
    agrees = (F.col("probability") > 0.5).cast("int") == F.col("prediction")
    return rounded(
        scored.groupBy("prediction").agg(
            F.count("probability").alias("n"),
            F.min("probability").alias("lowest"),
            F.max("probability").alias("highest"),
            F.min(agrees.cast("int")).alias("all_agree"),
        )
    )


@register("l9_coefficients")
def coefficients(spark, sf):
    data = _prepared(spark, sf)
    return rounded(learning.coefficient_table(_fit_logistic(data), data.feature_names, data.rows), 4)


@register("l10_importances")
def importances(spark, sf):
    data = _prepared(spark, sf)
    return rounded(learning.importance_table(_fit_boosted(data), data.feature_names, data.rows), 4)


@register("s8_coefficients_saved")
def coefficients_saved(spark, sf):
    data = _prepared(spark, sf)
    table = learning.coefficient_table(_fit_logistic(data), data.feature_names, data.rows)
    path = scratch_path(spark, "coefficients")
    write_csv(table, path)
    return rounded(spark.read.option("header", True).schema(table.schema).csv(path), 4)


@register("s10_saved_stages_score_new_rows")
def saved_stages_score_new_rows(spark, sf):
    """Preparation and model saved, loaded and applied to raw lines without outcome."""
    raw = raw_lines(spark, sf)
    data = prepare(raw, LINES_CONFIG)
    path = scratch_path(spark, "logistic")
    save_stages(data.stages, data.feature_names, path)
    PipelineModel([_fit_logistic(data)]).write().overwrite().save(f"{path}/model")
    stages, _ = load_stages(spark, path)
    model = train_plan.load_model(spark, "saved", path)
    return rounded(score_new(raw.drop("real_days"), stages, model, LINE_KEY))
