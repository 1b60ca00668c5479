"""Shared pieces of the SQL that checks the registered queries."""

from __future__ import annotations

from collections.abc import Sequence

from lagline import fixed_values as fixed

CORRELATION_COLUMNS = ["sales", "net_sales", "quantity", "discount", "unit_price", "order_total", "scheduled_days"]

NULL_SOURCE_SQL = """
docs AS (
  SELECT doc_id, lang, source, n_chars, quality, toxic,
         CASE quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor' END AS grade
  FROM documents LEFT JOIN labels USING (doc_id))"""


def split_sql(
    source: str,
    label: str,
    keys: Sequence[str],
    test_size: float = fixed.TEST_SIZE,
    seed: int = fixed.SEED,
) -> str:
    """CTEs ending in ``split``: the source rows with a train/test column."""
    return f"""
split_places AS (
  SELECT *, row_number() OVER (PARTITION BY {label}
            ORDER BY md5(concat_ws('|', {', '.join(keys)}, '{seed}'))) AS split_place FROM {source}),
split_sizes AS (SELECT {label} AS split_label, count(*) AS n FROM {source} GROUP BY {label}),
split_shares AS (
  SELECT split_label, n, sum(n) OVER () - CAST(ceil(round({test_size} * sum(n) OVER (), 9)) AS BIGINT) AS n_train,
         sum(n) OVER () AS n_all FROM split_sizes),
split_train AS (
  SELECT split_label, n, n_train, CAST(floor(n_train * n / n_all) AS BIGINT) AS base,
         n_train * n / n_all - floor(n_train * n / n_all) AS rest FROM split_shares),
split_counts AS (
  SELECT split_label, n, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, split_label)
         <= n_train - sum(base) OVER () THEN 1 ELSE 0 END AS train_rows FROM split_train),
split AS (
  SELECT p.* EXCLUDE (split_place), CASE WHEN split_place <= n - train_rows THEN 'test' ELSE 'train' END AS split
  FROM split_places p JOIN split_counts ON {label} = split_label)"""


def folds_sql(source: str, label: str, keys: Sequence[str], k: int, seed: int = fixed.SEED) -> str:
    """CTEs ending in ``folds``: the source rows with a fold number.

    Sorted labels dealt out in turn fix how many rows of a class each fold gets; within a
    class the folds take consecutive ranges of the hash order.
    """
    return f"""
fold_dealt AS (
  SELECT {label} AS fold_label, (row_number() OVER (ORDER BY {label}) - 1) % {k} AS f FROM {source}),
fold_sizes AS (SELECT fold_label, f, count(*) AS n FROM fold_dealt GROUP BY fold_label, f),
fold_ends AS (
  SELECT fold_label, f, sum(n) OVER (PARTITION BY fold_label ORDER BY f) AS last,
         sum(n) OVER (PARTITION BY fold_label ORDER BY f) - n AS before FROM fold_sizes),
fold_places AS (
  SELECT *, row_number() OVER (PARTITION BY {label}
            ORDER BY md5(concat_ws('|', {', '.join(keys)}, '{seed}'))) AS fold_place FROM {source}),
folds AS (
  SELECT p.* EXCLUDE (fold_place), CAST(f AS INT) AS fold FROM fold_places p JOIN fold_ends
  ON {label} = fold_label AND fold_place > before AND fold_place <= last)"""


# --- neighbours ---------------------------------------------------------------

BINARY_EMBEDDINGS_SQL = f"""
vectors AS (
  SELECT vec_id AS row_id, CAST(embedding AS DOUBLE[]) AS features, CAST(label < 5 AS INT) AS label FROM embeddings),
{split_sql('vectors', 'label', ['row_id'])},
train_rows AS (SELECT * FROM split WHERE split = 'train'),
test_rows AS (SELECT * FROM split WHERE split = 'test')"""

DISTANCE = {
    "euclidean": "list_distance(q.features, t.features)",
    "manhattan": "list_sum(list_transform(list_zip(q.features, t.features), lambda p: abs(p[1] - p[2])))",
}


def knn_vote_sql(metric: str, k: int, weights: str, name: str = "votes") -> str:
    """CTEs ending in ``name``: (row_id, prediction, probability) of the test rows."""
    weight = "1.0"
    if weights == "distance":
        weight = "CASE WHEN min(d) OVER (PARTITION BY row_id) = 0 THEN CAST(d = 0 AS INT) ELSE 1 / nullif(d, 0) END"
    return f"""
{name}_near AS (
  SELECT q.row_id, t.label, {DISTANCE[metric]} AS d, t.row_id AS neighbour FROM test_rows q, train_rows t),
{name}_ranked AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY d, neighbour) AS place FROM {name}_near),
{name}_weighed AS (SELECT row_id, label, CAST({weight} AS DOUBLE) AS w FROM {name}_ranked WHERE place <= {k}),
{name}_sums AS (SELECT row_id, label, sum(w) AS w FROM {name}_weighed GROUP BY row_id, label),
{name} AS (
  SELECT row_id, first(label ORDER BY round(w / total, 12) DESC, label) AS prediction,
         sum(CASE WHEN label = 1 THEN w ELSE 0 END) / sum(w) AS probability
  FROM (SELECT *, sum(w) OVER (PARTITION BY row_id) AS total FROM {name}_sums) GROUP BY row_id)"""


# --- evaluation ---------------------------------------------------------------

CONFUSION_SQL = """
confusion AS (
  SELECT model, count(*) FILTER (label = 0 AND prediction = 0) AS tn,
         count(*) FILTER (label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (label = 1 AND prediction = 0) AS fn,
         count(*) FILTER (label = 1 AND prediction = 1) AS tp
  FROM predictions GROUP BY model)"""

METRICS = {
    "accuracy": "coalesce((tp + tn) / nullif(tp + tn + fp + fn, 0), 0)",
    "precision": "coalesce(tp / nullif(tp + fp, 0), 0)",
    "recall": "coalesce(tp / nullif(tp + fn, 0), 0)",
    "f1_score": "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)",
    "specificity": "coalesce(tn / nullif(tn + fp, 0), 0)",
    "sensitivity": "coalesce(tp / nullif(tp + fn, 0), 0)",
    "hard_roc_auc": "(tp / nullif(tp + fn, 0) + tn / nullif(tn + fp, 0)) / 2",
}


def metrics_columns_sql() -> str:
    return "model, tn, fp, fn, tp, " + ", ".join(f'{e} AS "{n}"' for n, e in METRICS.items())


REPORT_SQL = """
report_classes AS (
  SELECT model, class, sum(support) AS support, sum(predicted) AS predicted, sum(hit) AS hit FROM (
    SELECT model, CAST(label AS VARCHAR) AS class, 1 AS support, 0 AS predicted, CAST(label = prediction AS INT) AS hit FROM predictions
    UNION ALL SELECT model, CAST(prediction AS VARCHAR), 0, 1, 0 FROM predictions) GROUP BY model, class),
report_scores AS (
  SELECT model, class, coalesce(hit / nullif(predicted, 0), 0) AS "precision", coalesce(hit / nullif(support, 0), 0) AS recall,
         coalesce(2 * hit / nullif(support + predicted, 0), 0) AS f1_score, CAST(support AS BIGINT) AS support, hit FROM report_classes),
report AS (
  SELECT model, class, "precision", recall, f1_score, support FROM report_scores
  UNION ALL SELECT model, 'accuracy', sum(hit) / sum(support), sum(hit) / sum(support), sum(hit) / sum(support), CAST(sum(support) AS BIGINT)
    FROM report_scores GROUP BY model
  UNION ALL SELECT model, 'macro avg', avg("precision"), avg(recall), avg(f1_score), CAST(sum(support) AS BIGINT) FROM report_scores GROUP BY model
  UNION ALL SELECT model, 'weighted avg', sum("precision" * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1_score * support) / sum(support), CAST(sum(support) AS BIGINT) FROM report_scores GROUP BY model)"""


def ranking_sql(source: str = "predictions") -> str:
    """CTEs ``steps`` (running totals by probability) and ``ranking`` (AUC and AP)."""
    return f"""
steps AS (
  SELECT model, probability, pos, neg, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg,
         sum(pos) OVER (PARTITION BY model) AS total_pos, sum(neg) OVER (PARTITION BY model) AS total_neg
  FROM (SELECT model, probability, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
        FROM {source} WHERE probability IS NOT NULL GROUP BY model, probability)
  WINDOW w AS (PARTITION BY model ORDER BY probability DESC)),
ranking AS (
  SELECT model, sum(neg * (cum_pos - pos / 2)) / (max(total_pos) * max(total_neg)) AS roc_auc,
         sum(pos / total_pos * cum_pos / (cum_pos + cum_neg)) AS avg_precision
  FROM steps GROUP BY model)"""


COMPARISON_SQL = f"""
test_predictions AS (SELECT * FROM predictions WHERE split = 'test'),
{ranking_sql('test_predictions')},
side_counts AS (
  SELECT model, split, count(*) FILTER (label = 0 AND prediction = 0) AS tn,
         count(*) FILTER (label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (label = 1 AND prediction = 0) AS fn,
         count(*) FILTER (label = 1 AND prediction = 1) AS tp
  FROM predictions GROUP BY model, split),
sides AS (SELECT split, {metrics_columns_sql()} FROM side_counts),
comparison AS (
  SELECT a.model, round(b.accuracy, 4) AS train_accuracy, round(b.f1_score, 4) AS train_f1_score,
         round(a.accuracy, 4) AS test_accuracy, round(a.f1_score, 4) AS test_f1_score,
         round(b.accuracy - a.accuracy, 4) AS overfitting_gap,
         round(a."precision", 4) AS test_precision, round(a.recall, 4) AS test_recall,
         round(a.specificity, 4) AS test_specificity, round(a.sensitivity, 4) AS test_sensitivity,
         round(roc_auc, 4) AS test_roc_auc, round(avg_precision, 4) AS test_avg_precision,
         roc_auc IS NOT NULL AS has_probabilities
  FROM sides a JOIN sides b ON a.model = b.model AND a.split = 'test' AND b.split = 'train'
  LEFT JOIN ranking r ON r.model = a.model)"""

BUSINESS_SQL = f"""
business AS (
  SELECT model, fp AS false_positives, fn AS false_negatives, tp AS true_positives, tn AS true_negatives,
         CAST(fp * {fixed.COST_FALSE_POSITIVE} AS DOUBLE) AS cost_false_positives,
         CAST(fn * {fixed.COST_FALSE_NEGATIVE} AS DOUBLE) AS cost_false_negatives,
         CAST(tp * {fixed.BENEFIT_TRUE_POSITIVE} AS DOUBLE) AS benefit_true_positives,
         CAST(fp * {fixed.COST_FALSE_POSITIVE} + fn * {fixed.COST_FALSE_NEGATIVE} AS DOUBLE) AS total_cost,
         CAST(tp * {fixed.BENEFIT_TRUE_POSITIVE} AS DOUBLE) AS total_benefit,
         CAST(tp * {fixed.BENEFIT_TRUE_POSITIVE} - fp * {fixed.COST_FALSE_POSITIVE} - fn * {fixed.COST_FALSE_NEGATIVE} AS DOUBLE) AS net_business_value,
         coalesce((tp * {fixed.BENEFIT_TRUE_POSITIVE} - fp * {fixed.COST_FALSE_POSITIVE} - fn * {fixed.COST_FALSE_NEGATIVE}) * 100
                  / nullif(fp * {fixed.COST_FALSE_POSITIVE} + fn * {fixed.COST_FALSE_NEGATIVE}, 0), 0) AS roi
  FROM confusion)"""


# --- correlation --------------------------------------------------------------


def correlation_sql(source: str, columns: Sequence[str]) -> str:
    """CTE ``pairs``: (i, j, left, right, r) for i < j."""
    cells = [
        f"""SELECT {i} AS i, {j} AS j, '{a}' AS "left", '{b}' AS "right",
            CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 THEN corr({a}, {b}) END AS r
            FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL"""
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
        if i < j
    ]
    return "pairs AS (" + " UNION ALL ".join(cells) + ")"


def union_sql(columns: Sequence[str], template: str) -> str:
    """The template once per column, ``{c}`` standing for it, glued by UNION ALL."""
    return " UNION ALL ".join(template.replace("{c}", x) for x in columns)
