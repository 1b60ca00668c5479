"""Queries on sources, sinks, projections, dates, sorting (S, P, D, T)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from lagline.functions import columns as c
from lagline.functions import dates, labels
from lagline.operators import (
    cleaning,
    contingency,
    correlation,
    evaluation,
    features,
    learning,
    profiling,
    splitting,
)
from lagline.operators import neighbours as nn
from lagline.plans import evaluate as ev_plan
from lagline.plans import train as train_plan
from lagline.plans.examples import PREDICTIONS_SQL, example_predictions
from lagline.queries import register, rounded
from lagline.queries.sql import (
    BINARY_EMBEDDINGS_SQL,
    BUSINESS_SQL,
    COMPARISON_SQL,
    CONFUSION_SQL,
    CORRELATION_COLUMNS,
    NULL_SOURCE_SQL,
    REPORT_SQL,
    correlation_sql,
    knn_vote_sql,
    metrics_columns_sql,
    split_sql,
)
from lagline.session import scratch_path, stage_table
from lagline.sources import delimited, prepared
from lagline.sources.tables import LINE_KEY, LINES_SQL, order_lines, read_table, staged_lines

# --- sources and sinks --------------------------------------------------------

ORDER_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"


@register(
    "s1_delimited_scan",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
)
def delimited_scan(spark, sf):
    """Orders written as ';' text with padded names, found and read again by probing."""
    orders = read_table(spark, sf, "orders").drop("o_orderdate")
    path = scratch_path(spark, "orders-text")
    padded = orders.toDF(*[f" {n} " for n in orders.columns])
    padded.write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").csv(path)
    return delimited.read_delimited(spark, path, ORDER_SCHEMA)


QUOTED_COLUMNS = ["doc_id", "source", "text"]
SPLITS_A_FILE = 4
QUOTED_SCHEMA = "doc_id bigint, source string, text string"


def _quoted_file(spark, sf, encoding):
    """Documents in files of quoted text, line breaks inside; one file of every ``SPLITS_A_FILE`` splits of the table.

    So a small table is one file, a large one makes files that several tasks read, and no task writes more than its share.
    """
    path = scratch_path(spark, "quoted-text")
    docs = read_table(spark, sf, "documents").select(*QUOTED_COLUMNS)
    docs = docs.coalesce(max(1, docs.rdd.getNumPartitions() // SPLITS_A_FILE))
    options = {"header": True, "sep": ";", "quoteAll": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    docs.write.options(**options).option("encoding", encoding).csv(path)
    return path


@register("s1_quoted_text", "SELECT doc_id, source, nullif(text, '') AS text FROM documents")
def quoted_text(spark, sf):
    """All documents written as quoted files and read again, each file by many tasks; the dialect is probed."""
    return delimited.read_delimited(spark, _quoted_file(spark, sf, "UTF-8"), QUOTED_SCHEMA)


@register("s1_late_bytes", r"SELECT doc_id, source, regexp_replace(nullif(text, ''), '[^\x00-\xFF]', '?', 'g') AS text FROM documents")
def late_bytes(spark, sf):
    """The same in one-byte characters, of which the header has none: the probe looks at all bytes."""
    return delimited.read_delimited(spark, _quoted_file(spark, sf, "ISO-8859-1"), QUOTED_SCHEMA)


@register("s2_trimmed_names", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def trimmed_names(spark, sf):
    nation = read_table(spark, sf, "nation")
    return c.trim_column_names(nation.toDF(*[f"  {n} " for n in nation.columns]))


def _split_lines(spark, sf, *columns):
    lines = staged_lines(spark, sf, [*LINE_KEY, "late", *columns])
    return splitting.stratified_split(lines, "late", LINE_KEY)


SPLIT_LINES_SQL = f"WITH {LINES_SQL}, {split_sql('lines', 'late', LINE_KEY)}"


@register(
    "s3_prepared_scan",
    f"""{SPLIT_LINES_SQL}
    SELECT late, priority, count(*) AS n, round(avg(quantity), 6) AS mean_quantity
    FROM split WHERE split = 'train' GROUP BY late, priority""",
)
def prepared_scan(spark, sf):
    """Write rows by split and read the training part alone (a pruned folder)."""
    path = scratch_path(spark, "lines-prepared")
    prepared.write_prepared(_split_lines(spark, sf, "priority", "quantity"), path)
    train = prepared.read_prepared(spark, path, "train")
    counted = train.groupBy("late", "priority").agg(
        F.count(F.lit(1)).alias("n"), F.avg("quantity").alias("mean_quantity")
    )
    return rounded(counted)


@register(
    "s4_no_train_rows",
    f"""WITH {LINES_SQL}, {PREDICTIONS_SQL}
    SELECT model, CAST(NULL AS DOUBLE) AS train_accuracy, CAST(NULL AS DOUBLE) AS overfitting_gap,
           round(avg(CAST(label = prediction AS INT)), 6) AS test_accuracy
    FROM predictions WHERE split = 'test' GROUP BY model""",
)
def no_train_rows(spark, sf):
    """Without training rows the evaluation still runs; train metrics are missing."""
    test = example_predictions(spark, sf).where("split = 'test'")
    gap = evaluation.overfitting_gap(test)
    return rounded(gap.select("model", "train_accuracy", "overfitting_gap", "test_accuracy"))


@register(
    "s5_write_splits",
    f"""{SPLIT_LINES_SQL}
    SELECT split, late, count(*) AS n, round(sum(quantity), 2) AS quantity FROM split GROUP BY split, late""",
)
def write_splits(spark, sf):
    path = scratch_path(spark, "lines-splits")
    prepared.write_prepared(_split_lines(spark, sf, "quantity"), path)
    back = prepared.read_prepared(spark, path)
    return back.groupBy("split", "late").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("quantity"), 2).alias("quantity")
    )


SCALED = ["sales", "quantity", "discount"]


@register(
    "s6_scaler_saved_and_loaded",
    f"""WITH {LINES_SQL}, s AS (SELECT {', '.join(f'avg({x}) AS {x}_m, stddev_pop({x}) AS {x}_s' for x in SCALED)} FROM lines)
    SELECT priority, {', '.join(f'round(avg(({x} - {x}_m) / {x}_s), 6) AS {x}' for x in SCALED)}
    FROM lines, s GROUP BY priority""",
)
def scaler_saved_and_loaded(spark, sf):
    lines = staged_lines(spark, sf, ["priority", *SCALED])
    path = scratch_path(spark, "scaler")
    fitted = PipelineModel([features.Standardizer(columns=SCALED).fit(lines)])
    prepared.save_stages(fitted, SCALED, path)
    stages, names = prepared.load_stages(spark, path)
    scaled = stages.transform(lines)
    return rounded(scaled.groupBy("priority").agg(*[F.avg(n).alias(n) for n in names]))


def _binary_embeddings(spark, sf):
    vectors = read_table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.col("embedding").alias("features"), (F.col("label") < 5).cast("int").alias("label")
    )
    return splitting.stratified_split(vectors, "label", ["row_id"])


def _knn_and_test_rows(spark, sf):
    rows = _binary_embeddings(spark, sf)
    return nn.KnnClassifier(rows.where("split = 'train'"), 5, "distance", "manhattan"), rows.where("split = 'test'")


KNN_TEST_SQL = f"WITH {BINARY_EMBEDDINGS_SQL}, {knn_vote_sql('manhattan', 5, 'distance')}"


@register(
    "s7_model_params_and_metrics_saved",
    f"""{KNN_TEST_SQL},
    predictions AS (SELECT 'knn' AS model, t.label, v.prediction FROM votes v JOIN test_rows t ON t.row_id = v.row_id),
    {CONFUSION_SQL}, m AS (SELECT {metrics_columns_sql()} FROM confusion)
    SELECT 'manhattan' AS metric, CAST(5 AS BIGINT) AS n_neighbors, 'distance' AS weights,
           round(accuracy, 6) AS accuracy, round("precision", 6) AS "precision",
           round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, round(hard_roc_auc, 6) AS roc_auc
    FROM m""",
)
def model_params_and_metrics_saved(spark, sf):
    model, test = _knn_and_test_rows(spark, sf)
    predictions = learning.score_knn(model, test, "knn", "label", ["split"])
    metrics = train_plan.test_metrics(predictions, by_probability=False)
    path = scratch_path(spark, "knn-run")
    train_plan.save(train_plan.Trained("knn", model, model.params(), 0.0, metrics, predictions), spark, path)
    saved = {**train_plan.load_params(spark, path), **delimited.read_json_object(spark, f"{path}/metrics")}
    return rounded(spark.createDataFrame([saved]))


@register(
    "s9_comparison_saved",
    f"WITH {LINES_SQL}, {PREDICTIONS_SQL}, {COMPARISON_SQL} SELECT * FROM comparison",
)
def comparison_saved(spark, sf):
    table = evaluation.comparison_table(example_predictions(spark, sf))
    path = scratch_path(spark, "comparison")
    delimited.write_csv(table, path)
    return spark.read.option("header", True).schema(table.schema).csv(path)


@register(
    "s10_model_loaded_and_scored",
    f"{KNN_TEST_SQL} SELECT row_id, prediction, round(probability, 6) AS probability FROM votes",
)
def model_loaded_and_scored(spark, sf):
    model, test = _knn_and_test_rows(spark, sf)
    path = scratch_path(spark, "knn-model")
    model.save(path)
    return rounded(nn.KnnClassifier.load(spark, path).transform(test))


@register(
    "s11_detailed_reports",
    f"""WITH {LINES_SQL}, {PREDICTIONS_SQL}, {REPORT_SQL}, {CONFUSION_SQL},
    m AS (SELECT {metrics_columns_sql()} FROM confusion)
    SELECT model, section, item, round(value, 6) AS value FROM (
      SELECT model, 'report' AS section, concat_ws(' ', class, measure) AS item, value FROM (
        SELECT model, class, 'precision' AS measure, "precision" AS value FROM report UNION ALL
        SELECT model, class, 'recall', recall FROM report UNION ALL
        SELECT model, class, 'f1_score', f1_score FROM report UNION ALL
        SELECT model, class, 'support', CAST(support AS DOUBLE) FROM report)
      UNION ALL
      SELECT model, 'confusion', 'tn', CAST(tn AS DOUBLE) FROM m UNION ALL
      SELECT model, 'confusion', 'fp', CAST(fp AS DOUBLE) FROM m UNION ALL
      SELECT model, 'confusion', 'fn', CAST(fn AS DOUBLE) FROM m UNION ALL
      SELECT model, 'confusion', 'tp', CAST(tp AS DOUBLE) FROM m UNION ALL
      SELECT model, 'rates', 'specificity', specificity FROM m UNION ALL
      SELECT model, 'rates', 'sensitivity', sensitivity FROM m)""",
)
def detailed_reports(spark, sf):
    return rounded(ev_plan.detailed_reports(example_predictions(spark, sf)))


@register(
    "s11_report_text",
    f"""WITH {LINES_SQL}, {PREDICTIONS_SQL}, {CONFUSION_SQL}, {BUSINESS_SQL},
    m AS (SELECT {metrics_columns_sql()} FROM confusion)
    SELECT m.model, CAST(p AS INT) AS position, CASE p
      WHEN 0 THEN printf('A Tiempo: %d right, %d wrong', tn, fp)
      WHEN 1 THEN printf('Con Demora: %d right, %d wrong', tp, fn)
      WHEN 2 THEN printf('accuracy %.4f, precision %.4f, recall %.4f, F1 %.4f', accuracy, "precision", recall, f1_score)
      WHEN 3 THEN printf('specificity %.4f, sensitivity %.4f', specificity, sensitivity)
      ELSE printf('net value %.2f, return %.2f%%', net_business_value, roi) END AS line
    FROM m JOIN business USING (model), range(5) AS lines_of_report(p)""",
)
def report_text(spark, sf):
    return ev_plan.report_lines(example_predictions(spark, sf))


REPORT_METRICS = [
    "train_accuracy", "train_f1_score", "test_accuracy", "test_f1_score", "overfitting_gap", "test_precision", "test_recall",
    "test_specificity", "test_sensitivity", "test_roc_auc", "test_avg_precision",
]


@register(
    "s11_consolidated_report",
    f"""WITH {LINES_SQL}, {PREDICTIONS_SQL}, {COMPARISON_SQL}, {CONFUSION_SQL.replace('FROM predictions', 'FROM test_predictions')}, {BUSINESS_SQL},
    b AS (SELECT model, round(net_business_value, 2) AS net, round(roi, 2) AS roi, false_positives AS fp, false_negatives AS fn FROM business),
    long AS ({' UNION ALL '.join(f"SELECT model, '{m}' AS metric, {m} AS value FROM comparison" for m in REPORT_METRICS)}),
    best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY metric ORDER BY value DESC, model) AS place FROM long
      WHERE value IS NOT NULL AND metric <> 'overfitting_gap') WHERE place = 1),
    chosen AS (SELECT * FROM b JOIN comparison USING (model) ORDER BY net DESC, model LIMIT 1)
    SELECT 'technical' AS section, model || ' ' || metric AS item, coalesce(printf('%.4f', value), 'not available') AS line FROM long
    UNION ALL SELECT 'business', model, printf('net value %.2f, return %.2f%%, %d false alarms, %d missed', net, roi, fp, fn) FROM b
    UNION ALL SELECT 'best by metric', metric, printf('%s (%.4f)', model, value) FROM best
    UNION ALL SELECT 'best by money', 'net value', printf('%s (%.2f)', model, net) FROM chosen
    UNION ALL SELECT 'recommendation', 'model', model FROM chosen
    UNION ALL SELECT 'recommendation', 'net value', printf('largest net value: %.2f', net) FROM chosen
    UNION ALL SELECT 'recommendation', 'return', printf('return on cost: %.2f%%', roi) FROM chosen
    UNION ALL SELECT 'recommendation', 'quality', printf('accuracy %.4f, F1 %.4f', test_accuracy, test_f1_score) FROM chosen
    UNION ALL SELECT 'recommendation', 'against ' || b.model, printf('%.2f more net value', c.net - b.net) FROM b, chosen c WHERE b.model <> c.model
    UNION ALL SELECT 'compared', 'models', printf('%d models, %d with probabilities', count(*), count(*) FILTER (has_probabilities)) FROM comparison""",
)
def consolidated_report(spark, sf):
    """All models, their best ones and the recommendation with its reasons, as lines."""
    return ev_plan.consolidated_report(example_predictions(spark, sf))


# --- projections and filters --------------------------------------------------


@register("p1_drop_columns", "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def drop_columns(spark, sf):
    return c.drop_columns(read_table(spark, sf, "customer"), ["c_name", "not_there"])


@register(
    "p2_drop_geography",
    f"""WITH {LINES_SQL} SELECT market, segment, count(*) AS n, round(avg(sales), 4) AS mean_sales
    FROM lines GROUP BY market, segment""",
)
def drop_geography(spark, sf):
    """After dropping the fine level, rows are summarised by what is left."""
    lines = order_lines(spark, sf, ["region", "market", "segment", "sales"])
    kept = c.drop_columns(lines, ["region", "city"])
    groups = [n for n in kept.columns if n != "sales"]
    summary = kept.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.avg("sales").alias("mean_sales"))
    return rounded(summary, 4)


@register("p3_numeric_columns", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def numeric_columns(spark, sf):
    customer = read_table(spark, sf, "customer")
    return customer.select(*c.numeric_columns(customer))


@register("p3_text_columns", "SELECT p_name, p_brand, p_type FROM part")
def text_columns(spark, sf):
    part = read_table(spark, sf, "part")
    return part.select(*c.string_columns(part))


@register("p4_glue_columns", "SELECT p_name, p_brand, p_type, p_partkey, p_size, p_retailprice FROM part")
def glue_columns(spark, sf):
    """Text columns and numeric columns of the same rows side by side: one projection."""
    part = read_table(spark, sf, "part")
    return part.select(*c.string_columns(part), *c.numeric_columns(part))


@register("p5_late_label", f"WITH {LINES_SQL} SELECT {', '.join(LINE_KEY)}, real_days, scheduled_days, late FROM lines")
def late_label(spark, sf):
    lines = order_lines(spark, sf, [*LINE_KEY, "real_days", "scheduled_days"])
    return labels.add_late_label(lines, "real_days", "scheduled_days", "late")


@register(
    "p6_required_columns",
    f"WITH {LINES_SQL} SELECT late, count(*) AS n FROM lines GROUP BY late",
)
def required_columns(spark, sf):
    lines = order_lines(spark, sf, ["real_days", "scheduled_days"])
    c.require_columns(lines, ["real_days", "scheduled_days"])
    labelled = labels.add_late_label(lines, "real_days", "scheduled_days", "late")
    return labelled.groupBy("late").agg(F.count(F.lit(1)).alias("n"))


@register(
    "p6_required_values",
    """WITH o AS (SELECT * FROM orders LEFT JOIN (SELECT doc_id AS o_orderkey, quality FROM labels) USING (o_orderkey))
    SELECT 'o_orderkey' AS "column", true AS present, count(o_orderkey) AS n_values FROM o
    UNION ALL SELECT 'quality', true, count(quality) FROM o UNION ALL SELECT 'real_days', false, CAST(0 AS BIGINT)""",
)
def required_values(spark, sf):
    """The check on required columns as a table: one there, one with gaps, one missing."""
    quality = read_table(spark, sf, "labels").select(F.col("doc_id").alias("o_orderkey"), "quality")
    orders = read_table(spark, sf, "orders").join(quality, "o_orderkey", "left")
    return c.required_values(orders, ["o_orderkey", "quality", "real_days"])


@register(
    "p7_both_classes",
    f"WITH {LINES_SQL} SELECT min(late) AS min_label, max(late) AS max_label, min(late) < max(late) AS both_classes FROM lines",
)
def both_classes(spark, sf):
    return labels.label_range(order_lines(spark, sf, ["late"]), "late")


EVENT_LIMITS = """
limits AS (
  SELECT q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper
  FROM (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events))"""


@register(
    "p8_outlier_rows",
    f"WITH {EVENT_LIMITS} SELECT event_id, user_id, event_type, value FROM events, limits WHERE value < lower OR value > upper",
)
def outlier_rows(spark, sf):
    events = read_table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    return cleaning.outlier_rows(events, "value")


def _documents_with_labels(spark, sf):
    documents = read_table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    marks = read_table(spark, sf, "labels")
    grade = F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")
    return documents.join(marks, "doc_id", "left").withColumn("grade", grade)


@register(
    "p9_columns_with_nulls",
    f"""WITH {NULL_SOURCE_SQL}, counted AS (
      {' UNION ALL '.join(f"SELECT '{x}' AS column, count(*) - count({x}) AS n_null, round((count(*) - count({x})) * 100.0 / count(*), 6) AS pct_null FROM docs" for x in ['doc_id', 'lang', 'source', 'n_chars', 'quality', 'toxic', 'grade'])})
    SELECT * FROM counted WHERE n_null > 0""",
)
def columns_with_nulls(spark, sf):
    return rounded(cleaning.columns_with_nulls(_documents_with_labels(spark, sf)))


@register("p10_split_label", "SELECT event_id, event_type FROM events")
def split_label(spark, sf):
    events = read_table(spark, sf, "events")
    _, label = c.split_label(events, "event_type", ["event_id"])
    return label


@register("p10_split_features", "SELECT event_id, user_id, value, props FROM events")
def split_features(spark, sf):
    """The other half: all columns but the label."""
    events = read_table(spark, sf, "events").drop("ts")
    features, _ = c.split_label(events, "event_type", ["event_id"])
    return features


TOP_BRANDS = """
top AS (SELECT p_brand FROM part GROUP BY p_brand ORDER BY count(*) DESC, p_brand LIMIT 15)"""


@register(
    "p11_keep_or_other",
    f"""WITH {TOP_BRANDS} SELECT p_partkey,
        CASE WHEN p_brand IN (SELECT p_brand FROM top) THEN p_brand ELSE 'Other' END AS brand FROM part""",
)
def keep_or_other(spark, sf):
    part = read_table(spark, sf, "part")
    kept = [r["value"] for r in cleaning.top_values(part, ["p_brand"], 15).collect()]
    return part.select("p_partkey", cleaning.keep_or_other(F.col("p_brand"), kept).alias("brand"))


@register("p12_preview", "SELECT * FROM customer ORDER BY c_custkey LIMIT 5")
def preview(spark, sf):
    return c.preview(read_table(spark, sf, "customer"), ["c_custkey"])


@register("p13_shape", "SELECT count(*) AS n_rows, CAST(6 AS BIGINT) AS n_columns FROM orders")
def shape(spark, sf):
    return c.shape(read_table(spark, sf, "orders"))


@register(
    "p13_column_list",
    """SELECT CAST(ordinal_position - 1 AS INT) AS position, column_name AS column,
       CASE data_type WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string'
       WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END AS type
       FROM information_schema.columns WHERE table_name = 'orders'""",
)
def column_list(spark, sf):
    return c.column_list(read_table(spark, sf, "orders"))


# --- dates --------------------------------------------------------------------


@register(
    "d1_parse_timestamp",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M') END AS parsed
       FROM orders""",
)
def parse_timestamp(spark, sf):
    """Dates written as text in the raw pattern; a part of them spoilt, which gives NULL."""
    orders = read_table(spark, sf, "orders")
    text = F.date_format("o_orderdate", "M/d/yyyy HH:mm")
    text = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("bad "), text)).otherwise(text)
    parsed = dates.parse_timestamp(text, "M/d/yyyy HH:mm")
    return orders.select("o_orderkey", F.date_format(parsed, "yyyy-MM-dd HH:mm").alias("parsed"))


@register(
    "d2_date_parts",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS order_year, CAST(month(o_orderdate) AS INT) AS order_month,
       CAST(day(o_orderdate) AS INT) AS order_day, CAST(isodow(o_orderdate) - 1 AS INT) AS order_weekday,
       CAST(quarter(o_orderdate) AS INT) AS order_quarter FROM orders""",
)
def date_parts(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return dates.add_date_parts(orders, "o_orderdate", "order_")


# --- sorting and top-k --------------------------------------------------------


@register(
    "t1_sort_descending",
    f"WITH {LINES_SQL} SELECT product AS value, count(*) AS n FROM lines GROUP BY product ORDER BY n DESC, value",
)
def sort_descending(spark, sf):
    counts = c.value_counts(order_lines(spark, sf, ["product"]), ["product"])
    return counts.select("value", "n").orderBy(F.desc("n"), "value")


@register(
    "t2_sort_by_absolute",
    f"""WITH {LINES_SQL}, {correlation_sql('lines', CORRELATION_COLUMNS)}
    SELECT "left", "right", round(r, 6) AS r FROM pairs ORDER BY abs(r) DESC""",
)
def sort_by_absolute(spark, sf):
    pairs = correlation.correlation_pairs(staged_lines(spark, sf, CORRELATION_COLUMNS), CORRELATION_COLUMNS)
    return rounded(pairs.select("left", "right", "r").orderBy(F.abs("r").desc(), "left", "right"))


@register(
    "t3_top_ten",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def top_ten(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@register(
    "t4_top_categories",
    """SELECT "column", value, n, rank FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS INT) AS rank FROM (
        SELECT 'p_name' AS "column", p_name AS value, count(*) AS n FROM part GROUP BY p_name UNION ALL
        SELECT 'p_brand', p_brand, count(*) FROM part GROUP BY p_brand)) WHERE rank <= 15""",
)
def top_categories(spark, sf):
    return cleaning.top_values(read_table(spark, sf, "part"), ["p_name", "p_brand"], 15)


@register(
    "t5_best_and_smallest_gap",
    f"""WITH {LINES_SQL}, {PREDICTIONS_SQL}, {COMPARISON_SQL}
    SELECT model, overfitting_gap FROM comparison ORDER BY abs(overfitting_gap), model LIMIT 1""",
)
def best_and_smallest_gap(spark, sf):
    return evaluation.smallest_gap(evaluation.comparison_table(example_predictions(spark, sf)))


@register(
    "t5_argmax_and_argmin",
    f"""WITH {LINES_SQL}, {PREDICTIONS_SQL}, {COMPARISON_SQL}
    SELECT * FROM (SELECT 'largest test_accuracy' AS what, model, test_accuracy AS value FROM comparison ORDER BY value DESC, model LIMIT 1)
    UNION ALL SELECT * FROM (SELECT 'smallest overfitting_gap', model, overfitting_gap FROM comparison ORDER BY abs(overfitting_gap), model LIMIT 1)""",
)
def argmax_and_argmin(spark, sf):
    """The model with the best accuracy and the one with the gap closest to 0."""
    table = stage_table(evaluation.comparison_table(example_predictions(spark, sf)), "comparison")
    best = evaluation.best_by_metric(table).where("metric = 'test_accuracy'")
    gap = evaluation.smallest_gap(table).select(F.lit("smallest overfitting_gap").alias("what"), "model", F.col("overfitting_gap").alias("value"))
    return best.select(F.lit("largest test_accuracy").alias("what"), "model", "value").unionAll(gap)


@register(
    "t6_sort_by_key",
    f"WITH {LINES_SQL} SELECT late AS value, count(*) AS n FROM lines GROUP BY late ORDER BY late",
)
def sort_by_key(spark, sf):
    return profiling.class_distribution(order_lines(spark, sf, ["late"]), "late").select("value", "n")


@register(
    "late_share_by_priority",
    f"""WITH {LINES_SQL} SELECT priority AS category, count(*) AS n, CAST(sum(late) AS BIGINT) AS n_late,
        round(sum(late) / count(*), 6) AS late_share FROM lines GROUP BY priority""",
)
def late_share_by_priority(spark, sf):
    """What share of order lines is late for each priority?"""
    return rounded(contingency.late_share(order_lines(spark, sf, ["priority", "late"]), "priority", "late"))


