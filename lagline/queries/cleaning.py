"""Queries on duplicates, missing values, outliers and rare categories (C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lagline.functions import columns as c
from lagline.operators import cleaning, evaluation, splitting
from lagline.plans.examples import PREDICTIONS_SQL, example_predictions
from lagline.queries import register, rounded
from lagline.queries.sql import COMPARISON_SQL, NULL_SOURCE_SQL, split_sql, union_sql
from lagline.queries.tables import _documents_with_labels
from lagline.sources.tables import ALL_COLUMNS, LINES_SQL, NUMERIC, read_table, staged_lines

DOC_COLUMNS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic", "grade"]
EVENT_ROWS_SQL = "event_rows AS (SELECT event_type, CAST(floor(value) AS BIGINT) AS amount, user_id FROM events)"


def _event_rows(spark, sf):
    events = read_table(spark, sf, "events")
    return events.select("event_type", F.floor("value").alias("amount"), "user_id")


@register("c1_distinct_rows", f"WITH {EVENT_ROWS_SQL} SELECT DISTINCT * FROM event_rows")
def distinct_rows(spark, sf):
    return cleaning.drop_duplicate_rows(_event_rows(spark, sf))


@register("c1_distinct_texts", "SELECT DISTINCT text, lang FROM documents")
def distinct_texts(spark, sf):
    return cleaning.drop_duplicate_rows(read_table(spark, sf, "documents").select("text", "lang"))


@register(
    "c1_wide_rows",
    f"WITH {LINES_SQL}, twice AS (SELECT * FROM lines UNION ALL SELECT * FROM lines WHERE l_linenumber = 7) SELECT DISTINCT * FROM twice",
)
def wide_rows(spark, sf):
    """Whole order lines, those with line number 7 twice: only these are shuffled whole."""
    lines = staged_lines(spark, sf, ALL_COLUMNS)
    return cleaning.drop_duplicate_rows(lines.unionAll(lines.where("l_linenumber = 7")))


@register(
    "c2_duplicate_count",
    f"""WITH {EVENT_ROWS_SQL}, d AS (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM event_rows))
    SELECT count(*) AS n_rows, count(*) - any_value(n) AS n_duplicates,
           round((count(*) - any_value(n)) * 100.0 / count(*), 6) AS pct_duplicates FROM event_rows, d""",
)
def duplicate_count(spark, sf):
    return rounded(cleaning.duplicate_count(_event_rows(spark, sf)))


@register(
    "c3_null_counts",
    f"WITH {NULL_SOURCE_SQL} "
    + union_sql(
        DOC_COLUMNS,
        """SELECT '{c}' AS "column", count(*) - count({c}) AS n_null,
           round((count(*) - count({c})) * 100.0 / count(*), 6) AS pct_null FROM docs""",
    ),
)
def null_counts(spark, sf):
    return rounded(cleaning.null_counts(_documents_with_labels(spark, sf)))


NAN_COLUMNS = ["event_id", "event_type", "value"]


@register(
    "c3_null_counts_nan",
    "WITH gaps AS (SELECT event_id, event_type, CASE WHEN floor(value) % 5 <> 0 THEN value END AS value FROM events) "
    + union_sql(
        NAN_COLUMNS,
        """SELECT '{c}' AS "column", count(*) - count({c}) AS n_null,
           round((count(*) - count({c})) * 100.0 / count(*), 6) AS pct_null FROM gaps""",
    ),
)
def null_counts_nan(spark, sf):
    """Event values, each fifth amount replaced by NaN, counted as missing."""
    events = read_table(spark, sf, "events")
    value = F.when(F.floor("value") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return rounded(cleaning.null_counts(events.select("event_id", "event_type", value.alias("value"))))


@register(
    "c4_total_nulls",
    f"WITH {NULL_SOURCE_SQL} SELECT CAST(sum(n) AS BIGINT) AS n_null FROM ("
    + union_sql(DOC_COLUMNS, "SELECT count(*) - count({c}) AS n FROM docs")
    + ")",
)
def total_nulls(spark, sf):
    return cleaning.total_nulls(_documents_with_labels(spark, sf))


@register(
    "c5_fill_with_median",
    f"""WITH {NULL_SOURCE_SQL}, m AS (
      SELECT quantile_cont(CAST(quality AS DOUBLE), 0.5) AS q, quantile_cont(CAST(toxic AS DOUBLE), 0.5) AS t FROM docs)
    SELECT doc_id, coalesce(CAST(quality AS DOUBLE), q) AS quality, coalesce(CAST(toxic AS DOUBLE), t) AS toxic FROM docs, m""",
)
def fill_with_median(spark, sf):
    docs = _documents_with_labels(spark, sf).select("doc_id", "quality", "toxic")
    filler = cleaning.GapFiller(numericCols=["quality", "toxic"], textCols=[])
    return filler.fit(docs).transform(docs)


@register(
    "c6_fill_with_mode",
    f"""WITH {NULL_SOURCE_SQL}, m AS (
      SELECT grade FROM docs WHERE grade IS NOT NULL GROUP BY grade ORDER BY count(*) DESC, grade LIMIT 1)
    SELECT doc_id, lang, coalesce(docs.grade, (SELECT grade FROM m), 'Unknown') AS grade FROM docs""",
)
def fill_with_mode(spark, sf):
    docs = _documents_with_labels(spark, sf).select("doc_id", "lang", "grade")
    return cleaning.GapFiller(numericCols=[]).fit(docs).transform(docs)


@register(
    "c7_median_from_train",
    f"""WITH {NULL_SOURCE_SQL}, {split_sql('docs', 'lang', ['doc_id'])}, m AS (
      SELECT quantile_cont(CAST(quality AS DOUBLE), 0.5) AS q, quantile_cont(CAST(n_chars AS DOUBLE), 0.5) AS n
      FROM split WHERE split = 'train')
    SELECT doc_id, split, coalesce(CAST(quality AS DOUBLE), q) AS quality,
           coalesce(CAST(n_chars AS DOUBLE), n) AS n_chars FROM split, m""",
)
def median_from_train(spark, sf):
    """Medians of the training rows fill both sides."""
    docs = _documents_with_labels(spark, sf).select("doc_id", "lang", "quality", "n_chars")
    split = splitting.stratified_split(docs, "lang", ["doc_id"])
    filler = cleaning.GapFiller(numericCols=["quality", "n_chars"], textCols=[])
    model = filler.fit(split.where("split = 'train'"))
    return model.transform(split).select("doc_id", "split", "quality", "n_chars")


LIMITS_TEMPLATE = """SELECT '{c}' AS "column", q1, q3, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper
  FROM (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM lines)"""
LIMITS_SQL = f"limits AS ({union_sql(NUMERIC, LIMITS_TEMPLATE)})"


@register(
    "c8_iqr_limits",
    f"""WITH {LINES_SQL}, {LIMITS_SQL} SELECT "column", round(q1, 6) AS q1, round(q3, 6) AS q3,
    round(lower, 6) AS lower, round(upper, 6) AS upper FROM limits""",
)
def iqr_limits(spark, sf):
    return rounded(cleaning.iqr_table(staged_lines(spark, sf, NUMERIC), NUMERIC))


OUTLIERS_TEMPLATE = """SELECT '{c}' AS "column", count(*) FILTER ({c} < lower OR {c} > upper) AS n_outliers,
  round(count(*) FILTER ({c} < lower OR {c} > upper) * 100.0 / count(*), 6) AS pct_outliers,
  round(any_value(lower), 6) AS lower, round(any_value(upper), 6) AS upper
  FROM lines, limits WHERE "column" = '{c}'"""


@register("c9_outlier_summary", f"WITH {LINES_SQL}, {LIMITS_SQL} {union_sql(NUMERIC, OUTLIERS_TEMPLATE)}")
def outlier_summary(spark, sf):
    return rounded(cleaning.outlier_summary(staged_lines(spark, sf, NUMERIC), NUMERIC))


@register(
    "c9_event_outliers",
    """WITH l AS (SELECT q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM (
      SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events))
    SELECT 'value' AS "column", count(*) FILTER (value < lower OR value > upper) AS n_outliers,
      round(count(*) FILTER (value < lower OR value > upper) * 100.0 / count(*), 6) AS pct_outliers,
      round(any_value(lower), 6) AS lower, round(any_value(upper), 6) AS upper FROM events, l""",
)
def event_outliers(spark, sf):
    return rounded(cleaning.outlier_summary(read_table(spark, sf, "events").select("value"), ["value"]))


@register(
    "c10_capped_values",
    """WITH l AS (SELECT q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM (
      SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events))
    SELECT event_id, event_type, round(least(greatest(value, lower), upper), 6) AS value FROM events, l""",
)
def capped_values(spark, sf):
    events = read_table(spark, sf, "events").select("event_id", "event_type", "value")
    return rounded(cleaning.IqrCapper(columns=["value"]).fit(events).transform(events))


@register(
    "c11_rare_to_other",
    """WITH top AS (SELECT source FROM documents GROUP BY source ORDER BY count(*) DESC, source LIMIT 15)
    SELECT doc_id, lang, CASE WHEN source IN (SELECT source FROM top) THEN source ELSE 'Other' END AS source
    FROM documents""",
)
def rare_to_other(spark, sf):
    """Twenty sources become fifteen and 'Other'; four languages stay."""
    docs = read_table(spark, sf, "documents").select("doc_id", "lang", "source")
    return cleaning.RareFolder().fit(docs).transform(docs)


@register(
    "c11_high_cardinality",
    """WITH lines AS (SELECT CAST(l_partkey AS VARCHAR) AS part, CAST(l_orderkey AS VARCHAR) AS order_key FROM lineitem),
    p AS (SELECT part FROM lines GROUP BY part ORDER BY count(*) DESC, part LIMIT 15),
    o AS (SELECT order_key FROM lines GROUP BY order_key ORDER BY count(*) DESC, order_key LIMIT 15)
    SELECT CASE WHEN part IN (SELECT part FROM p) THEN part ELSE 'Other' END AS part,
           CASE WHEN order_key IN (SELECT order_key FROM o) THEN order_key ELSE 'Other' END AS order_key, count(*) AS n
    FROM lines GROUP BY ALL""",
)
def high_cardinality(spark, sf):
    """Thousands of parts and orders become fifteen of each and 'Other'."""
    lines = read_table(spark, sf, "lineitem").select(F.col("l_partkey").cast("string").alias("part"), F.col("l_orderkey").cast("string").alias("order_key"))
    return cleaning.RareFolder().fit(lines).transform(lines).groupBy("part", "order_key").agg(F.count(F.lit(1)).alias("n"))


@register(
    "c12_missing_shown_as_zero",
    f"""WITH {LINES_SQL}, {PREDICTIONS_SQL}, {COMPARISON_SQL}
    SELECT model, test_accuracy, test_precision, test_recall, test_f1_score,
           coalesce(test_roc_auc, 0) AS test_roc_auc FROM comparison""",
)
def missing_shown_as_zero(spark, sf):
    return evaluation.metrics_for_chart(evaluation.comparison_table(example_predictions(spark, sf)))


@register(
    "c12_fill_zero",
    f"WITH {NULL_SOURCE_SQL} SELECT doc_id, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic FROM docs",
)
def fill_zero(spark, sf):
    docs = _documents_with_labels(spark, sf).select("doc_id", "quality", "toxic")
    return cleaning.fill_zero(docs, c.numeric_columns(docs, ["doc_id"]))
