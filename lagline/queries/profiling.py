"""Queries on summaries, distributions, contingency and correlation (A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lagline.operators import contingency, correlation, profiling
from lagline.plans.examples import PREDICTIONS_SQL, example_predictions
from lagline.plans.profile import profile
from lagline.queries import register, rounded
from lagline.queries.cleaning import DOC_COLUMNS, LIMITS_SQL
from lagline.queries.sql import CORRELATION_COLUMNS, NULL_SOURCE_SQL, correlation_sql, union_sql
from lagline.queries.tables import _documents_with_labels
from lagline.sources.tables import CATEGORIES, LINES_SQL, LINE_KEY, NUMERIC, order_lines, read_table, staged_lines

DESCRIBE = """SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 7) AS mean, round(stddev_samp({c}), 7) AS std,
  CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 7) AS q25,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 7) AS median,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 7) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM lines"""


@register("a1_describe_numeric", f"WITH {LINES_SQL} {union_sql(NUMERIC, DESCRIBE)}")
def describe_numeric(spark, sf):
    # 7 digits: means of cents over 60,000 rows often end in 5 at the 7th
    return rounded(profiling.describe_numeric(staged_lines(spark, sf, NUMERIC), NUMERIC), 7)


TEXT = ["lang", "source", "grade"]
DESCRIBE_TEXT = """SELECT '{c}' AS "column", count({c}) AS count, count(DISTINCT {c}) AS "unique",
  (SELECT {c} FROM docs WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
  (SELECT count(*) FROM docs WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS freq FROM docs"""


@register("a2_describe_categories", f"WITH {NULL_SOURCE_SQL} {union_sql(TEXT, DESCRIBE_TEXT)}")
def describe_categories(spark, sf):
    return profiling.describe_categories(_documents_with_labels(spark, sf), TEXT)


DOC_TYPES = dict(zip(DOC_COLUMNS, ["bigint", "string", "string", "bigint", "int", "int", "string"]))


@register(
    "a3_table_info",
    f"WITH {NULL_SOURCE_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{n}' AS "column", {i} AS position, '{t}' AS type, count({n}) AS n_non_null FROM docs"""
        for i, (n, t) in enumerate(DOC_TYPES.items())
    ),
)
def table_info(spark, sf):
    return profiling.table_info(_documents_with_labels(spark, sf))


@register(
    "a4_class_distribution",
    f"""WITH {LINES_SQL} SELECT late AS value, count(*) AS n,
        round(count(*) * 100.0 / (SELECT count(*) FROM lines), 6) AS pct FROM lines GROUP BY late""",
)
def class_distribution(spark, sf):
    return rounded(profiling.class_distribution(order_lines(spark, sf, ["late"]), "late"))


@register(
    "a5_class_balance",
    f"""WITH {LINES_SQL} SELECT count(*) FILTER (late = 0) AS n_0, count(*) FILTER (late = 1) AS n_1, count(*) AS n_rows,
        abs(count(*) FILTER (late = 0) - count(*) FILTER (late = 1)) < count(*) * 0.1 AS balanced FROM lines""",
)
def class_balance(spark, sf):
    return profiling.class_balance(order_lines(spark, sf, ["late"]), "late")


@register(
    "a6_distinct_counts",
    f"WITH {NULL_SOURCE_SQL} "
    + union_sql(
        TEXT,
        """SELECT '{c}' AS "column", count(DISTINCT {c}) AS n_distinct,
           count(DISTINCT {c}) + CAST(count(*) > count({c}) AS INT) AS n_with_null FROM docs""",
    ),
)
def distinct_counts(spark, sf):
    return profiling.distinct_counts(_documents_with_labels(spark, sf), TEXT)


LISTED = ["priority", "region", "product", "brand"]


@register(
    "a7_distinct_values",
    f"WITH {LINES_SQL} "
    + union_sql(
        LISTED,
        """SELECT '{c}' AS "column", CASE WHEN n <= 20 THEN array_to_string(list_slice(v, 1, 10), ',') END AS "values"
           FROM (SELECT list_sort(list(DISTINCT {c})) AS v, count(DISTINCT {c}) AS n FROM lines)""",
    ),
)
def distinct_values(spark, sf):
    lists = profiling.distinct_value_lists(order_lines(spark, sf, LISTED), LISTED)
    return lists.select("column", F.array_join("values", ",").alias("values"))


COUNTED = ["priority", "market", "region", "category", "segment"]


@register(
    "a8_value_counts",
    f"WITH {LINES_SQL} " + union_sql(COUNTED, """SELECT '{c}' AS "column", {c} AS value, count(*) AS n FROM lines GROUP BY {c}"""),
)
def value_counts(spark, sf):
    return profiling.value_counts(order_lines(spark, sf, COUNTED), COUNTED)


@register(
    "a9_min_max_std",
    f"WITH {LINES_SQL} "
    + union_sql(
        NUMERIC,
        """SELECT '{c}' AS "column", CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
           round(stddev_samp({c}), 6) AS std FROM lines""",
    ),
)
def min_max_std(spark, sf):
    return rounded(profiling.min_max_std(order_lines(spark, sf, NUMERIC), NUMERIC))


BINNED = ["sales", "quantity", "order_total"]
HISTOGRAM = """SELECT '{c}' AS "column", CAST(b AS INT) AS bin, round(low + b * (high - low) / 30, 6) AS lower,
  round(low + (b + 1) * (high - low) / 30, 6) AS upper, count({c}) AS n
  FROM (SELECT CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high FROM lines) e
  CROSS JOIN range(30) bins(b) LEFT JOIN lines ON least(floor(({c} - low) / ((high - low) / 30)), 29) = b
  GROUP BY b, low, high"""


@register("a10_histogram", f"WITH {LINES_SQL} {union_sql(BINNED, HISTOGRAM)}")
def histogram(spark, sf):
    return rounded(profiling.histogram(staged_lines(spark, sf, BINNED), BINNED))


BOX = """SELECT '{c}' AS "column", round(any_value(q1), 6) AS q1, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS median,
  round(any_value(q3), 6) AS q3,
  round(coalesce(min({c}) FILTER ({c} >= lower AND {c} <= q1), any_value(q1)), 6) AS whisker_low,
  round(coalesce(max({c}) FILTER ({c} <= upper AND {c} >= q3), any_value(q3)), 6) AS whisker_high,
  count(*) FILTER ({c} < lower OR {c} > upper) AS n_fliers FROM lines, limits WHERE "column" = '{c}'"""


@register("a11_box_summary", f"WITH {LINES_SQL}, {LIMITS_SQL} {union_sql(NUMERIC, BOX)}")
def box_summary(spark, sf):
    return rounded(profiling.box_summary(staged_lines(spark, sf, NUMERIC), NUMERIC))


# --- contingency --------------------------------------------------------------


def _categories(spark, sf):
    return order_lines(spark, sf, [*CATEGORIES, "late"])


@register(
    "a12_contingency_with_margins",
    f"WITH {LINES_SQL} "
    + union_sql(
        CATEGORIES,
        """SELECT '{c}' AS "column", CASE WHEN grouping({c}) = 1 THEN 'All' ELSE {c} END AS category,
           count(*) FILTER (late = 0) AS n_0, count(*) FILTER (late = 1) AS n_1, count(*) AS n
           FROM lines GROUP BY ROLLUP ({c})""",
    ),
)
def contingency_with_margins(spark, sf):
    return contingency.contingency_with_margins(_categories(spark, sf), CATEGORIES, "late")


@register(
    "a13_row_percentages",
    f"WITH {LINES_SQL} "
    + union_sql(
        CATEGORIES,
        """SELECT '{c}' AS "column", {c} AS value, round(count(*) FILTER (late = 0) * CAST(100 AS DOUBLE) / count(*), 2) AS pct_0,
           round(count(*) FILTER (late = 1) * CAST(100 AS DOUBLE) / count(*), 2) AS pct_1 FROM lines GROUP BY {c}""",
    ),
)
def row_percentages(spark, sf):
    return contingency.row_percentages(_categories(spark, sf), CATEGORIES, "late")


@register(
    "a14_stacked_counts",
    f"""WITH {LINES_SQL} SELECT market AS category, count(*) FILTER (late = 0) AS n_0,
        count(*) FILTER (late = 1) AS n_1 FROM lines GROUP BY market""",
)
def stacked_counts(spark, sf):
    return contingency.stacked_counts(order_lines(spark, sf, ["market", "late"]), "market", "late")


CELLS = """SELECT '{c}' AS "column", r.{c} AS value, CAST(k.late AS VARCHAR) AS label, coalesce(o.n, 0) AS observed,
  r.n * k.n / (SELECT count(*) FROM lines) AS expected
  FROM (SELECT {c}, count(*) AS n FROM lines GROUP BY {c}) r
  CROSS JOIN (SELECT late, count(*) AS n FROM lines GROUP BY late) k
  LEFT JOIN (SELECT {c}, late, count(*) AS n FROM lines GROUP BY {c}, late) o ON o.{c} = r.{c} AND o.late = k.late"""
CELLS_SQL = f"cells AS ({union_sql(CATEGORIES, CELLS)})"


@register(
    "a15_expected_counts",
    f"""WITH {LINES_SQL}, {CELLS_SQL} SELECT "column", value, label, observed, round(expected, 6) AS expected FROM cells""",
)
def expected_counts(spark, sf):
    return rounded(contingency.expected_counts(_categories(spark, sf), CATEGORIES, "late"))


@register(
    "a15_chi_square",
    f"""WITH {LINES_SQL}, {CELLS_SQL}, s AS (
      SELECT "column", CAST((count(DISTINCT value) - 1) * (count(DISTINCT label) - 1) AS INT) AS dof,
             sum((observed - expected) * (observed - expected) / expected) AS statistic FROM cells GROUP BY "column"),
    tail AS (SELECT *, greatest(0.0, 1 - list_sum(list_transform(range(2000),
             lambda i: exp((dof / 2.0 + i) * ln(greatest(statistic / 2, 1e-300)) - statistic / 2 - lgamma(dof / 2.0 + i + 1))))) AS p FROM s)
    SELECT "column", round(statistic, 6) AS statistic, dof, round(p, 6) AS p_value, p < 0.05 AS significant FROM tail""",
)
def chi_square(spark, sf):
    """Every analysed column; the SQL sums the series of the lower incomplete gamma function."""
    return rounded(contingency.chi_square(_categories(spark, sf), CATEGORIES, "late"))


@register(
    "a15_chi_square_statistic",
    f"""WITH {LINES_SQL}, {CELLS_SQL} SELECT "column",
      round(sum((observed - expected) * (observed - expected) / expected), 6) AS statistic,
      CAST((count(DISTINCT value) - 1) * (count(DISTINCT label) - 1) AS INT) AS dof FROM cells GROUP BY "column\"""",
)
def chi_square_statistic(spark, sf):
    tested = contingency.chi_square(_categories(spark, sf), CATEGORIES, "late")
    return rounded(tested.select("column", "statistic", "dof"))


# --- correlation --------------------------------------------------------------

PAIRS_SQL = correlation_sql("lines", CORRELATION_COLUMNS)


def _pairs(spark, sf):
    return correlation.correlation_pairs(staged_lines(spark, sf, CORRELATION_COLUMNS), CORRELATION_COLUMNS)


@register(
    "a16_correlation_matrix",
    f"""WITH {LINES_SQL}, {PAIRS_SQL} SELECT "left", "right", round(r, 6) AS r FROM pairs
    UNION ALL SELECT "right", "left", round(r, 6) FROM pairs
    UNION ALL {union_sql(CORRELATION_COLUMNS, "SELECT '{c}', '{c}', 1.0")}""",
)
def correlation_matrix(spark, sf):
    lines = staged_lines(spark, sf, CORRELATION_COLUMNS)
    return rounded(correlation.correlation_matrix(lines, CORRELATION_COLUMNS))


DOC_NUMBERS = ["n_chars", "quality", "toxic", "text_length", "always_one"]
DOC_NUMBERS_SQL = """numbers AS (SELECT n_chars, quality, toxic, length(text) AS text_length, 1 AS always_one
  FROM documents LEFT JOIN labels USING (doc_id))"""


@register(
    "a16_correlation_with_gaps",
    f"""WITH {DOC_NUMBERS_SQL}, {correlation_sql('numbers', DOC_NUMBERS)}
    SELECT "left", "right", round(r, 6) AS r FROM pairs""",
)
def correlation_with_gaps(spark, sf):
    """Pairwise-complete rows; a constant column has no correlation."""
    docs = read_table(spark, sf, "documents").join(read_table(spark, sf, "labels"), "doc_id", "left")
    numbers = docs.select("n_chars", "quality", "toxic", F.length("text").alias("text_length"), F.lit(1).alias("always_one"))
    return rounded(correlation.correlation_pairs(numbers, DOC_NUMBERS).select("left", "right", "r"))


WIDE_BASE = ["sales", "quantity", "discount", "unit_price", "order_total", "scheduled_days", "tax"]
WIDE_COLUMNS = {
    f"w{i:02}": f"CASE WHEN l_linenumber % {5 + i % 3} <> {i % 4} THEN {WIDE_BASE[i % 7]} * {i + 1} + {WIDE_BASE[(i * 3 + 1) % 7]} END"
    for i in range(40)
}


@register(
    "a16_wide",
    f"""WITH {LINES_SQL}, wide AS (SELECT row_number() OVER () AS rid, {', '.join(f'CAST({e} AS DOUBLE) AS {c}' for c, e in WIDE_COLUMNS.items())} FROM lines),
    long AS (SELECT rid, name, value FROM wide UNPIVOT (value FOR name IN ({', '.join(WIDE_COLUMNS)})))
    SELECT a.name AS "left", b.name AS "right", round(corr(a.value, b.value), 6) AS r
    FROM long a JOIN long b ON a.rid = b.rid AND a.name < b.name GROUP BY a.name, b.name""",
)
def wide_correlation(spark, sf):
    """All pairs of forty columns with gaps, each over the rows where both are present."""
    lines = order_lines(spark, sf, [*LINE_KEY, *WIDE_BASE]).select(*[F.expr(e).alias(c) for c, e in WIDE_COLUMNS.items()])
    return rounded(correlation.correlation_pairs(lines, list(WIDE_COLUMNS)).select("left", "right", "r"))


@register(
    "a17_target_correlation",
    f"""WITH {LINES_SQL}, {correlation_sql('lines', ['sales', *[x for x in CORRELATION_COLUMNS if x != 'sales']])}
    SELECT "right" AS "column", round(r, 6) AS r FROM pairs WHERE i = 0""",
)
def target_correlation(spark, sf):
    lines = staged_lines(spark, sf, CORRELATION_COLUMNS)
    return rounded(correlation.target_correlations(lines, CORRELATION_COLUMNS, "sales"))


@register(
    "a18_high_pairs",
    f"""WITH {LINES_SQL}, {PAIRS_SQL} SELECT "left", "right", round(r, 6) AS r FROM pairs WHERE abs(r) >= 0.7""",
)
def high_pairs(spark, sf):
    return rounded(correlation.strong_pairs(_pairs(spark, sf), 0.7, True).select("left", "right", "r"))


@register(
    "a18_medium_pairs",
    f"""WITH {LINES_SQL}, {PAIRS_SQL} SELECT "left", "right", round(r, 6) AS r FROM pairs WHERE abs(r) > 0.5""",
)
def medium_pairs(spark, sf):
    return rounded(correlation.strong_pairs(_pairs(spark, sf), 0.5, False).select("left", "right", "r"))


@register(
    "a19_correlation_summary",
    f"""WITH {LINES_SQL}, {PAIRS_SQL} SELECT round(min(r), 6) AS min_r, round(max(r), 6) AS max_r,
      round(avg(r), 6) AS mean_r, round(stddev_pop(r), 6) AS std_r, 2 * count(*) FILTER (abs(r) >= 0.7) AS n_high,
      2 * count(*) FILTER (abs(r) >= 0.5) AS n_medium, 2 * count(*) FILTER (abs(r) >= 0.3) AS n_low FROM pairs""",
)
def correlation_summary(spark, sf):
    return rounded(correlation.correlation_summary(_pairs(spark, sf)))


@register(
    "a20_prediction_distribution",
    f"""WITH {LINES_SQL}, {PREDICTIONS_SQL}, p AS (SELECT * FROM predictions WHERE model = 'year')
    SELECT prediction AS value, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM p), 6) AS pct
    FROM p GROUP BY prediction""",
)
def prediction_distribution(spark, sf):
    predictions = example_predictions(spark, sf).where("model = 'year'")
    return rounded(profiling.class_distribution(predictions, "prediction"))


PROFILE_NUMBERS = ["sales", "quantity", "discount", "order_total", "scheduled_days"]
PROFILE_TEXTS = ["priority", "market", "region", "category"]
_NUMBER_STATS = {
    "count": "count({c})", "n_null": "count(*) - count({c})", "mean": "avg({c})", "std": "stddev_samp({c})", "min": "min({c})", "max": "max({c})",
    "q25": "any_value({c}_1)", "median": "any_value({c}_2)", "q75": "any_value({c}_3)",
    "lower": "any_value({c}_1 - 1.5 * ({c}_3 - {c}_1))", "upper": "any_value({c}_3 + 1.5 * ({c}_3 - {c}_1))",
    "n_outside": "count(*) FILTER (NOT {in})", "whisker_low": "min({c}) FILTER ({in})", "whisker_high": "max({c}) FILTER ({in})",
    "label_correlation": "corr({c}, late)",
}


def _profile_sql() -> str:
    def inside(c: str) -> str:
        return f"{c} >= {c}_1 - 1.5 * ({c}_3 - {c}_1) AND {c} <= {c}_3 + 1.5 * ({c}_3 - {c}_1)"

    quartiles = ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), {p}) AS {c}_{i}" for c in PROFILE_NUMBERS for i, p in ((1, 0.25), (2, 0.5), (3, 0.75)))
    numbers = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{s}' AS stat, CAST({e.replace('{c}', c).replace('{in}', inside(c))} AS DOUBLE) AS value FROM lines, q"""
        for c in PROFILE_NUMBERS
        for s, e in _NUMBER_STATS.items()
    )
    texts = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {s} AS stat, CAST({e} AS DOUBLE) AS value FROM {source}"""
        for c in PROFILE_TEXTS
        for s, e, source in (
            ("'count'", f"count({c})", "lines"), ("'n_null'", f"count(*) - count({c})", "lines"), ("'n_distinct'", f"count(DISTINCT {c})", "lines"),
            ("'freq'", "max(n)", f"(SELECT count(*) AS n FROM lines GROUP BY {c})"),
            (f"'n of ' || {c}", "count(*)", f"lines GROUP BY {c} HAVING (SELECT count(DISTINCT {c}) FROM lines) <= 10"),
        )
    )
    return f"""WITH {LINES_SQL}, q AS (SELECT {quartiles} FROM lines), answers AS ({numbers} UNION ALL {texts}
      UNION ALL SELECT '*', 'n_rows', count(*) FROM lines
      UNION ALL SELECT '*', 'class_' || late, count(*) FROM lines GROUP BY late)
    SELECT "column", stat, round(value, 4) AS value FROM answers"""


@register("a_profile", _profile_sql())
def whole_profile(spark, sf):
    """The exploratory profile of order lines, from one narrow copy of them."""
    lines = order_lines(spark, sf, [*PROFILE_NUMBERS, *PROFILE_TEXTS, "late"])
    return rounded(profile(lines, PROFILE_NUMBERS, PROFILE_TEXTS, "late"), 4)
