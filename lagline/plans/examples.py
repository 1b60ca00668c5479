"""Order-line test data as input of the plans: configuration and scored predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagline.plans.prepare import PrepareConfig
from lagline.sources.tables import LINE_KEY, order_lines, staged_lines

RAW_COLUMNS = [
    *LINE_KEY, "real_days", "scheduled_days", "order_ts", "priority", "market", "region", "segment",
    "category", "product", "sales", "quantity", "discount", "tax", "unit_price", "order_total",
]

LINES_CONFIG = PrepareConfig(
    real_days="real_days",
    scheduled_days="scheduled_days",
    order_date="order_ts",
    label="late",
    drop=["real_days", *LINE_KEY],
    drop_geography=["region"],
)


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat order-line table with every column the preparation looks at, joined and written once."""
    return staged_lines(spark, sf_dir, RAW_COLUMNS)


# Scores of the example models, as SQL text valid in Spark and in other engines. The
# first has few distinct probabilities, the second many, the third gives none.
YEAR_SCORE = "round(1 - (year(order_ts) - 1995) / 7.0, 3)"
PRICE_SCORE = "round(0.9 - 0.8 * sales / 105000, 4)"
RULE = "CASE WHEN scheduled_days < 2 THEN 1 ELSE 0 END"


def example_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, split, label, prediction, probability) of three rule-based models.

    One scan gives the rows of all models; the split follows the hash of the line key.
    """
    lines = order_lines(spark, sf_dir, [*LINE_KEY, "order_ts", "scheduled_days", "late", "sales"])
    digit = F.substring(F.md5(F.concat_ws("|", *LINE_KEY)), 1, 1)
    scored = lines.select(
        F.col("late").alias("label"),
        F.when(digit < "3", "test").otherwise("train").alias("split"),
        F.expr(YEAR_SCORE).cast("double").alias("year_score"),
        F.expr(PRICE_SCORE).cast("double").alias("price_score"),
        F.expr(RULE).alias("rule"),
    )

    def by_score(name: str, score: str):
        return F.struct(
            F.lit(name).alias("model"),
            (F.col(score) > 0.5).cast("int").alias("prediction"),
            F.col(score).alias("probability"),
        )

    rule = F.struct(
        F.lit("rule").alias("model"),
        F.col("rule").cast("int").alias("prediction"),
        F.lit(None).cast("double").alias("probability"),
    )
    models = F.array(by_score("year", "year_score"), by_score("price", "price_score"), rule)
    return scored.select("split", "label", F.inline(models)).select(
        "model", "split", "label", "prediction", "probability"
    )


PREDICTIONS_SQL = f"""
scored AS (
  SELECT late AS label,
         CASE WHEN substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 1, 1) < '3'
              THEN 'test' ELSE 'train' END AS split,
         CAST({YEAR_SCORE} AS DOUBLE) AS year_score,
         CAST({PRICE_SCORE} AS DOUBLE) AS price_score,
         {RULE} AS rule
  FROM lines
),
predictions AS (
  SELECT 'year' AS model, split, label, CAST(year_score > 0.5 AS INT) AS prediction, year_score AS probability FROM scored
  UNION ALL
  SELECT 'price', split, label, CAST(price_score > 0.5 AS INT), price_score FROM scored
  UNION ALL
  SELECT 'rule', split, label, CAST(rule AS INT), CAST(NULL AS DOUBLE) FROM scored
)"""
