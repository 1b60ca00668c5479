"""The test tables and the flat order-line table built from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagline.functions.labels import late_label
from lagline.session import scratch_path, shares_of, stage_parts

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

# Scheduled days by order priority: a fixed rule of the test data, not business data.
SCHEDULED_BY_PRIORITY = {"1-URGENT": 0, "2-HIGH": 1, "3-MEDIUM": 2}
SCHEDULED_OTHERWISE = 4

FROM_ORDERS = {"order_ts", "real_days", "scheduled_days", "late", "priority", "order_total"}
FROM_CUSTOMER = {"segment", "balance"}
FROM_NATION = {"region"}
FROM_REGION = {"market"}
FROM_PART = {"category", "product", "brand", "unit_price", "size"}

NUMERIC = ["sales", "quantity", "discount", "tax", "unit_price", "order_total", "scheduled_days"]
CATEGORIES = ["priority", "market", "region", "category"]


SMALL_INPUT_SPLITS = 16
SHARE_BYTES, MOST_SHARES = 512 << 20, 16  # of order lines that are joined at once


def spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Give a small input at least one partition per core.

    One small file is read by one task, whatever follows it. Inputs with more splits than
    ``SMALL_INPUT_SPLITS`` (about 2 GB) are left as they are and never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= min(cores, SMALL_INPUT_SPLITS):
        return df
    return df.repartition(cores, *keys)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str, columns: Sequence[str], share: tuple[int, int] | None = None) -> DataFrame:
    """Order lines with the asked columns; only the tables these need are joined.

    The small sides are left to Spark's own size check for broadcasting; the join with
    orders is a shuffle join at scale, where adaptive execution splits hot keys. What belongs to
    an order is joined to the orders, which are fewer, so a line is shuffled for its part and its order only.
    ``share`` (k, n) asks for the lines of about every n-th order.
    """
    wanted = set(columns)
    lines = _share(spread(read_table(spark, sf_dir, "lineitem"), LINE_KEY), "l_orderkey", share)
    if wanted & FROM_PART:
        part = read_table(spark, sf_dir, "part")
        lines = lines.join(part, F.col("l_partkey") == part["p_partkey"])
    beyond_orders = wanted & (FROM_CUSTOMER | FROM_NATION | FROM_REGION)
    if wanted & FROM_ORDERS or beyond_orders:
        orders = read_table(spark, sf_dir, "orders")
        if orders.schema["o_orderkey"].dataType == lines.schema["l_orderkey"].dataType:  # equal keys have equal hashes
            orders = _share(orders, "o_orderkey", share)
        if beyond_orders:
            customer = read_table(spark, sf_dir, "customer")
            if wanted & (FROM_NATION | FROM_REGION):
                nation = read_table(spark, sf_dir, "nation")
                customer = customer.join(nation, F.col("c_nationkey") == nation["n_nationkey"])
            if wanted & FROM_REGION:
                region = read_table(spark, sf_dir, "region")
                customer = customer.join(region, F.col("n_regionkey") == region["r_regionkey"])
            orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.select(*[_EXPRESSIONS[c]().alias(c) for c in columns])


def _share(df: DataFrame, key: str, share: tuple[int, int] | None) -> DataFrame:
    return df if share is None else df.where(F.pmod(F.xxhash64(key), F.lit(share[1])) == share[0])


def staged_lines(spark: SparkSession, sf_dir: str, columns: Sequence[str], share_bytes: int = SHARE_BYTES) -> DataFrame:
    """``order_lines`` written once, for work that scans it more than once: its joins shuffle every line.

    Large inputs are joined in shares, each giving its shuffle files up before the next, so these never
    take more than the files of one share.
    """
    n = shares_of(read_table(spark, sf_dir, "lineitem"), share_bytes, MOST_SHARES)
    shares = [(k, n) for k in range(n)] if n > 1 else [None]
    return stage_parts((order_lines(spark, sf_dir, columns, share) for share in shares), scratch_path(spark, "order-lines"))


def _scheduled():
    rule = F.lit(SCHEDULED_OTHERWISE)
    for priority, days in SCHEDULED_BY_PRIORITY.items():
        rule = F.when(F.col("o_orderpriority") == priority, days).otherwise(rule)
    return rule


def _real():
    return F.datediff("l_shipdate", "o_orderdate")


_EXPRESSIONS = {
    **{k: (lambda k=k: F.col(k)) for k in LINE_KEY},
    "order_ts": lambda: F.col("o_orderdate"),
    "ship_ts": lambda: F.col("l_shipdate"),
    "real_days": _real,
    "scheduled_days": _scheduled,
    "late": lambda: late_label(_real(), _scheduled()),
    "priority": lambda: F.col("o_orderpriority"),
    "order_total": lambda: F.col("o_totalprice"),
    "segment": lambda: F.col("c_mktsegment"),
    "balance": lambda: F.col("c_acctbal"),
    "region": lambda: F.col("n_name"),
    "market": lambda: F.col("r_name"),
    "category": lambda: F.col("p_type"),
    "product": lambda: F.col("p_name"),
    "brand": lambda: F.col("p_brand"),
    "unit_price": lambda: F.col("p_retailprice"),
    "size": lambda: F.col("p_size"),
    "sales": lambda: F.col("l_extendedprice"),
    "quantity": lambda: F.col("l_quantity"),
    "discount": lambda: F.col("l_discount"),
    "tax": lambda: F.col("l_tax"),
    "net_sales": lambda: F.col("l_extendedprice") * (1 - F.col("l_discount")),
    "return_flag": lambda: F.col("l_returnflag"),
    "line_status": lambda: F.col("l_linestatus"),
}

ALL_COLUMNS = list(_EXPRESSIONS)

# The same table for SQL checks, every column.
LINES_SQL = """
lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         o_orderdate AS order_ts, l_shipdate AS ship_ts,
         date_diff('day', o_orderdate, l_shipdate) AS real_days,
         CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1
              WHEN '3-MEDIUM' THEN 2 ELSE 4 END AS scheduled_days,
         CASE WHEN date_diff('day', o_orderdate, l_shipdate) >
              CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1
                   WHEN '3-MEDIUM' THEN 2 ELSE 4 END THEN 1 ELSE 0 END AS late,
         o_orderpriority AS priority, o_totalprice AS order_total,
         c_mktsegment AS segment, c_acctbal AS balance,
         n_name AS region, r_name AS market,
         p_type AS category, p_name AS product, p_brand AS brand,
         p_retailprice AS unit_price, p_size AS size,
         l_extendedprice AS sales, l_quantity AS quantity,
         l_discount AS discount, l_tax AS tax,
         l_extendedprice * (1 - l_discount) AS net_sales,
         l_returnflag AS return_flag, l_linestatus AS line_status
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
)"""
