"""Each document beside the next one in the order of falling ids, without a global window."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagline.llm.staging import shuffle_partitions, staged


def _part(key: Column, tops: list, id_type: str) -> Column:
    """How many of the falling ``tops`` stand before or at ``key``, less one.

    Two levels of bounds, so that a row looks at about twice the square root of their number.
    """
    bound = lambda t: F.struct(F.lit(t[0]).cast(id_type).alias("doc_id"), F.lit(t[1]).alias("text_key"))
    width = math.ceil(math.sqrt(len(tops)))
    rows = [tops[i : i + width] for i in range(0, len(tops), width)]
    row = F.size(F.filter(F.array(*[bound(r[0]) for r in rows]), lambda b: b >= key))
    inside = F.element_at(F.array(*[F.array(*[bound(t) for t in r]) for r in rows]), row)
    return (row - 1) * width + F.size(F.filter(inside, lambda b: b >= key)) - 1


def with_next(docs: DataFrame) -> tuple[DataFrame, Window]:
    """``doc_id, text_key, text, next_text, guest`` in parts of the id order, and the window over them.

    Ids are cut into ranges of about equal size; the first document of each range also stands as
    a guest at the end of the range before (the very first at the end of the last), so the next
    document is always in the same part and texts are shuffled once. Callers drop the guests when
    they need no further look ahead. Rows equal in id and text count once; null ids come last.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    keys = staged(docs.select("doc_id", F.xxhash64("text").alias("text_key")), "successor-keys")
    ranges = keys.repartitionByRange(2 * shuffle_partitions(docs), F.desc_nulls_last("doc_id"), F.desc("text_key"))
    tops = ranges.groupBy(F.spark_partition_id().alias("p")).agg(F.max(F.struct("doc_id", "text_key")).alias("t")).collect()
    tops = [(r["t"]["doc_id"], r["t"]["text_key"]) for r in sorted(tops, key=lambda r: r["p"])] or [(None, 0)]  # one a partition
    before = [(i, k, (n - 1) % len(tops)) for n, (i, k) in enumerate(tops)]
    hosts = docs.sparkSession.createDataFrame(before, f"top_id {id_type}, top_key long, host int")

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("text_key"))
    is_top = F.col("doc_id").eqNullSafe(F.col("top_id")) & (F.col("text_key") == F.col("top_key"))
    rows = rows.join(F.broadcast(hosts), is_top, "left").withColumn("part", _part(F.struct("doc_id", "text_key"), tops, id_type))
    places = F.array_compact(F.array(F.struct("part", F.lit(0).alias("guest")), F.when(F.col("host").isNotNull(), F.struct(F.col("host").alias("part"), F.lit(1).alias("guest")))))
    rows = rows.select("doc_id", "text_key", "text", F.inline(places))
    order = Window.partitionBy("part").orderBy("guest", F.desc_nulls_last("doc_id"), F.desc("text_key"))
    ahead = rows.select("*", F.lead(F.struct("doc_id", "text_key", "text", "guest")).over(order).alias("ahead"))
    again = F.col("ahead.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("ahead.text_key") == F.col("text_key")) & (F.col("ahead.guest") == F.col("guest"))
    ahead = ahead.where(~F.coalesce(again, F.lit(False)))
    return ahead.select("part", "doc_id", "text_key", "text", F.col("ahead.text").alias("next_text"), "guest"), order
