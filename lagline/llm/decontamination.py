"""Benchmark decontamination: which words of which documents stand in a benchmark.

A window is ``size`` consecutive words of an item, or all words of a shorter one. The windows
form a hash set that every executor holds. Documents are scanned word by word: each window has
an anchor, its longest word, so only positions holding an anchor are looked at; there the
window around the position is hashed, looked up and compared word for word. The scan is one
generated pass over the text without a shuffle; only hits are gathered, by document.

A benchmark beyond ``BROADCAST_BYTES`` isn't sent to the executors: then every document window
meets the items' windows in a shuffle join. Both ways give the same hits.

Defined cases: null or wordless texts have no words and no hits; items without words have no
windows; an item with a null id still hits but isn't listed; rows equal in document id and text
are one document, a null id is an id like others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagline.llm.staging import fresh
from lagline.llm.text import ALNUM_WORD, words
from lagline.session import stage_table

WINDOW = 10
BROADCAST_BYTES = 16 << 20


def windows(items: DataFrame, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct windows of the items: ``gram, gram_words, anchor, anchor_at, items``."""
    split = items.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    starts = split.select(
        "item", "w", F.least(F.lit(size), F.size("w")).alias("k"),
        F.explode(F.sequence(F.lit(1), F.size("w") - F.least(F.lit(size), F.size("w")) + 1)).alias("s"),
    )
    grams = starts.select("item", "k", F.slice("w", F.col("s"), F.col("k")).alias("g"))
    longest = F.array_max(F.transform("g", lambda w, i: F.struct(F.length(w).alias("n"), w.alias("w"), (-i).alias("i"))))
    return (
        grams.select("item", "k", F.array_join("g", " ").alias("gram"), longest.alias("a"))
        .groupBy("gram")
        .agg(
            F.first("k").alias("gram_words"),
            F.first("a.w").alias("anchor"),
            (-F.first("a.i")).alias("anchor_at"),
            F.sort_array(F.collect_set("item")).alias("items"),
        )
    )


def _scan(texts: DataFrame, grams: DataFrame) -> DataFrame:
    """Hits by anchors; ``texts`` has ``w``, an empty marker word before the words."""
    marker = grams.sparkSession.range(1)
    nothing = marker.select(F.lit("").alias("anchor"), F.lit(0).alias("anchor_at"), F.lit(0).alias("gram_words"))
    probes = (
        grams.select("anchor", "anchor_at", "gram_words")
        .union(nothing)
        .groupBy("anchor")
        .agg(F.collect_set(F.struct("anchor_at", "gram_words")).alias("probes"))
    )
    sets = grams.select("gram", "items").union(marker.select(F.lit("").alias("gram"), F.array().cast("array<string>").alias("items")))
    sets = sets.withColumn("gram_hash", F.xxhash64("gram"))
    at_anchor = (
        texts.select("*", F.posexplode("w").alias("pos", "word"))
        .join(F.broadcast(probes), F.col("word") == F.col("anchor"))
        .select("doc_id", "text_key", "n_words", "w", "pos", F.explode("probes").alias("p"))
        .select("*", (F.col("pos") - F.col("p.anchor_at")).alias("start"), F.col("p.gram_words").alias("k"))
        .where((F.col("pos") == 0) | ((F.col("start") >= 1) & (F.col("start") + F.col("k") - 1 <= F.col("n_words"))))
        .select("doc_id", "text_key", "n_words", "start", "k", F.array_join(F.slice("w", F.col("start") + 1, F.col("k")), " ").alias("seen"))
        .withColumn("seen_hash", F.xxhash64("seen"))
    )
    same = (F.col("seen_hash") == F.col("gram_hash")) & (F.col("seen") == F.col("gram"))
    return at_anchor.join(F.broadcast(sets), same).select("doc_id", "text_key", "n_words", "start", "k", "items")


def _join(texts: DataFrame, grams: DataFrame) -> DataFrame:
    """The same hits by a shuffle join of all windows, for a benchmark of any size."""
    lengths = [r["gram_words"] for r in grams.select("gram_words").distinct().collect()]  # at most WINDOW values
    marks = texts.select("doc_id", "text_key", "n_words", F.lit(0).alias("start"), F.lit(0).alias("k"), F.array().cast("array<string>").alias("items"))
    hits = marks
    for k in lengths:
        fit = texts.where(F.col("n_words") >= k)
        seen = fit.select("doc_id", "text_key", "n_words", "w", F.explode(F.sequence(F.lit(1), F.col("n_words") - k + 1)).alias("start")).select(
            "doc_id", "text_key", "n_words", "start", F.lit(k).alias("k"), F.array_join(F.slice("w", F.col("start") + 1, k), " ").alias("gram")
        )
        hits = hits.union(seen.join(grams.where(F.col("gram_words") == k).select("gram", "items"), "gram").select(*marks.columns))
    return hits


def hits_by_document(
    docs: DataFrame,
    items: DataFrame,
    size: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per document: ``doc_id, text_key, n_words, spans, items``.

    ``spans`` are the hit windows as (start, k) in words from 1, sorted; ``items`` the sorted ids
    of the items that occur. A document's hits are bounded by its own words.
    """
    grams = stage_table(windows(items, size), "benchmark-windows")
    listed = F.aggregate("items", F.lit(0).cast("long"), lambda n, item: n + F.octet_length(item) + 24)
    held = grams.agg(F.coalesce(F.sum(2 * F.octet_length("gram") + 64 + listed), F.lit(0)).alias("b")).first()["b"]
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"), words(F.col(text_col)).alias("found"))
    texts = texts.select("doc_id", "text_key", F.size("found").alias("n_words"), F.concat(F.array(F.lit("")), F.col("found")).alias("w"))
    hits = _scan(texts, grams) if held <= broadcast_bytes else _join(texts, grams)
    return (
        hits.groupBy("doc_id", "text_key")
        .agg(
            F.max("n_words").alias("n_words"),
            F.sort_array(F.collect_set(F.when(F.col("k") > 0, F.struct("start", "k")))).alias("spans"),
            F.flatten(F.collect_set("items")).alias("items"),
        )
        .withColumn("items", F.sort_array(F.array_distinct("items")))
    )


def covered(spans) -> F.Column:
    """Words inside the union of sorted (start, k) spans."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    step = lambda acc, x: F.struct(
        (acc["n"] + F.greatest(F.lit(0), x["start"] + x["k"] - F.greatest(x["start"], acc["end"]))).alias("n"),
        F.greatest(acc["end"], x["start"] + x["k"]).alias("end"),
    )
    return F.aggregate(spans, zero, step, lambda acc: acc["n"])


def report(docs: DataFrame, items: DataFrame, size: int = WINDOW, **columns) -> DataFrame:
    """Per document: words, hit words, items found and whether it is contaminated."""
    found = hits_by_document(docs, items, size, **columns)
    return found.select(
        "doc_id",
        "text_key",
        F.col("n_words").cast("long").alias("n_words"),
        covered("spans").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        "items",
        (F.size("spans") > 0).alias("contaminated"),
        "spans",
    )


def remove_documents(docs: DataFrame, items: DataFrame, size: int = WINDOW, most_share: float = 0.0) -> DataFrame:
    """Documents whose share of hit words is at most ``most_share``, with all their columns."""
    bad = report(docs, items, size).where(F.col("n_hit") > most_share * F.col("n_words"))
    bad_id, bad_key = fresh(docs, "bad_id"), fresh(docs, "bad_key")
    bad = bad.select(F.col("doc_id").alias(bad_id), F.col("text_key").alias(bad_key))
    same = F.col("doc_id").eqNullSafe(F.col(bad_id)) & (F.xxhash64("text") == F.col(bad_key))
    return docs.join(bad, same, "left_anti")


def remove_spans(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``doc_id, text``: texts without their hit words; what stands between the words stays."""
    docs = docs.select("doc_id", "text")
    found = report(docs, items, size).select(F.col("doc_id").alias("hit_id"), "text_key", "spans")
    same = docs["doc_id"].eqNullSafe(F.col("hit_id")) & (F.xxhash64(docs["text"]) == F.col("text_key"))
    text = F.coalesce(F.col("text"), F.lit(""))
    word = ALNUM_WORD.replace(r"\x60", r"\x40\x5B-\x60")  # words of the text as it is, capitals too
    pairs = F.zip_with(F.split(text, word), F.regexp_extract_all(text, F.lit(word), F.lit(0)), lambda gap, own: F.struct(gap.alias("gap"), own.alias("own")))
    parts = docs.join(found, same)
    hit = lambda i: F.exists("spans", lambda s: (i + 1 >= s["start"]) & (i + 1 < s["start"] + s["k"]))
    kept = F.transform(pairs, lambda p, i: F.concat(p["gap"], F.when(hit(i), "").otherwise(F.coalesce(p["own"], F.lit("")))))
    return parts.select("doc_id", F.array_join(kept, "").alias("text"))
