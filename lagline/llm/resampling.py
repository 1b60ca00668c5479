"""Importance resampling: documents drawn so that their features look like a target's.

Features are the runs of up to ``order`` consecutive words, hashed into buckets. The texts of a
slice are joined with a sentinel that no word holds, one pattern pass finds all words, the places
of the documents in the joined text (searchsorted) tell which document a word belongs to, and runs
over two documents are masked before their buckets are counted.

A bucket's gain is the rounded log ratio of its smoothed shares in the target and in the documents;
a document's weight is the sum over its features. With Gumbel noise from a hash of the id added,
the highest scores are a draw without replacement by those weights. Ranks come from one range sort
of narrow rows and running counts per partition, so no task sees all rows.

Defined cases: a null text has no words; a null id is hashed as an empty one and comes last among
ties; every row gives a row, repeated ones too, tied in any order; an empty target or no documents
smooth to equal shares.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagline.llm.batches import by_size, ragged
from lagline.llm.staging import shuffle_partitions, staged
from lagline.llm.text import ALNUM_WORD, ascii_lower

BUCKETS = 10_000
ORDER = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
SENTINEL = b"\x00"
WORD = re.compile(ALNUM_WORD.encode())  # on UTF-8 bytes: those of other characters are above 0x7F
CACHED_WORDS = 500_000


class _Checksums(dict):
    """CRC-32 of each word, computed once."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = found = zlib.crc32(word)
        return found


def run_buckets(texts: list[bytes], order: int, buckets: int, known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text; then the document and the bucket of every run of up to ``order`` words."""
    places = np.cumsum([0, *(len(t) + len(SENTINEL) for t in texts)])[:-1]
    found = [(m.start(), m.group()) for m in WORD.finditer(SENTINEL.join(texts))]
    starts = np.fromiter((s for s, _ in found), np.int64, len(found))
    of = np.searchsorted(places, starts, side="right") - 1
    sums = [known[w] for _, w in found]
    documents, hashed = [], []
    for n in range(1, order + 1):
        if n > 1:  # a run's checksum goes on from that of the run without its last word
            sums = [zlib.crc32(w, zlib.crc32(b" ", c)) for c, (_, w) in zip(sums, found[n - 1 :])]
        own = of[: len(sums)] == of[n - 1 :]
        documents.append(of[: len(sums)][own])
        hashed.append(np.array(sums, np.int64)[own] % buckets)
    return np.bincount(of, minlength=len(texts)), np.concatenate(documents), np.concatenate(hashed)


def _features(batches: Iterator[pa.RecordBatch], order: int, buckets: int) -> Iterator[pa.RecordBatch]:
    known = _Checksums()
    for part in by_size(batches):
        n_words, document, bucket = run_buckets([t or b"" for t in part.column("text").to_pylist()], order, buckets, known)
        pair, times = np.unique(document * buckets + bucket, return_counts=True)
        sizes = np.bincount(pair // buckets, minlength=part.num_rows)
        columns = [
            part.column("doc_id"),
            pa.array(n_words.astype(np.int64)),
            pa.array(np.bincount(document, minlength=part.num_rows).astype(np.int64)),
            ragged((pair % buckets).astype(np.int32), sizes),
            ragged(times.astype(np.int32), sizes),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "bucket", "times"])


def features(docs: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id, n_words, n_features, bucket, times``: distinct buckets of each text and how often each occurs."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", ascii_lower(F.col("text")).cast("binary").alias("text"))
    schema = f"doc_id {id_type}, n_words long, n_features long, bucket array<int>, times array<int>"
    return texts.mapInArrow(partial(_features, order=order, buckets=buckets), schema)


def _summed(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        at = batch.column("bucket").flatten().to_numpy(zero_copy_only=False)
        np.add.at(total, at, batch.column("times").flatten().to_numpy(zero_copy_only=False).astype(np.int64))
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"])


def bucket_totals(found: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket; the driver gets at most a row per bucket."""
    parts = found.select("bucket", "times").mapInArrow(partial(_summed, buckets=buckets), "bucket int, n long")
    rows = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(buckets, np.int64)
    total[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return total


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of a bucket's smoothed share in the target to that in the documents."""
    s, t, buckets = documents.astype(np.float64), target.astype(np.float64), float(len(documents))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def _weighed(batches: Iterator[pa.RecordBatch], held: object) -> Iterator[pa.RecordBatch]:
    gain = held.value
    for batch in batches:
        own = gain[batch.column("bucket").flatten().to_numpy(zero_copy_only=False)] * batch.column("times").flatten().to_numpy(zero_copy_only=False)
        ends = np.cumsum(batch.column("bucket").value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        weight = np.diff(np.append(0, np.cumsum(own))[np.append(0, ends)])
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "n_words", "n_features")), pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their partition and how many eligible ones stand before and at them in it."""
    part, before = TaskContext.get().partitionId(), 0
    for batch in batches:
        nth = before + np.cumsum(batch.column("eligible").to_numpy(zero_copy_only=False).astype(np.int64))
        before = int(nth[-1]) if len(nth) else before
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(nth), part, np.int32)), pa.array(nth)], names=[*batch.schema.names, "part", "nth"])


def draw(
    docs: DataFrame,
    target: DataFrame,
    order: int = ORDER,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every document; ``rank`` is null where it isn't drawn.

    Of the documents with at least ``least_words`` words, ``percent`` in a hundred are drawn, rounded down.
    """
    spark = docs.sparkSession
    found = staged(features(docs, order, buckets), "resampling-features")
    wanted = features(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), order, buckets)
    gain = gains(bucket_totals(found, buckets), bucket_totals(wanted, buckets))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_words long, n_features long, weight long"
    weighed = found.mapInArrow(partial(_weighed, held=spark.sparkContext.broadcast(gain)), schema)

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(2.0**32)
    noise = F.floor(-1000 * F.log(-F.log(share)))
    scored = weighed.withColumn("score", F.col("weight") + noise).withColumn("eligible", F.col("n_words") >= least_words)
    # Ties beyond the id, in repeated rows only, are broken by the row's place so that they can be cut.
    scored = scored.withColumn("tie", F.xxhash64(F.monotonically_increasing_id()))
    along = [F.desc("eligible"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("tie")]
    ranged = scored.repartitionByRange(shuffle_partitions(docs), *along).sortWithinPartitions(*along).drop("tie")
    schema = f"{schema}, score long, eligible boolean, part int, nth long"
    ranged = staged(ranged.mapInArrow(_counted, schema), "resampling-order")
    held = ranged.groupBy("part").agg(F.max("nth").alias("n")).orderBy("part").collect()  # a row per partition
    before = np.cumsum([0] + [r["n"] for r in held]).tolist()
    bases = spark.createDataFrame([(r["part"], b) for r, b in zip(held, before)], "part int, base long")
    rank = F.col("base") + F.col("nth")
    rank = F.when(F.col("eligible") & (rank <= before[-1] * percent // 100), rank).alias("rank")
    return ranged.join(F.broadcast(bases), "part").select("doc_id", "n_words", "n_features", "weight", "score", rank)
