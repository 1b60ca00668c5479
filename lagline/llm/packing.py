"""Packing of documents into sequences along a space-filling curve.

A document's token ids are hashed into a vector that is projected to three dimensions: each id
adds its own row of signs. The point's Hilbert index is the sort key, so neighbours on the curve
are documents of like vocabulary. The keys are range-sorted, running totals give every document
its place in one long stream, and the stream is cut every ``size`` ids: only the very last
sequence has padding. The ids themselves are shuffled once, to meet their places.

Defined cases: a null text is empty and has the end id alone; every row is packed, repeated ones
too; equal keys are ordered by a hash of the row number, and the range sort may cut within them,
so copies of one text never have to share a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagline.llm.batches import TEXT_BYTES, by_size
from lagline.llm.staging import shuffle_partitions, staged
from lagline.llm.tokens import word_encoder

SEQUENCE = 4096
END_ID = 2
DIMENSIONS = 3
BITS = 16
SPREAD = 4.0  # how far means of signs are stretched before they are squashed to the curve's range


def signs(ids: np.ndarray) -> np.ndarray:
    """The fixed row of +1 and -1 of each id, from a multiplicative hash."""
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    bits = (mixed[:, None] >> np.arange(61, 61 - DIMENSIONS, -1, dtype=np.uint64)) & np.uint64(1)
    return bits.astype(np.float32) * 2 - 1


def hilbert_index(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index along the Hilbert curve of integer points, one row each."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations of each level, from the coarsest
        low = q - 1
        for i in range(n):
            inside = (x[i] & q) != 0
            swap = np.where(inside, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(inside, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):  # Gray code of the octants
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where((x[n - 1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << 1) | ((x[i] >> b) & 1)
    return index


def sign_sums(table: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of the ids' signs, a row for each document; ``table`` has a row of all ids' signs per dimension."""
    ends = np.cumsum(counts)
    running = (np.append(0, np.cumsum(row[ids], dtype=np.int64)) for row in table)
    return np.stack([r[ends] - r[ends - counts] for r in running], axis=1)


def curve_keys(sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Hilbert keys of documents from the sums of their ids' sign rows."""
    mean = sums / np.maximum(counts, 1)[:, None]
    unit = 0.5 + 0.5 * np.tanh(SPREAD * mean)
    top = (1 << BITS) - 1
    return hilbert_index(np.minimum((unit * (top + 1)).astype(np.int64), top))


def _encoded(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        narrow = np.uint16 if encoder.vocabulary <= 1 << 16 and end_id < 1 << 16 else np.uint32
        table = signs(np.arange(encoder.vocabulary)).astype(np.int8).T.copy()
        for part in by_size(batches, size=TEXT_BYTES):
            ids = encoder.many([t or "" for t in part.column("text").to_pylist()])
            counts = np.fromiter(map(len, ids), np.int64, len(ids))
            sums = sign_sums(table, np.concatenate(ids), counts)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(counts + 1, pa.int64()),
                    pa.array(curve_keys(sums, counts), pa.int64()),
                    pa.array([np.append(x, end_id).astype(narrow).tobytes() for x in ids], pa.binary()),
                ],
                names=["doc_id", "n_ids", "curve", "ids"],
            )

    return run


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, total = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.column("n_ids").to_numpy()
        ends = total + np.cumsum(n)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(np.full(len(n), part), pa.int32()), pa.array(ends - n, pa.int64()), pa.array(ends, pa.int64())],
            names=["row", "part", "before", "until"],
        )
        total = int(ends[-1]) if len(n) else total


def _cut(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in by_size(batches, "ids", TEXT_BYTES):
            out: list[tuple] = []
            columns = (part.column(c).to_pylist() for c in ("doc_id", "n_ids", "place", "ids"))
            for doc_id, n, place, raw in zip(*columns):
                ids = np.frombuffer(raw, np.uint16 if len(raw) == 2 * n else np.uint32).astype("<u4")
                start = 0
                while start < n:
                    offset = (place + start) % size
                    length = min(size - offset, n - start)
                    out.append((doc_id, start, length, ids[start : start + length].tobytes(), n, (place + start) // size, offset))
                    start += length
            if out:
                kinds = (part.column("doc_id").type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
                names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return run


def pack(docs: DataFrame, tokenizer_path: str, size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Pieces of documents: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are the piece's token ids as little-endian unsigned 32-bit numbers.
    """
    spark = docs.sparkSession
    id_type = docs.schema["doc_id"].dataType.simpleString()
    encoded = docs.select("doc_id", "text").mapInArrow(_encoded(tokenizer_path, end_id), f"doc_id {id_type}, n_ids long, curve long, ids binary")
    encoded = staged(encoded.withColumn("row", F.monotonically_increasing_id()), "packing-ids")
    order = ["curve", "tie", "row"]
    keys = encoded.select("row", "n_ids", "curve", F.xxhash64("row").alias("tie"))
    along = keys.repartitionByRange(shuffle_partitions(docs), *order).sortWithinPartitions(*order)
    along = staged(along.mapInArrow(_running, "row long, part int, before long, until long"), "packing-places")
    totals = along.groupBy("part").agg(F.max("until").alias("n")).orderBy("part").collect()  # a row per partition
    bases = np.cumsum([0] + [r["n"] for r in totals]).tolist()
    base = spark.createDataFrame([(r["part"], b) for r, b in zip(totals, bases)], "part int, base long")
    places = along.join(F.broadcast(base), "part").select("row", (F.col("base") + F.col("before")).alias("place"))
    pieces = f"doc_id {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return encoded.select("row", "doc_id", "n_ids", "ids").join(places, "row").drop("row").mapInArrow(_cut(size), pieces)
