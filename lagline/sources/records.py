"""Records of delimited text whose quoted fields hold line breaks, found in parallel.

A line begins a record if the quotes before it in its file are even in number (a doubled quote
counts as two). One scan adds up the quotes of every split; running sums over the splits of a file
tell whether a split begins inside quotes. A second scan cuts each split into records. What a split
cannot finish, at most one piece at either end, is put together with its neighbours' pieces; only
these pieces are shuffled. So one large file is read by as many tasks as it has splits.

Quotes may stand in quoted fields only, and lines end with a line feed, or carriage return and line
feed. The driver sees 16 bytes a split, not rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lagline.session import stage_table

QUOTE = '"'
WHOLE, HEAD, TAIL = 0, 1, 2  # a record; the end of one begun earlier; the beginning of one that goes on


def lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, split, value``: the raw lines and the split of the file they were read in."""
    text = spark.read.option("lineSep", "\n").text(path)
    found = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    return found.select("file", "block", F.xxhash64("file", "block").alias("split"), "value")


def quotes(value: str):
    """How many quotes a line has, whatever its encoding."""
    return F.octet_length(value) - F.octet_length(F.replace(F.col(value), F.lit(QUOTE), F.lit("")))


def _inside(text: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all splits, sorted, and whether each begins inside quotes."""
    sums = text.groupBy("file", "block", "split").agg((F.sum(quotes("value")) % 2).alias("odd"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    found = sums.select("split", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).cast("boolean").alias("inside")).toArrow()
    split, inside = (found.column(c).to_numpy() for c in ("split", "inside"))
    order = np.argsort(split)
    return split[order], inside[order]


def _cut(batches: Iterator[pa.RecordBatch], held: object) -> Iterator[pa.RecordBatch]:
    """Records and pieces of records of the splits of a partition, in their order."""
    known, inside_at = held.value
    split, place = None, ("", 0)
    inside = begun = first = False
    waiting: list[bytes] = []
    out: list[tuple] = []

    def close(kind: int) -> None:
        nonlocal first
        out.append((*place, kind, first, b"\n".join(waiting)))
        waiting.clear()
        first = False

    for batch in batches:
        quotes_of = pc.count_substring(batch.column("value"), QUOTE.encode()).to_pylist()
        files, blocks = batch.column("file"), batch.column("block")
        for i, (own, n, value) in enumerate(zip(batch.column("split").to_pylist(), quotes_of, batch.column("value").to_pylist())):
            if own != split:
                if waiting:
                    close(TAIL if begun else HEAD)
                at = np.searchsorted(known, own)
                if at == len(known) or known[at] != own:
                    raise ValueError("the splits of the input changed between two reads")
                split, place, inside = own, (files[i].as_py(), blocks[i].as_py()), bool(inside_at[at])
                begun, first = not inside, place[1] == 0
            waiting.append(value)
            inside ^= bool(n % 2)
            if not inside:
                close(WHOLE if begun else HEAD)
                begun = True
        if out:
            yield _rows(out)
            out.clear()
    if waiting:
        close(TAIL if begun else HEAD)
    if out:
        yield _rows(out)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["file", "block", "kind", "first", "record"])


def records(spark: SparkSession, path: str) -> DataFrame:
    """One row ``record`` (bytes) for every record below ``path``, without each file's first one and blank lines."""
    text = lines(spark, path)
    held = spark.sparkContext.broadcast(_inside(text))
    raw = text.select("file", "block", "split", F.col("value").cast("binary").alias("value"))
    schema = "file string, block long, kind int, first boolean, record binary"
    found = stage_table(raw.mapInArrow(lambda batches: _cut(batches, held), schema), "text-records", ["kind"])
    pieces = found.where(F.col("kind") != WHOLE)
    # A piece belongs to the last beginning at or before it in its file.
    begun = F.sum((F.col("kind") == TAIL).cast("int")).over(W.partitionBy("file").orderBy("block", "kind"))
    chains = pieces.select("file", "block", "kind", begun.alias("chain"))
    parts = F.array_sort(F.collect_list(F.struct("block", "kind", "first", "record"))).alias("parts")
    long = pieces.join(chains, ["file", "block", "kind"]).groupBy("file", "chain").agg(parts)
    glued = F.aggregate(
        F.slice("parts", 2, F.greatest(F.size("parts") - 1, F.lit(0))),
        F.col("parts")[0]["record"],
        lambda text, part: F.concat(text, F.lit(b"\n"), part["record"]),
    )
    long = long.select(F.col("parts")[0]["first"].alias("first"), glued.alias("record"))
    every = found.where(F.col("kind") == WHOLE).select("first", "record").unionAll(long)
    blank = F.trim(F.translate(F.col("record").cast("string"), "\r\t", "  ")) == ""
    return every.where(~F.col("first") & ~blank).select("record")
