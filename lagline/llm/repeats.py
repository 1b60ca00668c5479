"""Bytes that stand in a repeated string of ``LENGTH`` bytes, and texts without them.

Positions are sampled by a cover that follows the content: of the ``GRAM``-byte grams inside each
``LENGTH``-byte string the one with the smallest hash is its sample. Two equal strings have their
sample at the same offset, which is what a difference cover is for, with one sample in about 80
bytes. The strings of one sample are a block. Blocks get names by their content, and blocks
of one name are repeats as a whole. Where blocks share a sample but not a name, a repeat begins or
ends inside: there the names are refined, to pieces of ``PIECE`` strings at fixed distances from
the sample, and where pieces of one core still differ to single strings. One place stands for each name on
the way. A string that two places have is a repeat, so every place is judged and none is lost.

Names are 64-bit hashes of the bytes; places are never compared pairwise.

Defined cases: a null text is empty; texts shorter than ``LENGTH`` keep every byte; rows equal in
id and text are one document; a text's own repetitions count, overlapping ones too.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagline.llm import bitfilter
from lagline.llm.staging import released

LENGTH = 200
GRAM = 40
PIECE = 16  # starts of a piece of a block
STRETCH = 1 << 20  # starts that are looked at together, so long texts need no more memory

_BASE = 0x9E3779B97F4A7C15 | 1
_BYTES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_powers.get("up", ())) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


class Rolling:
    """Hashes of any stretch of a text in constant time."""

    def __init__(self, data: np.ndarray):
        up, self.down = _power_tables(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * up[: len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        return h


def samples(hashes: np.ndarray, width: int) -> np.ndarray:
    """Place of the first smallest hash of every run of ``width``."""
    best, span = np.arange(len(hashes)), 1
    while 2 * span <= width:
        left, right = best[:-span], best[span:]
        best, span = np.where(hashes[right] < hashes[left], right, left), 2 * span
    if span < width:
        left, right = best[: len(best) - (width - span)], best[width - span :]
        best = np.where(hashes[right] < hashes[left], right, left)
    return best


def _stretches(n: int) -> Iterator[tuple[int, int]]:
    """Ranges of starts, each looked at with the bytes that its strings need."""
    for first in range(0, n - LENGTH + 1, STRETCH):
        yield first, min(first + STRETCH, n - LENGTH + 1)


def blocks_of(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """(sample name, block name, first start, last start, sample place) of every block of a text."""
    out = []
    for lo, hi in _stretches(len(data)):
        rolling = Rolling(data[lo : hi + LENGTH - 1])
        at = np.arange(hi - lo + LENGTH - GRAM)
        grams = rolling.of(at, at + GRAM)
        sample = samples(grams, LENGTH - GRAM + 1)
        cuts = np.flatnonzero(sample[1:] != sample[:-1]) + 1
        first, last = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(sample)]]) - 1
        name = rolling.of(first, last + LENGTH)
        shape = ((sample[first] - first).astype(np.uint64) << np.uint64(32)) | (last - first).astype(np.uint64)
        name ^= (shape + np.uint64(1)) * np.uint64(_BASE)
        out.append((grams[sample[first]], name, first + lo, last + lo, sample[first] + lo))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else tuple(np.empty(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            found = [blocks_of(_bytes(t)) for t in part.column("text").to_pylist()]
            key = np.repeat(part.column("row_key").to_numpy(), [len(f[0]) for f in found])
            sample, name, first, last, place = (np.concatenate(c) for c in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key, pa.int64()),
                    pa.array(sample.view(np.int64)),
                    pa.array(name.view(np.int64)),
                    pa.array(first),
                    pa.array((last - first).astype(np.int32)),
                    pa.array(place),
                ],
                names=["row_key", "sample", "name", "first", "more", "at"],
            )


def _pieces(first: int, more: int, at: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last starts of a block's pieces, which are cut at fixed distances from the sample."""
    starts = np.arange(first, first + more + 1)
    cuts = np.flatnonzero(np.diff((at - starts) // PIECE)) + 1
    return starts[np.concatenate([[0], cuts])], starts[np.concatenate([cuts, [len(starts)]]) - 1]


def _refined(batches: Iterator[pa.RecordBatch], single: bool) -> Iterator[pa.RecordBatch]:
    """Names of the pieces, or of the single strings, of the wanted stretches of each text."""
    for batch in batches:
        for row in range(batch.num_rows):
            data = _bytes(batch.column("text")[row].as_py())
            wanted = batch.column("wanted")[row].as_py()
            key = batch.column("row_key")[row].as_py()
            for lo, hi in _stretches(len(data)):
                inside = [w for w in wanted if lo <= w["first"] < hi]
                if not inside:
                    continue
                rolling = Rolling(data[lo : hi + LENGTH - 1])
                if single:
                    parts = [(f := np.arange(w["first"], w["first"] + w["more"] + 1), f) for w in inside]
                else:
                    parts = [_pieces(w["first"], w["more"], w["at"]) for w in inside]
                sizes = [len(f) for f, _ in parts]
                first, last = (np.concatenate(c) for c in zip(*parts))
                alone, at = np.repeat([w["alone"] for w in inside], sizes), np.repeat([w["at"] for w in inside], sizes)
                name = rolling.of(first - lo, last - lo + LENGTH)
                distance = (at - first) // PIECE * PIECE
                core = at - distance - lo  # the bytes that all strings of a piece have, wherever it was cut
                cluster = rolling.of(core, core + LENGTH - PIECE + 1) ^ ((distance + 1).astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9))
                if not single:
                    shape = ((at - first).astype(np.uint64) << np.uint64(32)) | (last - first).astype(np.uint64)
                    name ^= (shape + np.uint64(1)) * np.uint64(_BASE)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
                columns = (np.full(len(first), key), cluster.view(np.int64), name.view(np.int64), first, last - first, at, alone)
                names = ["row_key", "sample", "name", "first", "more", "at", "alone"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


_REFINED = "row_key long, sample long, name long, first long, more long, at long, alone boolean"


def _by_name(rows: DataFrame) -> DataFrame:
    """Per sample and name: the smallest place, and whether it is the only one."""
    place = F.struct("row_key", "first", "more", "at", "alone")
    names = rows.groupBy("sample", "name").agg(F.min(place).alias("lo"), F.max(F.struct("row_key", "first")).alias("hi"))
    only = (F.col("lo.row_key") == F.col("hi.row_key")) & (F.col("lo.first") == F.col("hi.first"))
    return names.select("sample", "name", "lo", only.alias("only"))


def _undecided(names: DataFrame) -> DataFrame:
    """``row_key, wanted``: a place for each name of the samples that have several names and an undecided place."""
    undecided = F.col("only") & F.col("lo.alone")
    mixed = names.groupBy("sample").agg(F.count("*").alias("n"), F.bool_or(undecided).alias("some")).where("n > 1 AND some").select("sample")
    wanted = names.join(mixed, "sample").select("lo.row_key", F.struct("lo.first", "lo.more", "lo.at", undecided.alias("alone")).alias("w"))
    return released(wanted.groupBy("row_key").agg(F.collect_list("w").alias("wanted")), "repeat-wanted")


def repeated(docs: DataFrame) -> DataFrame:
    """``row_key, spans``: ranges (start, end) of bytes that repeated strings cover, not yet united."""
    texts = docs.select(F.xxhash64("doc_id", F.xxhash64("text")).alias("row_key"), "text")
    covered = [F.col("first").alias("start"), (F.col("first") + F.col("more") + LENGTH).alias("end")]

    blocks = released(texts.mapInArrow(_blocks, "row_key long, sample long, name long, first long, more int, at long"), "repeat-blocks")
    names = released(_by_name(blocks.withColumn("alone", F.lit(True))), "repeat-names")
    whole = blocks.select("name", "row_key", "first", "more").join(names.where("NOT only").select("name").distinct(), "name")
    found = whole.select("row_key", *covered)

    wanted = _undecided(names)
    near = released(texts.where(bitfilter.passes(wanted, "row_key", F.col("row_key"))).dropDuplicates(["row_key"]).join(wanted, "row_key"), "repeat-texts")
    pieces = released(near.mapInArrow(lambda b: _refined(b, False), _REFINED), "repeat-pieces")
    names = released(_by_name(pieces), "repeat-names")
    same = pieces.where("alone").join(names.where("NOT only").select("sample", "name"), ["sample", "name"])
    found = found.union(same.select("row_key", *covered))

    wanted = _undecided(names)
    strings = near.drop("wanted").join(wanted, "row_key").mapInArrow(lambda b: _refined(b, True), _REFINED)
    strings = released(strings.select("row_key", "name", "first", "more", "alone"), "repeat-strings")
    spot = F.struct("row_key", "first")
    twice = strings.groupBy("name").agg(F.min(spot).alias("lo"), F.max(spot).alias("hi")).where("lo <> hi").select("name")
    found = found.union(strings.where("alone").join(twice, "name").select("row_key", *covered))
    return found.groupBy("row_key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def united(spans: list[dict], n: int) -> list[tuple[int, int]]:
    """Maximal runs of covered bytes."""
    depth = np.zeros(n + 1, np.int64)
    np.add.at(depth, [s["start"] for s in spans], 1)
    np.add.at(depth, [s["end"] for s in spans], -1)
    inside = np.concatenate([[False], np.cumsum(depth)[:n] > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: removed byte ranges and the remaining bytes of every document.

    Rows equal in id and text come out once, with repeats or without. Texts of other rows without
    repeats aren't shuffled, but for the filter's few mistakes.
    """
    found = released(repeated(docs), "repeat-spans")
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", F.xxhash64("text")).alias("row_key"))
    again = rows.select("row_key").groupBy("row_key").agg(F.count("*").alias("n")).where("n > 1").select("row_key")
    looked_at = released(found.select("row_key").union(again), "repeat-keys")
    rows = rows.withColumn("may", bitfilter.passes(looked_at, "row_key", F.col("row_key")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sizes, removed, kept = [], [], []
                for text, spans in zip(part.column("text").to_pylist(), part.column("spans").to_pylist()):
                    data = (text or "").encode()
                    runs = united(spans, len(data)) if spans else []
                    ends = [0, *(e for _, e in runs)]
                    kept.append(b"".join(data[s:e] for s, e in zip(ends, [*(s for s, _ in runs), len(data)])))
                    removed.append([{"start": s, "end": e} for s, e in runs])
                    sizes.append(len(data))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, kind), pa.array(kept, pa.binary())],
                    names=["doc_id", "n_bytes", "spans", "kept"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    spans = "array<struct<start:long,end:long>>"
    met = rows.where("may").dropDuplicates(["row_key"]).join(found, "row_key", "left").select("doc_id", "text", "spans")
    rest = rows.where("NOT may").select("doc_id", "text", F.lit(None).cast(spans).alias("spans"))
    return met.union(rest).mapInArrow(run, f"doc_id {id_type}, n_bytes long, spans {spans}, kept binary")
