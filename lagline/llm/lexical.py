"""Ranked lexical search by max-sketches of documents, exact.

A term's impact on a document grows with its frequency alone, once the document is given. So the
impacts of a document fold into one small array: every distinct term is hashed to two coordinates
and each keeps the largest frequency it meets. The lesser of a term's two coordinates is never
below its frequency, whatever the corpus statistics turn out to be, and a query's weighted sum over
its terms is an upper bound of its score. Sketches have sixteen coordinates a distinct term or more,
so they grow with the text and are never full.

Queries are looked up in batches: a task holds sketches as rows of a matrix and bounds all queries
of a block at once. The documents with the highest bounds are rescored exactly from their texts;
the worst of a query's best scores then is its threshold, and every further document whose bound
reaches it is rescored, too. What stays below cannot be among the best, so nothing is lost.

The corpus is read three times, texts are shuffled only where they are rescored, and what a task
holds depends on a block of queries, not on the corpus. Queries are cut into blocks of bounded size.

Defined cases: null and wordless texts have no terms and are neither found nor counted; queries
without terms find nothing; queries equal in id and text are one; every document row is a document,
repeated ones too; equal scores go by id, a null id last.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lagline.llm import bitfilter
from lagline.llm.batches import by_size
from lagline.llm.staging import staged
from lagline.llm.text import ALNUM_WORD, words

BEST = 20
SEEDS = 4 * BEST  # documents of highest bound whose exact scores give the threshold
ROOM = 16  # coordinates to a distinct term, rounded up to a power of two in all
FULL = 255  # the largest frequency a coordinate tells apart
BLOCK_QUERIES = 256
BLOCK_TERMS = 50_000  # (query, term) pairs of a block
TERM_SLICE = 2048
CELLS = 4 << 20  # coordinates or impacts that are handled at once
VOCABULARY_BITS = 23  # 1 MB at any number of queries
CACHED_TERMS = 300_000
HASH_SEED = 42  # the seed of the engine's own xxhash64
TERM = re.compile(ALNUM_WORD.encode())  # on lower-cased UTF-8 bytes

# Fixed values of the score: 1000 tf / (1000 tf + 12 m) in millionths, m = 75 + 25 n / mean n.
SCALE, STEP, DAMP, BASE, SLOPE = 1_000_000_000, 1000, 12, 75, 25


class _Hashes(dict):
    """64-bit hash of each term, computed once."""

    def __missing__(self, term: bytes) -> int:
        if len(self) >= CACHED_TERMS:
            self.clear()
        self[term] = found = xxhash.xxh64_intdigest(term, HASH_SEED)
        return found


def terms_of(text: bytes | None) -> list[bytes]:
    return TERM.findall((text or b"").lower())


def lengths(n: int, documents: int, occurrences: int) -> int:
    """m of a document with ``n`` terms."""
    return BASE + SLOPE * n * documents // occurrences


# --- sketches -------------------------------------------------------------------


def sketch_sizes(distinct: np.ndarray) -> np.ndarray:
    """Coordinates of sketches: a power of two, at least 64; none for a text without terms."""
    return np.where(distinct > 0, np.exp2(np.ceil(np.log2(np.maximum(distinct * ROOM, 64)))).astype(np.int64), 0)


def coordinates(hashes: np.ndarray, size: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """The two coordinates of each term in a sketch of ``size``."""
    low = np.uint64(size - 1) if np.isscalar(size) else (size - 1).astype(np.uint64)
    return (hashes & low).astype(np.int64), ((hashes >> np.uint64(32)) & low).astype(np.int64)


def fold(hashes: np.ndarray, times: np.ndarray, distinct: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sketches one after another, and the size of each, from the terms of consecutive documents."""
    sizes = sketch_sizes(distinct)
    at, own = np.repeat(np.cumsum(sizes) - sizes, distinct), np.repeat(sizes, distinct)
    cells = np.zeros(int(sizes.sum()), np.uint8)
    held = np.minimum(times, FULL).astype(np.uint8)
    for place in coordinates(hashes, own):
        np.maximum.at(cells, at + place, held)
    return cells, sizes


def _sketched(batches: Iterator[pa.RecordBatch], held: object) -> Iterator[pa.RecordBatch]:
    """Rows of documents (text_key, n, sketch) and of query terms (term, df) with what this task counted."""
    bits, known, seen = held.value, _Hashes(), Counter()
    names = ["text_key", "n", "sketch", "term", "df"]

    def counted() -> pa.RecordBatch:
        none = [pa.nulls(len(seen), t) for t in (pa.int64(), pa.int64(), pa.binary())]
        out = [*none, pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())]
        seen.clear()
        return pa.RecordBatch.from_arrays(out, names=names)

    for part in by_size(batches):
        total, found = [], []
        for text in part.column("text").to_pylist():
            own = terms_of(text)
            total.append(len(own))
            found.append(Counter(own))
        terms = [t for c in found for t in c]
        hashes = np.fromiter(map(known.__getitem__, terms), np.uint64, len(terms))
        times = np.fromiter((n for c in found for n in c.values()), np.int64, len(terms))
        cells, sizes = fold(hashes, times, np.fromiter(map(len, found), np.int64, len(found)))
        offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
        sketches = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(cells)])
        none = [pa.nulls(len(sizes), t) for t in (pa.binary(), pa.int64())]
        yield pa.RecordBatch.from_arrays([part.column("text_key"), pa.array(total, pa.int64()), sketches, *none], names=names)
        slot = hashes >> np.uint64(64 - VOCABULARY_BITS)
        asked = (bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
        seen.update([terms[i] for i in np.flatnonzero(asked)])
        if len(seen) > CACHED_TERMS:
            yield counted()
    yield counted()


def _vocabulary(terms: DataFrame) -> np.ndarray:
    """A bit for every hash of a query term; gathered word by word, at most 2^(VOCABULARY_BITS - 6) of them."""
    slot = F.shiftrightunsigned(F.xxhash64("term"), 64 - VOCABULARY_BITS)
    parts = terms.select(F.shiftright(slot, 6).alias("w"), slot.bitwiseAND(63).cast("int").alias("b"))
    found = parts.groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("bits")).toArrow()
    bits = np.zeros(1 << (VOCABULARY_BITS - 6), np.int64)
    bits[found.column("w").to_numpy()] = found.column("bits").to_numpy()
    return bits.view(np.uint64)


# --- bounds ---------------------------------------------------------------------


class Block:
    """Queries of a block: their terms, weights (repeats included) and thresholds, and the corpus counts."""

    def __init__(self, rows: list[tuple[int, bytes, int]], queries: int, documents: int, occurrences: int, least: dict[int, int] | None = None) -> None:
        self.queries, self.documents, self.occurrences = queries, documents, occurrences
        self.terms: list[list[tuple[bytes, int]]] = [[] for _ in range(queries)]
        number: dict[bytes, int] = {}
        for query, term, weight in rows:
            self.terms[query].append((term, weight))
            number.setdefault(term, len(number))
        self.hashes = np.fromiter((xxhash.xxh64_intdigest(t, HASH_SEED) for t in number), np.uint64, len(number))
        triples = sorted((number[term], query, weight) for query, term, weight in rows)
        self.at, self.of, self.weight = (np.array(c, np.int64) for c in (zip(*triples) if triples else ([], [], [])))
        # Sums of single precision may be too small by a rounding for each term and a few besides.
        self.safety = 1 + (np.array([len(t) for t in self.terms], np.float64) + 8) * 2.0**-23
        self.least = np.zeros(queries)
        for query, score in (least or {}).items():
            self.least[query] = score

    def bounds(self, sketches: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Upper bounds of all queries' scores: a row for each sketch (all of one size)."""
        damp = np.array([DAMP * lengths(int(x), self.documents, self.occurrences) / STEP for x in n], np.float32)[:, None]
        shown = np.arange(FULL + 1, dtype=np.float32)
        shown[FULL] = 1e9  # this frequency or a higher one
        out = np.zeros((len(sketches), self.queries), np.float32)
        for start in range(0, len(self.hashes), TERM_SLICE):
            one, two = coordinates(self.hashes[start : start + TERM_SLICE], sketches.shape[1])
            times = shown[np.minimum(sketches[:, one], sketches[:, two])]
            weights = np.zeros((times.shape[1], self.queries), np.float32)
            a, b = np.searchsorted(self.at, [start, start + TERM_SLICE])
            weights[self.at[a:b] - start, self.of[a:b]] = self.weight[a:b]
            out += (times * np.float32(SCALE / STEP) / (times + damp)) @ weights
        return out * self.safety

    def score(self, counts: Counter, n: int, query: int) -> int:
        """The exact score of a document with these term counts."""
        m = DAMP * lengths(n, self.documents, self.occurrences)
        return sum(w * (SCALE * tf // (STEP * tf + m)) for t, w in self.terms[query] if (tf := counts.get(t)))


def _bounded(batches: Iterator[pa.RecordBatch], block: Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys and bounds of documents, some at a time."""
    for batch in by_size(batches, "sketch", CELLS):
        raw = batch.column("sketch").to_pylist()
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        keys, n = batch.column("text_key").to_numpy(), batch.column("n").to_numpy()
        step = max(1, CELLS // max(1, min(TERM_SLICE, len(block.hashes))))
        for width in np.unique(size[size > 0]):
            same = np.flatnonzero(size == width)
            for at in range(0, len(same), step):
                some = same[at : at + step]
                matrix = np.frombuffer(b"".join([raw[i] for i in some]), np.uint8).reshape(len(some), width)
                yield keys[some], block.bounds(matrix, n[some])


def _highest(batches: Iterator[pa.RecordBatch], held: object, seeds: int) -> Iterator[pa.RecordBatch]:
    """The ``seeds`` highest bounds of each query in this task."""
    block = Block(*held.value)
    best, whose = np.zeros((0, block.queries)), np.zeros((0, block.queries), np.int64)
    for keys, bounds in _bounded(batches, block):
        best = np.concatenate([best, bounds])
        whose = np.concatenate([whose, np.broadcast_to(keys[:, None], bounds.shape)])
        if len(best) > seeds:
            top = np.argpartition(-best, seeds - 1, axis=0)[:seeds]
            best, whose = np.take_along_axis(best, top, 0), np.take_along_axis(whose, top, 0)
    row, query = np.nonzero(best > 0)
    columns = [pa.array(query.astype(np.int32)), pa.array(best[row, query]), pa.array(whose[row, query])]
    yield pa.RecordBatch.from_arrays(columns, names=["query", "bound", "text_key"])


def _reaching(batches: Iterator[pa.RecordBatch], held: object) -> Iterator[pa.RecordBatch]:
    """Documents with the queries whose thresholds their bounds reach."""
    block = Block(*held.value)
    for keys, bounds in _bounded(batches, block):
        row, query = np.nonzero((bounds >= block.least) & (bounds > 0))
        some, counts = np.unique(row, return_counts=True)
        offsets = np.append(0, np.cumsum(counts)).astype(np.int32)
        queries = pa.ListArray.from_arrays(pa.array(offsets), pa.array(query.astype(np.int32)))
        yield pa.RecordBatch.from_arrays([pa.array(keys[some]), queries], names=["text_key", "queries"])


def _rescored(batches: Iterator[pa.RecordBatch], held: object) -> Iterator[pa.RecordBatch]:
    """Exact scores above 0 of documents under the queries that ask for them."""
    block = Block(*held.value)
    for part in by_size(batches):
        out = []
        for doc_id, text, queries in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "queries"))):
            own = terms_of(text)
            counts = Counter(own)
            out += [(q, doc_id, s) for q in queries if (s := block.score(counts, len(own), q)) > 0]
        if out:
            kinds = (pa.int32(), part.schema.field("doc_id").type, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["query", "doc_id", "score"])


# --- search ---------------------------------------------------------------------


def _exact(texts: DataFrame, asked: DataFrame, held: object) -> DataFrame:
    """``query, doc_id, score`` of the documents asked for, the best of each query; ``asked`` has ``text_key, queries``."""
    id_type = texts.schema["doc_id"].dataType.simpleString()
    asked = asked.groupBy("text_key").agg(F.array_distinct(F.flatten(F.collect_list("queries"))).alias("queries"))
    near = texts.where(bitfilter.passes(asked, "text_key", F.col("text_key"))).join(asked, "text_key")
    scores = near.select("doc_id", "text", "queries").mapInArrow(partial(_rescored, held=held), f"query int, doc_id {id_type}, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scores.withColumn("rank", F.row_number().over(order))


def search(docs: DataFrame, items: DataFrame, best: int = BEST, seeds: int = SEEDS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``best`` documents of each item with scores above 0."""
    spark = docs.sparkSession
    send = spark.sparkContext.broadcast
    asked = items.select("item_id", "text").distinct().select("item_id", words(F.col("text")).alias("words"))
    asked = staged(asked.where(F.size("words") > 0).withColumn("item", F.monotonically_increasing_id()), "search-queries")
    pairs = asked.select("item", F.explode("words").alias("term")).groupBy("item", "term").agg(F.count("*").alias("repeats"))
    pairs = staged(pairs, "search-terms")

    texts = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("text_key"), F.col("text").cast("binary").alias("text"))
    schema = "text_key long, n long, sketch binary, term binary, df long"
    sketches = staged(texts.select("text_key", "text").mapInArrow(partial(_sketched, held=send(_vocabulary(pairs))), schema), "search-sketches")
    sums = sketches.where("n IS NOT NULL").agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("occurrences")).first()
    size = pairs.agg(F.count("*").alias("terms"), F.count_distinct("item").alias("queries")).first()
    blocks = max(math.ceil(size["terms"] / BLOCK_TERMS), math.ceil(size["queries"] / BLOCK_QUERIES))

    df = sketches.where("term IS NOT NULL").groupBy(F.col("term").cast("string").alias("term")).agg(F.sum("df").alias("df"))
    ratio = F.lit(2.0 * sums["documents"] + 2) / (2 * F.col("df") + 1)
    weight = F.floor(1000 * F.log(ratio)) * F.col("repeats")
    weighed = staged(pairs.join(df, "term").select("item", "term", weight.alias("weight")).where("weight > 0"), "search-weights")
    rows = sketches.where("n > 0").select("text_key", "n", "sketch")

    def of_block(number: int) -> DataFrame:
        mine = lambda frame: frame.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number)
        whose = [(r["item"], r["item_id"]) for r in mine(asked).select("item", "item_id").collect()]  # a block's queries
        at = {item: i for i, (item, _) in enumerate(whose)}
        terms = [(at[r["item"]], r["term"].encode(), r["weight"]) for r in mine(weighed).collect()]  # and their terms
        given = terms, len(whose), sums["documents"], sums["occurrences"]
        held = send(given)
        tops = rows.mapInArrow(partial(_highest, held=held, seeds=seeds), "query int, bound double, text_key long")
        by_bound = Window.partitionBy("query").orderBy(F.desc("bound"), "text_key")
        tops = tops.withColumn("place", F.row_number().over(by_bound)).where(F.col("place") <= seeds)
        tops = staged(tops.select("text_key", F.array("query").alias("queries")), "search-seeds")
        last = _exact(texts, tops, held).where(F.col("rank") == best).select("query", "score").collect()  # one a query
        held = send((*given, {r["query"]: r["score"] for r in last}))
        reaching = staged(rows.mapInArrow(partial(_reaching, held=held), "text_key long, queries array<int>"), "search-candidates")
        found = _exact(texts, reaching, held).where(F.col("rank") <= best)
        names = spark.createDataFrame([(at[item], item_id) for item, item_id in whose], f"query int, item_id {asked.schema['item_id'].dataType.simpleString()}")
        return found.join(F.broadcast(names), "query").select("item_id", "rank", "doc_id", "score")

    if not blocks or not sums["documents"]:
        of_type = {f.name: f.dataType.simpleString() for f in [docs.schema["doc_id"], items.schema["item_id"]]}
        return spark.createDataFrame([], f"item_id {of_type['item_id']}, rank int, doc_id {of_type['doc_id']}, score long")
    found = [of_block(b) for b in range(blocks)]
    return reduce(DataFrame.union, [staged(f, "search-best") for f in found] if blocks > 1 else found)
