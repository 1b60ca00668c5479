"""Near duplicates by bottom-k sketches from one hash function.

Documents with the same shingle set are one node. Every node retains the ``KEPT`` smallest hashes
of its shingles; the inverted lists of retained values generate the overlaps. Two sets at the threshold
share at least ``shared_values`` retained values (22 at 0.8) but for odds of ``MISSED``, and all
they need if the sketch is the whole set. So, with a node's values ordered from rare to common, such
two nodes meet in the lists of their first ``KEPT`` less that number and one values, and a passage
that many documents share stands last and is in nobody's lists. The union-sketch filter loses a
pair at exactly the threshold with odds of about 1e-6 (five deviations), whole sets never.

Long lists are never multiplied out. A list's most connected node is its pivot, and a pivot's
canopy holds the nodes of all its lists, each once. A canopy is compared in blocks of bounded
size with larger sketches: where a sketch is the whole set the comparison is exact, else the
union sketch filters the pair and full sets confirm it. A block gives a spanning forest of its
links, not all of them. A second round compares only what then lies in different components, so
no link between components is missed.

Defined cases: null or wordless texts have an empty set and are linked with nothing; a text of
fewer words than a shingle has one shingle of all its words; rows equal in id and text are one
document; a null id is larger than all others.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagline.llm.batches import TEXT_BYTES, by_size
from lagline.llm.components import components
from lagline.llm.staging import fresh, released, shuffle_partitions

KEPT = 48  # retained values that are indexed
MISSED = 1e-7  # odds at which two sets at the threshold may share fewer retained values than the lists rely on
SKETCH = 256  # values of the sketches that are compared
BLOCK = 512  # nodes on a side of a block
SLACK = 5.0  # deviations below the threshold that a union sketch may show
FILTER_BITS = 26
CACHED_WORDS = 500_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)
_hashes: dict[bytes, int] = {}


def shared_values(percent: int) -> int:
    """The largest number that two sets of this similarity share of their retained values, but for odds of ``MISSED``.

    Each of the smallest ``KEPT`` values of the union is in both sets with the similarity as its odds.
    """
    p, below, m = percent / 100, 0.0, 0
    while m < KEPT and (below := below + math.comb(KEPT, m) * p**m * (1 - p) ** (KEPT - m)) <= MISSED:
        m += 1
    return max(m, 1)


def _word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_hashes) > CACHED_WORDS:
        _hashes.clear()
    get, put = _hashes.get, _hashes.setdefault
    return np.fromiter((get(w) or put(w, xxhash.xxh64_intdigest(w)) for w in words), np.uint64, len(words))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``size`` words."""
    words = (text or "").encode().lower().split()  # bytes: A-Z alone, and the six ASCII spaces
    if not words:
        return np.empty(0, np.uint64)
    h = _word_hashes(words)
    n = max(len(h) - size + 1, 1)
    mixed = np.full(n, len(h) if len(h) < size else size, np.uint64)
    for i in range(min(size, len(h))):
        mixed = (mixed ^ h[i : i + n]) * _MIX
        mixed ^= mixed >> np.uint64(32)
    mixed *= _MIX2
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def _sketched(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, size=TEXT_BYTES):
            sets = [shingle_set(t, size) for t in batch.column("text").to_pylist()]
            kept = [s[:KEPT].astype(np.int64) for s in sets]
            offsets = np.concatenate([[0], np.cumsum([len(k) for k in kept])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*kept, np.empty(0, np.int64)]), pa.int64())),
                ],
                names=["doc_id", "text_key", "n", "digest", "kept"],
            )

    return run


def _filter_slot(key) -> F.Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - FILTER_BITS)


def _sets_of(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """``node, n, shingles`` of the given nodes, from their texts.

    A bit filter of fixed size (8 MB) goes to the tasks, so that other texts aren't shuffled.
    """
    slots = nodes.select(_filter_slot("row_key").alias("s")).select(F.shiftright("s", 6).alias("w"), F.col("s").bitwiseAND(63).cast("int").alias("b"))
    found = slots.groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("bits")).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    bits[found.column("w").to_numpy()] = found.column("bits").to_numpy()
    held = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, size=TEXT_BYTES):
            slot = batch.column("slot").to_numpy()
            batch = batch.filter(pa.array((held.value[slot >> 6] >> (slot & 63)) & 1 == 1))
            if batch.num_rows:
                raw = [shingle_set(t, size).tobytes() for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("row_key"), pa.array(raw, pa.binary())], names=["row_key", "shingles"])

    texts = docs.select("text", F.xxhash64("doc_id", F.xxhash64("text")).alias("row_key")).withColumn("slot", _filter_slot("row_key"))
    made = texts.mapInArrow(run, "row_key long, shingles binary")
    return released(made.join(nodes, "row_key").groupBy("node").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles")), "near-sets")


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys from sorted batches, a run at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy() for k in keys])
        cuts = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1
        for s, e in zip([0, *cuts], [*cuts, batch.num_rows]):
            key = tuple(values[:, s])
            if key != last and held:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(s, e - s))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def compare_block(sketches: list[np.ndarray], sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sure, possible, estimate) of all pairs of a block, as square matrices.

    A pair is sure if both sketches are whole sets and reach the threshold; possible if the union
    sketch can't exclude it.
    """
    m = len(sketches)
    lengths = np.array([len(s) for s in sketches])
    flat = np.concatenate(sketches)
    row = np.repeat(np.arange(m), lengths)
    _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
    often = count > 1
    column = np.cumsum(often) - 1
    use = often[code]
    row, column = row[use], column[code[use]]
    both = np.zeros((m, m), np.float32)
    width = min(8192, int(often.sum()))
    for start in range(0, int(often.sum()), 8192):  # a slab of shared values at a time
        inside = (column >= start) & (column < start + width)
        slab = np.zeros((m, width), np.float32)
        slab[row[inside], column[inside] - start] = 1
        both += slab @ slab.T
    whole = lengths == sizes
    # A sketch that is a whole set covers all values, else those up to its largest.
    tops = np.array([np.iinfo(np.uint64).max if w or not len(s) else s[-1] for s, w in zip(sketches, whole)], np.uint64)
    upto = np.array([np.searchsorted(s, tops, side="right") for s in sketches])  # [j, i]: values of j up to top of i
    lower = tops[:, None] <= tops[None, :]
    own, other = np.where(lower, np.diag(upto)[:, None], upto), np.where(lower, upto.T, np.diag(upto)[None, :])
    union = np.maximum(own + other - both, 1)
    estimate = both / union
    exact = whole[:, None] & whole[None, :]
    sure = exact & (100 * both >= percent * union)
    floor = percent / 100 - SLACK * np.sqrt(percent / 100 * (1 - percent / 100) / union)
    possible = ~exact & (estimate >= floor) & (100 * np.minimum.outer(sizes, sizes) >= percent * np.maximum.outer(sizes, sizes))
    return sure, possible, estimate


def _forest(a: np.ndarray, b: np.ndarray, parent: dict) -> list[int]:
    """Positions of the edges that join two trees, taken in order."""

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    chosen = []
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
            chosen.append(i)
    return chosen


def _compared(percent: int, sparse: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["pivot", "i", "j"]):
            node, comp, block = (group.column(c).to_numpy() for c in ("node", "component", "block"))
            if group.num_rows < 2 or (comp == comp[0]).all():
                continue
            sketches = [np.frombuffer(s.as_py(), np.uint64) for s in group.column("sketch")]
            sure, possible, estimate = compare_block(sketches, group.column("n").to_numpy(), percent)
            i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
            apart = comp[:, None] != comp[None, :]
            if i != j:  # pairs inside a block are compared where the block meets itself
                apart &= block[:, None] != block[None, :]
            apart = np.triu(apart, 1)
            x, y = np.nonzero(apart & (sure | possible))
            if not len(x):
                continue
            certain = sure[x, y]
            order = np.lexsort((-estimate[x, y], ~certain))
            x, y, certain = x[order], y[order], certain[order]
            n_sure = int(certain.sum())
            parent: dict = {}
            take = _forest(comp[x[:n_sure]], comp[y[:n_sure]], parent)
            rest = _forest(comp[x[n_sure:]], comp[y[n_sure:]], parent) if sparse else range(len(x) - n_sure)
            take = np.array([*take, *(n_sure + k for k in rest)], np.int64)
            a, b = node[x[take]], node[y[take]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(certain[take])], names=["a", "b", "certain"]
            )

    return run


def _links(canopy: DataFrame, sets: DataFrame, labels: DataFrame, percent: int, sparse: bool) -> DataFrame:
    """Pairs (a, b, certain) of nodes in different components that are or may be linked."""
    rows = canopy.join(labels, "node").select("pivot", "node", "component")
    sizes = rows.groupBy("pivot").agg(F.count("*").alias("members"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    sizes = sizes.where("lo <> hi").select("pivot", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks"))
    small = sets.select("node", "n", F.substring("shingles", 1, 8 * SKETCH).alias("sketch"))
    rows = rows.join(sizes, "pivot").join(small, "node").withColumn("block", F.pmod(F.hash("node"), F.col("blocks")))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
    rows = rows.select("pivot", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "node", "n", "component", "block", "sketch")
    rows = rows.repartition(shuffle_partitions(canopy), "pivot", "i", "j").sortWithinPartitions("pivot", "i", "j")
    return rows.mapInArrow(_compared(percent, sparse), "a long, b long, certain boolean")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column("of_a"), batch.column("of_b")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").mapInArrow(run, "a long, b long")


def _lists(nodes: DataFrame, percent: int) -> DataFrame:
    """``value, node, weight``: the inverted lists of the nodes' rarest retained values."""
    postings = nodes.select("node", F.size("kept").alias("m"), F.explode("kept").alias("value"))
    often = postings.groupBy("value").agg(F.count("*").alias("freq")).where("freq > 1")
    whole = F.ceil(F.col("m") * percent / 100).cast("int")
    first = F.col("m") - F.least(F.lit(shared_values(percent)), whole) + 1
    shared = postings.join(often, "value").groupBy("node", "m").agg(F.sort_array(F.collect_list(F.struct("freq", "value"))).alias("values"))
    room = first - (F.col("m") - F.size("values"))  # values held by nobody else are the rarest
    weight = F.aggregate("values", F.lit(0).cast("long"), lambda s, v: s + v["freq"])
    shared = shared.withColumn("room", room).where("room > 0")
    return shared.select("node", weight.alias("weight"), F.explode(F.slice("values", 1, F.col("room"))).alias("v")).select("v.value", "node", "weight")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: ``doc_id, text_key, n_shingles, component_id, kept``.

    Linked are documents whose sets of ``size``-word shingles have a similarity of at least
    ``percent`` in a hundred; ``component_id`` is the smallest id that links reach.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    schema = f"doc_id {id_type}, text_key long, n long, digest binary, kept array<long>"
    made = released(texts.mapInArrow(_sketched(size), schema), "near-sketches")
    least = F.min(F.struct(F.isnull("doc_id"), "doc_id", F.xxhash64("doc_id", "text_key").alias("row_key")))
    grouped = made.where("n > 0").groupBy("digest").agg(least.alias("l"), F.first("n").alias("n"), F.first("kept").alias("kept"))
    grouped = grouped.select("digest", "n", "kept", F.col("l.doc_id").alias("least_id"), "l.row_key")
    nodes = released(grouped.withColumn("node", F.monotonically_increasing_id()), "near-nodes")

    lists = released(_lists(nodes, percent), "near-lists")
    pivots = lists.groupBy("value").agg(F.max(F.struct("weight", "node"))["node"].alias("pivot"), F.count("*").alias("c")).where("c > 1")
    canopy = released(lists.join(pivots, "value").select("pivot", "node").distinct(), "near-canopies")
    active = canopy.select("node").distinct()
    sets = _sets_of(docs, nodes.join(active, "node").select("node", "n", "row_key"), size)

    alone = active.withColumn("component", F.col("node"))
    first = released(_links(canopy, sets, alone, percent, sparse=True), "near-links")
    tried = first.select("a", "b").where("NOT certain").distinct()
    edges = released(first.where("certain").select("a", "b").union(_confirmed(tried, sets, percent)).distinct(), "near-edges")
    found = released(components(edges), "near-components")

    labels = active.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    second = released(_links(canopy, sets, labels, percent, sparse=False), "near-links")
    untried = second.where("NOT certain").select("a", "b").distinct().join(tried, ["a", "b"], "left_anti")
    more = released(second.where("certain").select("a", "b").union(_confirmed(untried, sets, percent)), "near-edges")
    if not more.isEmpty():
        found = released(components(edges.union(more)), "near-components")

    of_node = nodes.select("node", "digest", "least_id").join(found, "node", "left")
    of_node = of_node.withColumn("component", F.coalesce("component", "node"))
    least = of_node.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_digest = of_node.join(least, "component").select("digest", "component_id")
    own = made.select("doc_id", "text_key", "n", "digest").distinct()
    out = own.where("n > 0").join(of_digest, "digest").select("doc_id", "text_key", "n", "component_id")
    out = out.union(own.where("n = 0").select("doc_id", "text_key", "n", F.col("doc_id").alias("component_id")))
    return out.select("doc_id", "text_key", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def remove_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, the one with the smallest id, with all its columns."""
    kept_id, kept_key = fresh(docs, "kept_id"), fresh(docs, "kept_key")
    kept = near_duplicates(docs, size, percent).where("kept").select(F.col("doc_id").alias(kept_id), F.col("text_key").alias(kept_key))
    same = F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.xxhash64("text") == F.col(kept_key))
    return docs.join(kept, same, "left_semi").dropDuplicates(["doc_id", "text"])
