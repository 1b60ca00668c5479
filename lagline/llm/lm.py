"""Scores of texts by an n-gram language model in the form of a weighted backoff automaton.

The states are all n-grams of the training texts (those longer than a word that occur at least
``MIN_COUNT`` times, which is once), so the model grows with the corpus. States are keyed by 64-bit hashes
and dealt out in buckets of bounded size; no task, nor the driver, holds the model.

Documents are cut into chunks of bounded size, apart for training and held-out texts. Order by order,
from the longest n-grams to the words, a chunk sends each bucket its distinct n-grams with how often they
occur in it; the bucket adds them up and answers every chunk in the order in which it asked, so hashes
move once and answers have none. A state's arcs are the n-grams one word longer: the bucket that counts
one of those names one chunk as its owner, and the owner adds it to its context's arcs, which are sent
along with the context. So neither a frequent word nor its many arcs ever meet in one place.

Scoring: a chunk traverses its texts: an arc of the state (context and word kept) adds its discounted
share, the failure arc leads to the context of one word less, with the weight that the state's arcs
leave over, and last to the unigrams.

Defined cases: a null text is empty and has the end token alone; with no training documents all
scores are 0; every row gives a row, repeated ones too; a null id is training data. Two of V words
share a hash with odds of V * V / 2^65, a millionth for six million words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagline.llm.staging import released, shuffle_partitions
from lagline.llm.tokens import Codes

ORDER = 3
MIN_COUNT = 1  # every n-gram of the training texts is a state; more is a smaller model
DISCOUNT = 0.75
CHUNK_BYTES = 8 << 20  # of texts, at which a chunk ends
STRETCH = 2_000_000  # tokens, at which a chunk ends
PIECE = 2_000_000  # tokens of the corpus for each bucket
BUCKETS = 200  # or fewer, four a shuffle partition, while the corpus is small
END = b"\n"  # no word holds a line break


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def tokens(text: str | None) -> list[bytes]:
    """The words, then the end; bytes know A-Z and the six ASCII spaces only."""
    return [*(text or "").encode().lower().split(), END]


def _joined(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of the n-gram that ``word`` makes of ``context``."""
    h = (context ^ (context >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + word
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class _Open:
    """A chunk that is being filled."""

    def __init__(self) -> None:
        self.code = Codes()
        self.ids: list = []
        self.codes: list[np.ndarray] = []
        self.bytes = self.tokens = 0

    def add(self, doc_id: object, text: str | None) -> None:
        words = tokens(text)
        self.ids.append(doc_id)
        self.codes.append(np.fromiter(map(self.code.__getitem__, words), np.int32, len(words)))
        self.bytes += len(text or "")
        self.tokens += len(words)

    def row(self, chunk: int, held: bool, id_type: pa.DataType) -> pa.RecordBatch:
        lengths = np.fromiter(map(len, self.codes), np.int32, len(self.codes))
        words = np.fromiter(map(xxhash.xxh3_64_intdigest, self.code), np.uint64, len(self.code))
        values = [chunk, held, self.tokens, self.ids, _packed(lengths), _packed(np.concatenate(self.codes)), words.tobytes()]
        types = [pa.int64(), pa.bool_(), pa.int64(), pa.list_(id_type), pa.binary(), pa.binary(), pa.binary()]
        names = ["chunk", "held_out", "n_tokens", "ids", "lengths", "codes", "words"]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=names)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each chunk: its documents' ids and lengths, their words' codes, the hash of each code."""
    chunk, id_type = TaskContext.get().partitionId() << 32, None
    filling = {False: _Open(), True: _Open()}
    for batch in batches:
        id_type = batch.schema.field("doc_id").type
        for at in range(0, batch.num_rows, 256):
            columns = (batch.column(c).slice(at, 256).to_pylist() for c in ("doc_id", "held_out", "text"))
            for doc_id, held, text in zip(*columns):
                filling[held].add(doc_id, text)
                if filling[held].bytes > CHUNK_BYTES or filling[held].tokens > STRETCH:
                    yield filling[held].row(chunk, held, id_type)
                    chunk, filling[held] = chunk + 1, _Open()
    for held, rest in filling.items():
        if rest.ids:
            yield rest.row(chunk, held, id_type)
            chunk += 1


def _packed(codes: np.ndarray) -> bytes:
    """Codes byte plane by byte plane, since the high ones are nearly empty; compressed, as they move twice."""
    planes = codes.view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(codes).to_bytes(4, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpacked(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:4], "little")
    planes = pa.decompress(raw[4:], 4 * n, codec="zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(4, n).T.copy().view(np.int32).ravel()


def _columns_packed(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit integers of one length, byte plane by byte plane and compressed."""
    whole = np.stack([c.astype(np.uint64) for c in columns])
    planes = np.ascontiguousarray(whole.view(np.uint8).reshape(len(columns), -1, 8).transpose(0, 2, 1))
    return len(columns[0]).to_bytes(4, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _columns_unpacked(raw: bytes, columns: int) -> np.ndarray:
    n = int.from_bytes(raw[:4], "little")
    planes = np.frombuffer(pa.decompress(raw[4:], 8 * columns * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(columns, 8, n).transpose(0, 2, 1)).view(np.uint64).reshape(columns, n)


class _Distinct:
    """The distinct n-grams of one order in a chunk, sorted by hash; those of texts with room for them."""

    def __init__(self, grams: np.ndarray, at: np.ndarray) -> None:
        order = np.argsort(grams[at]).astype(np.int32)
        some = grams[at[order]]
        new = np.append(True, some[1:] != some[:-1])[: len(some)]
        starts = np.flatnonzero(new)
        self.at = at
        self.keys = some[starts]
        self.counts = np.diff(np.append(starts, len(some))).astype(np.int32)
        self.first = at[order[starts]]  # a position where each ends
        self.number = np.zeros(len(grams), np.int32)  # of the n-gram ending at each position
        self.number[at[order]] = np.cumsum(new, dtype=np.int32) - np.int32(1)


class _Chunk:
    """A chunk's texts and, by order, their distinct n-grams."""

    def __init__(self, row: dict) -> None:
        self.chunk, self.held, self.ids = row["chunk"], row["held_out"], row["ids"]
        self.lengths = _unpacked(row["lengths"])
        codes = _unpacked(row["codes"])
        self.grams = [np.frombuffer(row["words"], np.uint64)[codes]]
        starts = np.cumsum(self.lengths, dtype=np.int32) - self.lengths
        self.room = np.arange(len(codes), dtype=np.int32) - np.repeat(starts, self.lengths)

    def distinct(self, order: int) -> _Distinct:
        while len(self.grams) < order:
            gram = np.zeros_like(self.grams[0])
            gram[1:] = _joined(self.grams[-1][:-1], self.grams[0][1:])
            self.grams.append(gram)
        return _Distinct(self.grams[order - 1], np.flatnonzero(self.room >= order - 1).astype(np.int32))


def _answers(table: pa.Table, order: int, top: int) -> np.ndarray:
    """What the buckets answered for the n-grams of one order, in their order: count, owner, count without arcs, arcs."""
    some = sorted((bucket, body) for o, bucket, body in zip(*(table.column(c).to_pylist() for c in ("ord", "bucket", "body"))) if o == order)
    width = 2 if order == top else 4
    return np.concatenate([np.empty((width, 0), np.int64), *(_columns_unpacked(body, width).view(np.int64) for _, body in some)], axis=1)


def _asked(chunk: _Chunk, order: int, top: int, buckets: int, above: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, chunk, body): a chunk's n-grams of one order, with the arcs that it owns."""
    own = chunk.distinct(order)
    columns = [np.zeros_like(own.counts) if chunk.held else own.counts]
    if order < top:
        longer = chunk.distinct(order + 1)
        mine = above[1] == 1
        context = own.number[longer.first[mine] - 1]
        columns += [np.bincount(context, above[0][mine], len(own.keys)).astype(np.int64), np.bincount(context, minlength=len(own.keys))]
    bucket = (own.keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    cuts = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)]), len(bucket)).tolist()
    ranges = list(zip(cuts, cuts[1:]))
    for some in (ranges[i : i + 64] for i in range(0, len(ranges), 64)):
        bodies = [_columns_packed(np.diff(own.keys[s:e], prepend=np.uint64(0)), *(c[s:e] for c in columns)) for s, e in some]
        rows = [pa.array([int(bucket[s]) for s, _ in some], pa.int32()), pa.array([chunk.chunk] * len(some), pa.int64()), pa.array(bodies, pa.binary())]
        yield pa.RecordBatch.from_arrays(rows, names=["bucket", "chunk", "body"])


REQUEST = "bucket int, chunk long, body binary"
ANSWER = "ord int, bucket int, chunk long, body binary, n long, v long, once long, twice long"


def _asked_first(batches: Iterator[pa.RecordBatch], top: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Requests for the longest n-grams."""
    for batch in batches:
        for at in range(batch.num_rows):
            (row,) = batch.slice(at, 1).to_pylist()
            yield from _asked(_Chunk(row), top, top, buckets, None)


def _asked_next(chunks: pa.Table, answers: pa.Table, order: int, top: int, buckets: int) -> pa.Table:
    """Requests of a chunk that got the answers for n-grams of one word more."""
    (row,) = chunks.to_pylist()
    asked = _asked(_Chunk(row), order, top, buckets, _answers(answers, order + 1, top))
    return pa.Table.from_batches(asked, pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("body", pa.binary())]))


def _answered(table: pa.Table, order: int, top: int) -> pa.Table:
    """Answers of a bucket to all chunks that asked, and how many n-grams it holds."""
    width = 2 if order == top else 4
    asked = [_columns_unpacked(body, width) for body in table.column("body").to_pylist()]
    keys = np.concatenate([np.cumsum(a[0], dtype=np.uint64) for a in asked])
    by_key = np.argsort(keys, kind="stable")
    new = np.append(True, keys[by_key[1:]] != keys[by_key[:-1]])
    starts, group = np.flatnonzero(new), np.cumsum(new) - 1
    sums = [np.add.reduceat(np.concatenate([a[i] for a in asked]).view(np.int64)[by_key], starts) for i in range(1, width)]
    count = sums[0] if order == 1 else np.where(sums[0] >= MIN_COUNT, sums[0], 0)
    owner = np.zeros(len(keys), np.int64)
    owner[by_key[starts]] = count > 0
    back = [np.empty(len(keys), np.int64) for _ in range(width)]
    back[0][by_key], back[1] = count[group], owner
    if order < top:
        back[2][by_key], back[3][by_key] = (count - sums[1])[group], sums[2][group]
    ends = np.cumsum([a.shape[1] for a in asked])
    bodies = [_columns_packed(*(b[e - a.shape[1] : e] for b in back)) for a, e in zip(asked, ends)]
    facts = {"n": count.sum(), "v": (count > 0).sum(), "once": (count == 1).sum(), "twice": (count == 2).sum()}
    rest = [0] * (len(asked) - 1)
    columns = {"ord": pa.array([order] * len(asked), pa.int32()), "bucket": table.column("bucket"), "chunk": table.column("chunk"), "body": pa.array(bodies, pa.binary())}
    return pa.table(columns | {k: pa.array([int(f), *rest], pa.int64()) for k, f in facts.items()})


class Automaton:
    """The states of a chunk's n-grams, of two orders at a time: their numbers at each position, and what was answered."""

    def __init__(self, chunk: _Chunk, answers: pa.Table, top: int) -> None:
        self.chunk, self.answers, self.top = chunk, answers, top
        self.words = self._states(1)

    def _states(self, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = self.chunk.distinct(order)
        return own.at, own.number, _answers(self.answers, order, self.top)

    def counts(self) -> np.ndarray:
        _, number, (count, *_) = self.words
        return count[number]

    def traverse(self, unigram: np.ndarray) -> np.ndarray:
        """Log weight of every token, given the unigram probabilities."""
        p = unigram.copy()
        shorter = self.words
        for order in range(2, self.top + 1):
            _, context, (total, _, without, arcs) = shorter
            seen = np.maximum(total, 1)
            failure = 1 - (total - without - DISCOUNT * arcs) / seen
            at, number, facts = shorter = self._states(order)
            context = context[at - 1]
            p[at] = np.maximum(facts[0][number[at]] - DISCOUNT, 0) / seen[context] + failure[context] * p[at]
        return np.log10(p)


def _scored(chunks: pa.Table, answers: pa.Table, top: int, total: int, distinct: int, discount: float) -> pa.Table:
    """Scores of a chunk's documents."""
    (row,) = chunks.to_pylist()
    chunk = _Chunk(row)
    model = Automaton(chunk, answers, top)
    counts = model.counts()
    n = len(chunk.ids)
    base = whole = np.zeros(len(counts))
    if total:
        base = np.log10((counts + 1) / (total + distinct + 1))
        whole = model.traverse(np.where(counts > 0, counts - discount, discount * distinct) / total)
    ends = np.cumsum(chunk.lengths).tolist()
    parts = [slice(s, e) for s, e in zip([0, *ends], ends)]
    columns = {
        "doc_id": pa.array(chunk.ids, chunks.schema.field("ids").type.value_type),
        "held_out": pa.array([chunk.held] * n, pa.bool_()),
        "n_tokens": pa.array(chunk.lengths, pa.int64()),
        "n_known": pa.array([int((counts[p] > 0).sum()) for p in parts], pa.int64()),
        "train_tokens": pa.array([total] * n, pa.int64()),
        "base_score": pa.array([float(base[p].sum()) for p in parts], pa.float64()),
        "score": pa.array([float(whole[p].sum()) for p in parts], pa.float64()),
    }
    return pa.table(columns)


def score(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every text.

    The model learns from the documents that aren't held out; logarithms are to base 10.
    """
    if order < 2:
        raise ValueError("order is 2 or more")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    schema = f"chunk long, held_out boolean, n_tokens long, ids array<{id_type}>, lengths binary, codes binary, words binary"
    chunks = released(texts.mapInArrow(_chunks, schema), "lm-chunks")
    n_tokens = chunks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n")).first()["n"]
    buckets = max(1, n_tokens // PIECE, min(4 * shuffle_partitions(docs), BUCKETS, n_tokens // 1000))

    def counted(o: int, above: DataFrame | None) -> DataFrame:
        if above is None:
            asked = chunks.mapInArrow(partial(_asked_first, top=order, buckets=buckets), REQUEST)
        else:
            asking = partial(_asked_next, order=o, top=order, buckets=buckets)
            both = chunks.groupBy("chunk").cogroup(above.groupBy("chunk"))
            asked = both.applyInArrow(lambda chunk, answers: asking(chunk, answers), REQUEST)
        answering = partial(_answered, order=o, top=order)
        return released(asked.groupBy("bucket").applyInArrow(lambda table: answering(table), ANSWER), f"lm-counts-{o}")

    kept = above = None
    for o in range(order, 0, -1):
        above = counted(o, above)
        kept = above if kept is None else kept.union(above)

    facts = above.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "v", "once", "twice"))).first()
    discount = (facts["once"] + 1) / (facts["once"] + 2 * facts["twice"] + 2)
    scoring = partial(_scored, top=order, total=facts["n"], distinct=facts["v"], discount=discount)
    result = f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return chunks.groupBy("chunk").cogroup(kept.groupBy("chunk")).applyInArrow(lambda chunk, answers: scoring(chunk, answers), result)
