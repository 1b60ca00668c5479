"""Encoding and decoding by a SentencePiece model file, over a table of distinct chunks.

Where no piece of the vocabulary has a whitespace marker after another character, no merge crosses
the place before a marked word, so a text's ids are the ids of its marked words one after another.
Every distinct word is segmented once, with its markers, and kept in a table of bounded size; a
text is cut into words, and their ids are joined back by position. A line break that no longer
piece holds cuts in the same way and serves as a fence: a word is segmented behind it, since the
library would put a marker of its own at the beginning.

The vocabulary is looked at once, and every distinct word is tried on the model's normaliser. A
model that merges across words, and a text with a word that the normaliser changes, go through the
library whole. Decoding joins the pieces' bytes in the same way; ids whose bytes make no valid
text, or with unknown or control ids inside, go through the library.

Defined cases: a null text is empty and has the end id alone, if one is asked for; every row gives
a row, repeated ones too; null ids decode to an empty text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lagline.llm.batches import by_size, gather, ragged

# Fixed values of the format: the whitespace marker, what it stands for, and the cut at line breaks.
MARK = "▁"
FENCE = "\n"
CHUNK = re.compile(f"[ {MARK}]*[^ {MARK}{FENCE}]+|[ {MARK}]+|{FENCE}")
CACHED_CHUNKS = 500_000
CACHED_IDS = 8_000_000


class ChunkTable:
    """Ids of distinct chunks; starts anew beyond ``CACHED_CHUNKS`` chunks or ``CACHED_IDS`` ids."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(size)]
        self.control = np.array([self.model.is_control(i) for i in range(size)])
        hidden = self.control | np.array([self.model.is_unknown(i) for i in range(size)])
        self.local = (
            not any(re.search(f"[^{MARK}]{MARK}", p) or (FENCE in p and len(p) > 1) for p in pieces)
            and self.model.normalize(f"  a{FENCE} ") == f"{MARK * 3}a{FENCE}{MARK}"
        )
        self.fence = self.model.encode(FENCE)
        raw = [b"" if hidden[i] else bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.byte_sizes = np.fromiter(map(len, raw), np.int64, size)
        self.byte_starts = np.cumsum(self.byte_sizes) - self.byte_sizes
        self.hidden = hidden
        self.marked = np.array([p.startswith(MARK) for p in pieces]) & self.local
        self.plain_first = np.array([not hidden[i] and not self.model.is_byte(i) for i in range(size)])
        self._clear()

    def _clear(self) -> None:
        self.code: dict[str, int] = {}
        self.pool = np.empty(0, np.int32)
        self.starts = self.sizes = np.empty(0, np.int64)
        self.odd = np.empty(0, bool)

    def _learn(self, chunks: list[str]) -> None:
        """Put chunks that the table doesn't hold into it."""
        new = list(set(chunks).difference(self.code))
        if self.code and (len(self.code) + len(new) > CACHED_CHUNKS or len(self.pool) > CACHED_IDS):
            self._clear()
            new = list(set(chunks))
        if not new:
            return
        fenced = [FENCE + c for c in new]
        found = self.model.encode(fenced, num_threads=1)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum()))
        skip, starts = len(self.fence), np.cumsum(sizes) - sizes
        odd = np.zeros(len(new), bool)
        for i, first in enumerate(self.fence):
            odd |= flat[starts + i] != first
        shown = self.model.normalize(fenced)
        if "".join(shown) != "".join([MARK + f for f in fenced]).replace(" ", MARK):
            odd |= [n != MARK + f.replace(" ", MARK) for n, f in zip(shown, fenced)]
        self.code.update(zip(new, range(len(self.code), len(self.code) + len(new))))
        self.starts = np.concatenate([self.starts, len(self.pool) + starts + skip])
        self.pool = np.concatenate([self.pool, flat])
        self.sizes, self.odd = np.concatenate([self.sizes, sizes - skip]), np.concatenate([self.odd, odd])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has."""
        if not self.local:
            return self._joined([np.asarray(x, np.int32) for x in self.model.encode(texts, num_threads=1)])
        cut = [CHUNK.findall(" " + t) if t else [] for t in texts]
        chunks = [c for of_text in cut for c in of_text]
        self._learn(chunks)
        codes = np.fromiter(map(self.code.__getitem__, chunks), np.int64, len(chunks))
        sizes = self.sizes[codes]
        ids = gather(self.pool, self.starts[codes], sizes)
        ends = np.cumsum([0, *map(len, cut)])
        until = np.append(0, np.cumsum(sizes))[ends]
        if not self.odd[codes].any():
            return ids, np.diff(until)
        odd = np.diff(np.append(0, np.cumsum(self.odd[codes]))[ends]) > 0
        whole = [np.asarray(self.model.encode(t), np.int32) if o else ids[s:e] for t, o, s, e in zip(texts, odd, until, until[1:])]
        return self._joined(whole)

    @staticmethod
    def _joined(found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([np.empty(0, np.int32), *found]), np.fromiter(map(len, found), np.int64, len(found))

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of the ids, ``counts`` to each."""
        ends = np.cumsum(counts)
        sizes, starts = self.byte_sizes[ids], self.byte_starts[ids]
        some = np.flatnonzero(counts)
        first = (ends - counts)[some]
        own = self.marked[ids[first]]  # the marker that encoding put first
        sizes[first] -= own
        starts[first] += own
        text = gather(self.bytes, starts, sizes).tobytes()
        until = np.append(0, np.cumsum(sizes))[np.append(0, ends)]
        hidden = self.hidden[ids]
        hidden[ends[some] - 1] &= ~self.control[ids[ends[some] - 1]]  # at the end it shows nothing
        plain = np.diff(np.append(0, np.cumsum(hidden))[np.append(0, ends)]) == 0
        plain[some] &= self.plain_first[ids[first]]
        out = []
        for s, e, ok, stop, n in zip(until, until[1:], plain, ends, counts):
            try:
                if n and not ok:
                    raise ValueError("the library's rules for hidden ids hold")
                out.append(text[s:e].decode())
            except ValueError:
                out.append(self.model.decode(ids[stop - n : stop].tolist()))
        return out


@lru_cache(maxsize=2)
def chunk_table(path: str) -> ChunkTable:
    """The table of this Python worker, kept between tasks."""
    return ChunkTable(path)


def _with_ids(batches: Iterator[pa.RecordBatch], path: str, with_end: bool) -> Iterator[pa.RecordBatch]:
    table = chunk_table(path)
    for part in by_size(batches):
        ids, counts = table.encode([t or "" for t in part.column("text").to_pylist()])
        if with_end:
            longer = np.full(len(ids) + len(counts), table.model.eos_id(), np.int32)
            longer[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
            ids, counts = longer, counts + 1
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), ragged(ids, counts)], names=["doc_id", "ids"])


def encode(docs: DataFrame, path: str, with_end: bool = True) -> DataFrame:
    """``doc_id, ids``: the ids of every text, with the end id last if asked for."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(partial(_with_ids, path=path, with_end=with_end), f"doc_id {id_type}, ids array<int>")


def _with_text(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    table = chunk_table(path)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            lists = part.column("ids")
            counts = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            text = table.decode(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), counts)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists, pa.array(text, pa.string())], names=["doc_id", "ids", "text"])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, text``: the text that the ids spell."""
    id_type = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(partial(_with_text, path=path), f"doc_id {id_type}, ids array<int>, text string")
