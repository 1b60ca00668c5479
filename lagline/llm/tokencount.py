"""Token counts that survive edits: a segment tree over stretches of each document.

A text is cut into leaves at places where no token can reach across, whatever stands further
away: a single space between two other characters. Each leaf keeps its characters and its token
count, inner nodes keep the sums. An edit re-encodes the leaves it touches and one leaf of
context on either side, and only the sums above them change; the rest of the text isn't read.

Defined cases: a null text is empty and has one empty leaf; edits are clipped to the text; a text
without a place to cut is one leaf; every row gives a row, repeated ones too.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagline.llm.staging import staged

LEAF = 256  # characters of a leaf at least
_CUT = re.compile(r"(?<=\S) (?=\S)")

Edit = tuple[int, int, str]  # start, deleted characters, inserted text


@lru_cache(maxsize=2)
def byte_encoder(path: str, pattern: str):
    """A byte-level encoder from a file of ranks, kept by this Python worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def leaves(text: str, leaf: int = LEAF) -> list[tuple[int, int]]:
    out, at = [], 0
    while (found := _CUT.search(text, at + leaf)) is not None:
        out.append((at, found.start()))
        at = found.start()
    return [*out, (at, len(text))]


def _summed(chars: list[int], tokens: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Heaps of sums over the given leaves."""
    size = 1 << max(0, len(chars) - 1).bit_length()
    out = []
    for leaf_values in (chars, tokens):
        values = np.zeros(2 * size, np.int64)
        values[size : size + len(leaf_values)] = leaf_values
        width = size
        while width > 1:
            half = width // 2
            values[half:width] = values[width : 2 * width : 2] + values[width + 1 : 2 * width : 2]
            width = half
        out.append(values)
    return out[0], out[1]


class TokenTree:
    """Sums of characters and tokens in heap order: node k has children 2k and 2k + 1."""

    def __init__(self, chars: np.ndarray, tokens: np.ndarray):
        self.chars, self.tokens = chars, tokens
        self.size = len(chars) // 2

    @classmethod
    def of(cls, text: str, encode) -> TokenTree:
        cut = leaves(text)
        return cls(*_summed([e - s for s, e in cut], [len(encode(text[s:e])) for s, e in cut]))

    def parts(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Characters and tokens of the leaves from one node up to another that hold any."""
        chars, tokens = self.chars[first:last], self.tokens[first:last]
        return chars[chars > 0], tokens[chars > 0]

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and where the leaf starts; the last one for the end."""
        node, start = 1, 0
        place = min(place, max(int(self.chars[1]) - 1, 0))
        while node < self.size:
            node *= 2
            if place - start >= self.chars[node]:
                start += int(self.chars[node])
                node += 1
        return node, start

    def put(self, node: int, chars: int, tokens: int) -> None:
        more_chars, more_tokens = chars - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += more_chars
            self.tokens[node] += more_tokens
            node //= 2

    def edit(self, text: str, edit: Edit, encode) -> tuple[str, int]:
        """The edited text and how many characters were encoded again."""
        start = min(max(edit[0], 0), len(text))
        end = min(start + max(edit[1], 0), len(text))
        first, left = self.leaf_at(max(start - 1, 0))
        if left > 0:  # a leaf of context before
            first, left = self.leaf_at(left - 1)
        last, last_start = self.leaf_at(end)
        right = last_start + int(self.chars[last])
        if right < len(text):  # and one behind
            last, last_start = self.leaf_at(right)
            right = last_start + int(self.chars[last])
        stretch = text[left:start] + edit[2] + text[end:right]
        cut = leaves(stretch)
        chars, tokens = [e - s for s, e in cut], [len(encode(stretch[s:e])) for s, e in cut]
        if len(cut) <= last - first + 1:
            for i, node in enumerate(range(first, last + 1)):
                self.put(node, *((chars[i], tokens[i]) if i < len(cut) else (0, 0)))
        else:  # no room for the new leaves: the sums are built anew, nothing else is encoded again
            before, after = self.parts(self.size, first), self.parts(last + 1, 2 * self.size)
            self.chars, self.tokens = _summed(*[np.concatenate([x, new, y]) for x, new, y in zip(before, (chars, tokens), after)])
            self.size = len(self.chars) // 2
        return text[:left] + stretch + text[right:], len(stretch)


def trees(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``doc_id, text_key, n_tokens, chars, tokens``: the tree of each text, written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_encoder(ranks_path, pattern).encode_ordinary
        for batch in batches:
            made = [TokenTree.of(t or "", encode) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array([int(t.tokens[1]) for t in made], pa.int64()),
                    pa.array([t.chars for t in made], pa.list_(pa.int64())),
                    pa.array([t.tokens for t in made], pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_key", "n_tokens", "chars", "tokens"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    schema = f"doc_id {id_type}, text_key long, n_tokens long, chars array<long>, tokens array<long>"
    return staged(texts.mapInArrow(run, schema), "token-trees")


def recounted(docs: DataFrame, kept: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Counts after edits: ``doc_id, n_tokens, edited_text, edited_tokens, reencoded_chars, chars, tokens``.

    ``docs`` has a column ``edits``, an array of (start, deleted, inserted) that are applied in
    order; ``kept`` are the trees of the texts before. Texts meet their trees in one shuffle.
    """
    kept = kept.dropDuplicates(["doc_id", "text_key"]).withColumnRenamed("doc_id", "tree_id")
    texts = docs.select("doc_id", "text", "edits", F.xxhash64("text").alias("own_key"))
    both = texts.join(kept, F.col("doc_id").eqNullSafe(F.col("tree_id")) & (F.col("own_key") == F.col("text_key")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_encoder(ranks_path, pattern).encode_ordinary
        for batch in batches:
            out = []
            for text, edits, chars, tokens in zip(*(batch.column(c).to_pylist() for c in ("text", "edits", "chars", "tokens"))):
                tree, text, again = TokenTree(np.array(chars), np.array(tokens)), text or "", 0
                for e in edits or []:
                    text, n = tree.edit(text, (e["start"], e["deleted"], e["inserted"] or ""), encode)
                    again += n
                out.append((text, int(tree.tokens[1]), again, tree.chars, tree.tokens))
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_tokens"), *columns],
                names=["doc_id", "n_tokens", "edited_text", "edited_tokens", "reencoded_chars", "chars", "tokens"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_tokens long, edited_text string, edited_tokens long, reencoded_chars long, chars array<long>, tokens array<long>"
    return both.select("doc_id", "n_tokens", "text", "edits", "chars", "tokens").mapInArrow(run, schema)
