"""Token ids of many texts by a public word-level BPE file, with each distinct word encoded once."""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain, islice

import numpy as np

# Texts of these characters only are cut into words here, by the file's own pattern; the library
# takes all others whole. The ranges are those where both agree on letters, numbers and case.
PLAIN_TEXT = re.compile("[\t\n\r\x20-\x7e\xa1-\xac\xae-ſ]*\\Z")
# The file's word pattern, spelled out for this range.
PLAIN_WORD = re.compile(
    "[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ]+"  # first, as most words are; no other begins with a letter
    "|'s|'t|'re|'ve|'m|'ll|'d"
    "|[0-9\xb2\xb3\xb9\xbc-\xbe]"
    "|[^\\sA-Za-z0-9\xaa\xb2\xb3\xb5\xb9\xba\xbc-\xbe\xc0-\xd6\xd8-\xf6\xf8-ſ]+"
)
# Capital I with a dot becomes two characters of different classes; such texts go the library's way.
DOTTED_I = "İ"
CACHED_WORDS = 300_000


# The file writes each byte as one printable character: printable Latin-1 as itself, the other bytes
# in order from U+0100 on.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_PRINTABLE = {b: b for b in _SHOWN} | {b: 0x100 + i for i, b in enumerate(sorted(set(range(256)) - set(_SHOWN)))}


def _printable(word: str) -> str:
    return word.encode().decode("latin-1").translate(_PRINTABLE)


class Codes(dict):
    """A number for each word, from 0 on in the order in which they come."""

    def __missing__(self, word: str | bytes) -> int:
        self[word] = code = len(self)
        return code


class WordEncoder:
    """Ids of texts; keeps the ids of distinct words and starts anew once there are ``CACHED_WORDS``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.merges = self.whole.model  # for words that are already normalised and cut
        self.vocabulary = self.whole.get_vocab_size()
        self._clear()

    def _clear(self) -> None:
        self.code = Codes()
        self.pool = np.empty(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.lengths = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _learn(self, new: list[str]) -> None:
        """Ids of the words whose codes are the last ones."""
        first = len(self.code) - len(new)
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            encoded = [[t.id for t in self.merges.tokenize(w if w.isascii() else _printable(w))] for w in part]
            sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
            flat = np.fromiter(chain.from_iterable(encoded), np.uint32, int(sizes.sum()))
            last = first + len(part)
            while last > len(self.starts):
                self.starts, self.lengths = np.resize(self.starts, 2 * len(self.starts)), np.resize(self.lengths, 2 * len(self.lengths))
            while self.used + len(flat) > len(self.pool):
                self.pool = np.resize(self.pool, 2 * len(self.pool))
            self.lengths[first:last] = sizes
            self.starts[first:last] = self.used + np.cumsum(sizes) - sizes
            self.pool[self.used : self.used + len(flat)] = flat
            self.used += len(flat)
            first = last

    def _of_words(self, words: list[list[str]]) -> list[np.ndarray]:
        """Ids of each list of words."""
        if len(self.code) > CACHED_WORDS:
            self._clear()
        known = len(self.code)
        counts = np.fromiter(map(len, words), np.int64, len(words))
        codes = np.fromiter(map(self.code.__getitem__, chain.from_iterable(words)), np.int64, int(counts.sum()))
        if len(self.code) > known:
            self._learn(list(islice(self.code, known, None)))
        sizes = self.lengths[codes]
        ends = np.append(0, np.cumsum(sizes))
        at = np.repeat(self.starts[codes] - ends[:-1], sizes) + np.arange(ends[-1])
        return np.split(self.pool[at], ends[np.cumsum(counts)[:-1]])

    def many(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text; they are cut into words together, so they should be few or short."""
        plain = [bool(PLAIN_TEXT.match(t)) and DOTTED_I not in t for t in texts]
        found = iter(self._of_words([PLAIN_WORD.findall(t.lower()) for t, p in zip(texts, plain) if p]) if any(plain) else ())
        return [next(found) if p else self._by_library(t) for t, p in zip(texts, plain)]

    def _by_library(self, text: str) -> np.ndarray:
        return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)

    def __call__(self, text: str) -> np.ndarray:
        return self.many([text])[0]


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker, kept between tasks."""
    return WordEncoder(path)
