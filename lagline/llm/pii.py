"""Personal data in texts, also where it is disguised.

Plain finds follow four patterns on the text as it is. A small transducer then rewrites every text:
look-alike letters and foreign digits become ASCII, invisible characters vanish, spelled digits
become digits, and written-out at and dot become their signs, bare or in brackets, in any mix. It
keeps for every character it writes where that came from, so finds in the rewritten text map back
to offsets of the source. They are added where the rewriting made the difference and no plain find
stands there; the patterns decide what counts. Only a bare at needs more, since prose is full of
them: it becomes a sign where a domain with a written-out dot follows.

Defined cases: a null text is empty; every row gives a row, repeated ones too.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lagline.llm.batches import mapped

KINDS = ("email", "ip", "card", "phone")

# What the kinds look like. Possessive runs and look-behinds only keep long runs of
# digits from being tried again at every digit.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

# Letters that look like ASCII ones, and words for digits.
_LOOKS = str.maketrans(
    "аВеЕкКМНоОрРсСТхХуіІѕЅјЈԁԛԝһАαΑΒεΕΖΗιΙκΚΜΝοΟρΡΤυΥΧѵɡıⅼ",
    "aBeEkKMHoOpPcCTxXyiIsSjJdqwhAaABeEZHiIkKMNoOpPTuYXvgil",
)
_NUMBER = {w: str(d) for d, w in enumerate("zero one two three four five six seven eight nine".split())} | {"oh": "0"}
_INVISIBLE = "­​‌‍⁠﻿"



def _spelling(word: str) -> str:
    """ASCII letters in either case; the flag would let other letters match, too."""
    return "".join(f"[{c}{c.upper()}]" for c in word)


_DIGIT_WORD = "|".join(map(_spelling, _NUMBER))
_SIGN_WORD = rf"{_spelling('at')}|{_spelling('dot')}"
# What may be rewritten: a sign in brackets, a bare one between white space, plus or a digit as a word.
_WRITTEN = re.compile(
    rf"[\[({{<]\s*(?P<boxed>{_SIGN_WORD}|[@.])\s*[\])}}>]"
    rf"|(?<!\S)(?P<bare>{_SIGN_WORD})(?!\S)"
    rf"|(?<![^\W\d_])(?:(?P<plus>{_spelling('plus')})|(?P<digit>{_DIGIT_WORD}))(?![^\W\d_])"
)
# What may stand between two digits of a number, at least one of them spelled.
_GAP = re.compile(r"[\s,-]+")
_DIGIT_NEXT = re.compile(rf"[\s,-]+(?:[0-9]|(?:{_DIGIT_WORD})(?![^\W\d_]))")

Span = tuple[str, int, int]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            last = found.end()
        # A local part can't hold an at sign, so the next one starts behind this sign at the earliest.
        last = max(last, at + 1)
        at = text.find("@", last)


def _luhn(digits: str) -> bool:
    doubled = (sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def plain_spans(text: str) -> list[Span]:
    """Finds on the text as it is, by kind and then by start."""
    found = [("email", s, e) for s, e in _emails(text)]
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
            found.append(("phone", *m.span()))
    return found


def _spaced(text: str, s: int, e: int) -> tuple[int, int]:
    """The range with the white space around it."""
    while s and text[s - 1].isspace():
        s -= 1
    while e < len(text) and text[e].isspace():
        e += 1
    return s, e


def _rewrites(text: str) -> tuple[list[tuple[int, int, str]], list[int]]:
    """Ranges and what stands for them, in order and apart; which of them are a bare at."""
    out: list[tuple[int, int, str]] = []
    bare: list[int] = []
    last = 0
    for m in _WRITTEN.finditer(text):
        s, e = m.span()
        if sign := m["boxed"] or m["bare"]:
            s, e = _spaced(text, s, e)
            sign = "@" if sign.lower() in ("at", "@") else "."
            if m["bare"] and sign == "@":
                bare.append(len(out))
        elif m["digit"]:
            sign = _NUMBER[m["digit"].lower()]
            # A gap before belongs to the digit if a written one stands there, as spelled ones take the gap after.
            before = s
            while before > last and (text[before - 1].isspace() or text[before - 1] in ",-"):
                before -= 1
            if before > last and text[before - 1] in "0123456789":
                s = before
            if _DIGIT_NEXT.match(text, e):
                e = _GAP.match(text, e).end()
        else:
            if not _DIGIT_NEXT.match(text, e):
                continue
            sign, e = "+", _GAP.match(text, e).end()
        out.append((max(s, last), e, sign))
        last = e
    return out, bare


def _one(c: str) -> str:
    if c in _INVISIBLE:
        return ""
    if "！" <= c <= "～":
        return chr(ord(c) - 0xFEE0)
    digit = unicodedata.digit(c, None) if ord(c) > 127 and unicodedata.category(c) == "Nd" else None
    return str(digit) if digit is not None else c.translate(_LOOKS)


class _Ones(dict):
    """What each character is read as, computed once."""

    def __missing__(self, c: str) -> str:
        self[c] = found = c if c < "\x80" else _one(c)
        return found


_READ = _Ones()


def _at_counts(text: str, at: int, written: set[int]) -> bool:
    """Whether a domain with a written-out dot follows this sign."""
    found = _DOMAIN.match(text, at + 1)
    return found is not None and text[found.end() : found.end() + 1] != "@" and any(i in written for i in range(at + 1, found.end()))


def transduced(text: str) -> tuple[str, list[int], list[int]]:
    """The rewritten text, and for each of its characters the source range it stands for."""
    spelled = [_READ[c] for c in text]
    read = "".join(spelled)
    from_ = [i for i, c in enumerate(spelled) if c]  # each character is rewritten as one or none
    out: list[str] = []
    starts: list[int] = []
    ends: list[int] = []
    at = 0
    rewrites, bare = _rewrites(read)
    placed: list[int] = []
    for s, e, sign in [*rewrites, (len(read), len(read), "")]:
        out += read[at:s]
        starts += from_[at:s]
        ends += [i + 1 for i in from_[at:s]]
        if sign:
            placed.append(len(out))
            out.append(sign)
            starts.append(from_[s])
            ends.append(from_[e - 1] + 1)
        at = e
    # A bare at that no domain follows stands as it was read. From the last on, so that places before stay.
    whole = "".join(out)
    written = {i for i in placed if out[i] == "."}
    for k in reversed(bare):
        i = placed[k]
        if not _at_counts(whole, i, written):
            s, e, _ = rewrites[k]
            out[i] = read[s:e]
    if any(len(c) > 1 for c in out):
        plain_at = {placed[k]: rewrites[k] for k in bare if len(out[placed[k]]) > 1}
        some, at = ([], [], []), 0
        for i in [*sorted(plain_at), len(out)]:
            for kept, full in zip(some, (out, starts, ends)):
                kept.extend(full[at:i])
            if i < len(out):
                s, e, _ = plain_at[i]
                some[0].extend(read[s:e])
                some[1].extend(from_[s:e])
                some[2].extend(j + 1 for j in from_[s:e])
            at = i + 1
        out, starts, ends = some
    return "".join(out), starts, ends


def find(text: str | None) -> list[tuple[str, int, int, bool]]:
    """All finds (kind, start, end, plain) by kind and start; offsets are code points."""
    text = text or ""
    plain = plain_spans(text)
    found = [(*s, True) for s in plain]
    if any(_READ[c] != c for c in set(text)) or _WRITTEN.search(text):  # else nothing is rewritten
        rewritten, starts, ends = transduced(text)
        taken = bytearray(len(text))  # a mark for each character of a find
        for _, s, e in plain:
            taken[s:e] = b"\x01" * (e - s)
        for kind, s, e in plain_spans(rewritten):
            a, b = starts[s], ends[e - 1]
            if text[a:b] != rewritten[s:e] and taken.find(1, a, b) < 0:
                found.append((kind, a, b, False))
                taken[a:b] = b"\x01" * (b - a)
    return sorted(found, key=lambda f: (KINDS.index(f[0]), f[1]))


def _redacted(text: str, found: list[tuple[str, int, int, bool]]) -> str:
    out, at = [], 0
    for kind, s, e, _ in sorted(found, key=lambda f: (f[1], -f[2])):
        if s >= at:
            out += [text[at:s], f"<{kind}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans``: the finds of each text as (kind, start, end, plain)."""
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("plain", T.BooleanType())])
    schema = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("spans", T.ArrayType(span))])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("plain", pa.bool_())]))
    names = ("kind", "start", "end", "plain")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[dict(zip(names, f)) for f in find(t.as_py())] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["doc_id", "spans"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col)).mapInArrow(run, schema)


def redacted(text: Column) -> Column:
    """The text with each find replaced by its kind in angle brackets; null stays null."""

    @F.arrow_udf("string")
    def replace(texts: pa.Array) -> pa.Array:
        return mapped(texts, lambda t: t if t is None else _redacted(t, find(t)), texts.type)

    return replace(text)
