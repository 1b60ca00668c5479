"""Document fingerprints: bottom-k sketches of shingle hashes, as column expressions.

A fingerprint is a struct ``(distinct, values)``: the ``size`` smallest distinct 48-bit hashes of
a text's word shingles in rising order, and how many distinct ones there were if all are held,
else null. Fingerprints of parts merge into that of the whole. Everything runs inside
generated or built-in expressions.

Defined cases: a null or wordless text has the empty fingerprint, which is like another empty one
(1.0) and unlike all others (0.0); a text of fewer words than a shingle has one shingle of all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagline.llm.text import SPACED_WORD, words

SHINGLE = 5
SIZE = 256
HASH_BITS = 48


def with_fingerprint(df: DataFrame, text_col: str, name: str, shingle: int = SHINGLE, size: int = SIZE) -> DataFrame:
    """``df`` with the fingerprint of a text column.

    Words are hashed once each, shingles from the word hashes; the steps are columns of their
    own so that no step is computed again for every element of the next.
    """
    w, h = f"__{name}_words", f"__{name}_shingles"
    df = df.withColumn(w, F.transform(words(F.col(text_col), SPACED_WORD), lambda x: F.xxhash64(x)))
    mixed = F.transform(
        w, lambda x, i: F.shiftrightunsigned(F.xxhash64(x, *[F.get(F.col(w), i + d) for d in range(1, shingle)]), 64 - HASH_BITS)
    )
    df = df.withColumn(h, F.array_distinct(F.slice(mixed, 1, F.greatest(F.size(w) - (shingle - 1), F.lit(1)))))
    held = F.when(F.size(h) <= size, F.size(h).cast("long"))
    return df.withColumn(name, F.struct(held.alias("distinct"), F.slice(F.sort_array(h), 1, size).alias("values"))).drop(w, h)


def merged(a: Column, b: Column, size: int = SIZE) -> Column:
    """The fingerprint of two parts together."""
    union = F.sort_array(F.array_union(a["values"], b["values"]))
    whole = a["distinct"].isNotNull() & b["distinct"].isNotNull() & (F.size(union) <= size)
    return F.struct(F.when(whole, F.size(union).cast("long")).alias("distinct"), F.slice(union, 1, size).alias("values"))


def distinct_shingles(a: Column, size: int = SIZE) -> Column:
    """Distinct shingles: counted if all are held, else estimated from the largest held hash."""
    top = F.element_at(a["values"], -1) + 1
    return F.coalesce(a["distinct"].cast("double"), (size - 1) * F.lit(float(1 << HASH_BITS)) / top)


def _shares(a: Column, b: Column, size: int) -> tuple[Column, Column, Column]:
    """Hashes of the union's sketch, how many stand in both, how many in a."""
    whole = a["distinct"].isNotNull() & b["distinct"].isNotNull()
    union = F.array_union(a["values"], b["values"])
    sketch = F.when(whole, union).otherwise(F.slice(F.sort_array(union), 1, size))
    both = F.size(F.array_intersect(sketch, F.array_intersect(a["values"], b["values"])))
    return F.size(sketch), both, F.size(F.array_intersect(sketch, a["values"]))


def resemblance(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated shared part of the union of both shingle sets; exact if both are held whole."""
    union, both, _ = _shares(a, b, size)
    return F.when(union == 0, 1.0).otherwise(both / union)


def containment(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated part of a's shingles that b has too."""
    _, both, own = _shares(a, b, size)
    return F.when(F.size(a["values"]) == 0, 1.0).when(own == 0, 0.0).otherwise(both / own)


def as_text(a: Column) -> Column:
    """A fingerprint as text: the count if known, then the hashes in hexadecimal."""
    return F.concat_ws(":", F.coalesce(a["distinct"].cast("string"), F.lit("+")), F.array_join(F.transform(a["values"], lambda v: F.lower(F.hex(v))), "."))


def from_text(text: Column) -> Column:
    """The fingerprint that ``as_text`` wrote."""
    parts = F.split(text, "[:.]")
    values = F.filter(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), lambda v: v != "")
    return F.struct(F.try_to_number(parts[0], F.lit("999999")).cast("long").alias("distinct"), F.transform(values, lambda v: F.conv(v, 16, 10).cast("long")).alias("values"))
