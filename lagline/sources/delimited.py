"""Delimited text with unknown encoding and delimiter, and CSV/JSON outputs."""

from __future__ import annotations

import codecs
import csv
import io
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lagline import fixed_values as fixed
from lagline.functions.columns import nan_to_null, quoted, trim_column_names
from lagline.sources.records import quotes, records

PROBE_BYTES = 65_536
# The engine accepts fewer names than Python; cp1252 is read as ISO-8859-1 and its own characters put in.
SPARK_CHARSET = {
    "utf-8": "UTF-8",
    "latin-1": "ISO-8859-1",
    "iso-8859-1": "ISO-8859-1",
    "cp1252": "ISO-8859-1",
    "utf-16": "UTF-16",
}
CONTROLS = "".join(map(chr, range(0x80, 0xA0)))
CP1252 = "".join(bytes([b]).decode("cp1252", errors="ignore") or chr(b) for b in range(0x80, 0xA0))


@dataclass(frozen=True)
class Dialect:
    encoding: str
    delimiter: str


def require_path(spark: SparkSession, path: str) -> None:
    """Raise a clear error if nothing can be read at ``path``."""
    try:
        spark.read.format("binaryFile").load(path).limit(0).collect()
    except AnalysisException as e:
        raise FileNotFoundError(f"no input at {path}") from e


def probe(
    spark: SparkSession,
    path: str,
    encodings: Sequence[str] = fixed.ENCODINGS,
    delimiters: Sequence[str] = fixed.DELIMITERS,
    probe_bytes: int = PROBE_BYTES,
) -> Dialect:
    """First encoding and delimiter that give more than one column.

    The delimiter comes from the header of one file. An encoding in which bytes can be wrong must
    hold for the whole input: UTF-8 is checked on every line, in one distributed pass. Without
    any match: latin-1 and ``;``.
    """
    require_path(spark, path)
    head = _head(spark, path, probe_bytes)
    for encoding in encodings:
        text = _decode(head, encoding)
        if text is None or (encoding == "utf-8" and not _all_utf8(spark, path)):
            continue
        for delimiter in delimiters:
            header = next(csv.reader(text.splitlines(), delimiter=delimiter), [])
            if len(header) > 1:
                return Dialect(encoding, delimiter)
    return Dialect("latin-1", ";")


def _head(spark: SparkSession, path: str, n: int) -> bytes:
    """First bytes of the first non-empty file below ``path``, through Spark's own file API."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    first = files.orderBy("path").limit(1).first()
    if first is None:
        return b""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(first["path"])
    stream = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).open(hadoop_path)
    try:
        return bytes(stream.readNBytes(n))
    finally:
        stream.close()


def _all_utf8(spark: SparkSession, path: str) -> bool:
    """Whether every line below ``path`` is UTF-8."""
    return spark.read.text(path).where(~F.is_valid_utf8("value")).isEmpty()


def _breaks_in_quotes(spark: SparkSession, path: str) -> bool:
    """Whether a line below ``path`` opens a quote that it doesn't close."""
    return not spark.read.option("lineSep", "\n").text(path).where(quotes("value") % 2 == 1).isEmpty()


def _decode(head: bytes, encoding: str) -> str | None:
    """Text of the probe, or None if the bytes are not in this encoding.

    An incremental decoder forgives a character cut by the end of the probe.
    """
    try:
        return codecs.getincrementaldecoder(encoding)("strict").decode(head, final=False)
    except UnicodeError:
        return None


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    dialect: Dialect | None = None,
) -> DataFrame:
    """Read delimited text with a header; probes what ``dialect`` does not say.

    Quotes inside quoted fields are doubled. Where quoted fields hold line breaks, records are found
    in parallel first (``records``), so that one file still is read by many tasks; only UTF-16, whose
    lines can't be split before decoding, is read by one task a file.

    Pass ``schema`` for large inputs: without one the input is read once more to infer the types.
    Names are trimmed and NaN becomes NULL.
    """
    found = dialect or probe(spark, path)
    charset = SPARK_CHARSET[found.encoding]
    options = {"sep": found.delimiter, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false"}
    if charset != "UTF-16" and _breaks_in_quotes(spark, path):
        text = F.rtrim(F.decode("record", charset), F.lit("\r"))
        names = _header(spark, path, found)
        fields = F.from_csv(text, ", ".join(f"`{n.replace('`', '``')}` string" for n in names), options)
        df = _typed(records(spark, path).select(fields.alias("f")).select("f.*"), schema)
    else:
        reader = spark.read.options(header=True, encoding=charset, multiLine=charset == "UTF-16", **options)
        df = (reader.schema(schema) if schema is not None else reader.option("inferSchema", True)).csv(path)
    if found.encoding == "cp1252":
        df = df.toDF(*[n.translate(str.maketrans(CONTROLS, CP1252)) for n in df.columns])
        df = df.withColumns({f.name: F.translate(quoted(f.name), CONTROLS, CP1252) for f in df.schema if f.dataType == T.StringType()})
    return nan_to_null(trim_column_names(df))


def _header(spark: SparkSession, path: str, dialect: Dialect, probe_bytes: int = PROBE_BYTES) -> list[str]:
    """Column names of the first file; its header may hold quoted line breaks."""
    charset = "latin-1" if dialect.encoding == "cp1252" else dialect.encoding
    text = _decode(_head(spark, path, probe_bytes), charset)
    return next(csv.reader(io.StringIO(text, newline=""), delimiter=dialect.delimiter))


# What values are tried as when no schema is given, narrowest first.
INFERRED = ("int", "bigint", "double", "timestamp", "boolean")


def _typed(df: DataFrame, schema: T.StructType | str | None) -> DataFrame:
    """Text columns as the types of ``schema``, by position; without one, as the narrowest that fits all values."""
    if schema is None:
        fits = [F.bool_and(quoted(c).isNull() | quoted(c).try_cast(t).isNotNull()) for c in df.columns for t in INFERRED]
        row = df.agg(F.count(F.lit(1)), *fits).first()
        kinds = [next((t for j, t in enumerate(INFERRED) if row[0] and row[1 + i * len(INFERRED) + j]), "string") for i in range(len(df.columns))]
        return df.select(*[quoted(c).try_cast(k).alias(c) for c, k in zip(df.columns, kinds)])
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    if len(fields) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns in the text, {len(fields)} in the schema")
    return df.select(*[quoted(c).try_cast(f.dataType).alias(f.name) for c, f in zip(df.columns, fields)])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(spark: SparkSession, values: dict, path: str) -> None:
    """One object (parameters or metrics) as a one-row JSON dataset."""
    spark.createDataFrame([values]).write.mode("overwrite").json(path)


def read_json_object(spark: SparkSession, path: str) -> dict:
    return spark.read.json(path).first().asDict()
