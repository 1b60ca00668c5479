"""A content-addressed WARC archive of pages.

Payload bytes are stored once, under their SHA-256. The exact header bytes of every record are
stored apart from them. Original records come back by joining both, and each payload is checked
against its address when it does. Of records with equal payloads of at least ``REVISIT_BYTES``
the one with the largest page id is the response and the others are revisits of it.

Defined cases: a null html is an empty payload; a null url gives an empty target; line breaks and
other control characters of a url are percent-encoded; every row is a record, repeated ones too,
and of rows with the largest page id any one is the response; a null page id is smaller than all
others and is left out of the header, an empty one is kept; control characters of an id are
percent-encoded, and come back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lagline.llm.staging import staged

REVISIT_BYTES = 1000
DATE = "1970-01-01T00:00:00Z"  # pages carry no capture time
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"
CONTROLS = (*range(0x00, 0x21), 0x7F)


@dataclass(frozen=True)
class Archive:
    """Paths of the two tables: ``headers (row, digest, header)`` and ``payloads (digest, payload)``."""

    headers: str
    payloads: str


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(END)), F.lit(""))


def _record_id(row: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("/", digest, row.cast("string")))
    parts = [F.substring(h, s, n) for s, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _safe(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    for code in CONTROLS:
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return url


def _coded(page_id: Column) -> Column:
    """An id as one header value: percent signs and control characters are percent-encoded."""
    page_id = page_id.cast("string")
    for code in (ord("%"), *CONTROLS):
        page_id = F.replace(page_id, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return page_id


def page_field(name: str, id_type: T.DataType) -> Column:
    """A header field that holds a page id, as the id it was."""
    found = field(name)
    if isinstance(id_type, T.StringType):
        for code in (*CONTROLS, ord("%")):
            found = F.replace(found, F.lit(f"%{code:02X}"), F.lit(chr(code)))
    return found.cast(id_type)


def _header(is_revisit: Column) -> Column:
    """The exact bytes before the payload: WARC fields, then the HTTP head."""
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("bytes").cast("string"), F.lit(END * 2))
    block = F.octet_length(http) + F.when(is_revisit, 0).otherwise(F.col("bytes"))
    return F.concat(
        F.lit(f"WARC/1.1{END}"),
        _line("WARC-Type", F.when(is_revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("row"), F.col("digest"))),
        _line("WARC-Date", F.lit(DATE)),
        _line("WARC-Target-URI", _safe(F.col("url"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(is_revisit, _line("WARC-Profile", F.lit(PROFILE))).otherwise(""),
        F.when(is_revisit, _line("WARC-Refers-To", _record_id(F.col("last.row"), F.col("digest")))).otherwise(""),
        F.when(is_revisit, _line("Refers-To-Page", _coded(F.col("last.page_id")))).otherwise(""),
        _line("Page", _coded(F.col("page_id"))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", block),
        F.lit(END),
        http,
    )


def write_archive(pages: DataFrame, path: str, revisit_bytes: int = REVISIT_BYTES) -> Archive:
    """Write the archive of ``pages (page_id, url, html)`` below ``path``."""
    archive = Archive(f"{path}/headers", f"{path}/payloads")
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "utf-8")
    bodies = pages.select(F.sha2(payload, 256).alias("digest"), payload.alias("payload"))
    bodies.dropDuplicates(["digest"]).write.option("compression", "zstd").parquet(archive.payloads)

    facts = pages.select("page_id", "url", F.octet_length(payload).alias("bytes"), F.sha2(payload, 256).alias("digest"), F.sha1(payload).alias("sha1"))
    facts = staged(facts.withColumn("row", F.monotonically_increasing_id()), "warc-facts")
    last = facts.where(F.col("bytes") >= revisit_bytes).groupBy("digest").agg(F.max(F.struct("page_id", "row")).alias("last"))
    is_revisit = F.col("last").isNotNull() & (F.col("last.row") != F.col("row"))
    headers = facts.join(last, "digest", "left").select("row", "digest", F.encode(_header(is_revisit), "utf-8").alias("header"))
    headers.write.option("compression", "zstd").parquet(archive.headers)
    return archive


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """``row, header, payload``: every record's header bytes and its full payload, verified.

    A payload that doesn't have the digest it is stored under ends the job.
    """
    headers = spark.read.parquet(archive.headers)
    payloads = spark.read.parquet(archive.payloads)
    good = F.sha2("payload", 256) == F.col("digest")
    payloads = payloads.select("digest", F.when(good, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("damaged payload "), F.col("digest"))).cast("binary")).alias("payload"))
    return headers.join(payloads, "digest").select("row", "header", "payload")


def field(name: str) -> Column:
    """A field of the record's header, null if absent."""
    header = F.decode("header", "utf-8")
    there = F.instr(header, f"{END}{name}: ") > 0
    return F.when(there, F.regexp_extract(header, rf"\r\n{name}: ([^\r]*)\r\n", 1))


def records(spark: SparkSession, archive: Archive) -> DataFrame:
    """``row, record``: the original records, byte for byte; a revisit ends after its HTTP head."""
    block = F.when(field("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return read_archive(spark, archive).select("row", F.concat("header", block, F.lit((END * 2).encode())).alias("record"))
