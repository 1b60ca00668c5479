"""The registered queries: one per operator, over whole tables, and the pipeline."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from lagline.llm import (
    decontamination,
    fingerprints,
    lexical,
    lm,
    neardup,
    packing,
    pieces,
    pii,
    repeats,
    resampling,
    successors,
    tokencount,
    toxicity,
    warc,
)
from lagline.llm.registry import read, register
from lagline.session import scratch_path

# --- 1 benchmark decontamination ------------------------------------------------

LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM_SQL = rf"regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION_SQL = f"""
WITH d AS (SELECT doc_id, {ALNUM_SQL} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {ALNUM_SQL} AS w FROM benchmark),
g AS (
  SELECT item, k, array_to_string(w[s:s + k - 1], ' ') AS gram
  FROM (SELECT item, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM b WHERE len(w) > 0)),
seen AS (
  SELECT doc_id, s, k, array_to_string(w[s:s + k - 1], ' ') AS gram
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM g) WHERE len(w) >= k)),
hit AS (SELECT doc_id, s, seen.k, item FROM seen JOIN g ON seen.k = g.k AND seen.gram = g.gram),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM (SELECT DISTINCT doc_id, s, k FROM hit)) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@register("op1_benchmark_decontamination", DECONTAMINATION_SQL)
def benchmark_decontamination(spark, sf):
    """Words of every document that stand in a benchmark item."""
    found = decontamination.report(read(spark, sf, "documents"), read(spark, sf, "benchmark"))
    ids = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", ids, "contaminated")


# --- 2 packing ------------------------------------------------------------------

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@register("op2_curve_packing")
def curve_packing(spark, sf):
    """Pieces of all documents in sequences of 4096 ids, along a Hilbert curve."""
    pieces = packing.pack(read(spark, sf, "documents"), WORD_TOKENIZER)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


# --- 3 near duplicates ----------------------------------------------------------


@register("op3_minhash_near_duplicates")
def minhash_near_duplicates(spark, sf):
    """Components of all documents under a similarity of 0.8 of their four-word shingles."""
    found = neardup.near_duplicates(read(spark, sf, "documents"), size=4)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


# --- 4 repeated byte strings ----------------------------------------------------


@register("op4_suffix_repeats")
def suffix_repeats(spark, sf):
    """All documents without the bytes that 200-byte repeats cover."""
    found = repeats.without_repeats(read(spark, sf, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


# --- 5 document fingerprints ----------------------------------------------------


@register("op5_document_fingerprints")
def document_fingerprints(spark, sf):
    """Fingerprints of all documents and of their edited texts, and how alike they are."""
    beside, order = successors.with_next(read(spark, sf, "documents").select("doc_id", "text"))
    own = fingerprints.with_fingerprint(beside, "text", "fp")
    own = own.withColumn("next_fp", F.lead("fp").over(order)).where("guest = 0")
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third))
    both = fingerprints.with_fingerprint(own.withColumn("edited", edited), "edited", "edited_fp")
    return both.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("fp")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        fingerprints.resemblance(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        fingerprints.resemblance(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )


# --- 6 personal data ------------------------------------------------------------


def _listed(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


@register("op6_personal_data")
def personal_data(spark, sf):
    """Personal data in all documents, plain and disguised."""
    found = pii.spans(read(spark, sf, "documents"))
    plain = F.filter("spans", lambda s: s["plain"])
    kinds = F.transform(plain, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(_listed(plain), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


# --- 7 toxicity -----------------------------------------------------------------


@register("op7_toxicity")
def toxic_documents(spark, sf):
    """Toxicity scores of all documents by a model of the labels that aren't held out."""
    docs = read(spark, sf, "documents")
    found = toxicity.scored(docs, toxicity.fit(docs, read(spark, sf, "labels")))
    held = toxicity.held_out(F.col("doc_id")).alias("held_out")
    return found.select("doc_id", held, "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


# --- 8 WARC archive -------------------------------------------------------------

WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS bytes FROM pages),
last AS (SELECT html, max(page_id) AS page FROM p WHERE bytes >= 1000 GROUP BY html)
SELECT page_id, bytes AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN page IS NULL OR page = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page <> page_id THEN page END AS refers_to
FROM p LEFT JOIN last ON p.html = last.html
"""


@register("op8_warc_archive", WARC_SQL)
def warc_archive(spark, sf):
    """All pages written as WARC records with payloads stored once, then read back."""
    pages = read(spark, sf, "pages")
    archive = warc.write_archive(pages, scratch_path(spark, "warc"))
    id_type = pages.schema["page_id"].dataType
    return warc.read_archive(spark, archive).select(
        warc.page_field("Page", id_type).alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        warc.field("WARC-Type").alias("record_type"),
        warc.page_field("Refers-To-Page", id_type).alias("refers_to"),
    )


# --- 9 token counts -------------------------------------------------------------

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@register("op9_token_counts")
def token_counts(spark, sf):
    """Token counts of all documents before and after two edits, recounted around the edits only.

    The first edit replaces up to seven characters at a third of the text; the second inserts the
    text's first twenty characters at half of it.
    """
    docs = read(spark, sf, "documents").select("doc_id", "text")
    kept = tokencount.trees(docs, RANKS, public_tokenizers.PATTERN)
    n = F.length(F.coalesce("text", F.lit("")))
    first = F.struct(F.floor(n / 3).alias("start"), F.lit(7).cast("long").alias("deleted"), F.lit("<edited> ").alias("inserted"))
    second = F.struct(F.floor(n / 2).alias("start"), F.lit(0).cast("long").alias("deleted"), F.substring("text", 1, 20).alias("inserted"))
    found = tokencount.recounted(docs.withColumn("edits", F.array(first, second)), kept, RANKS, public_tokenizers.PATTERN)
    edited_chars = F.length("edited_text").cast("long").alias("edited_chars")
    return found.select("doc_id", "n_tokens", edited_chars, "edited_tokens", "reencoded_chars")


# --- 10 language model ----------------------------------------------------------


@register("op10_language_model")
def language_model(spark, sf):
    """Log probabilities of all documents under a backoff automaton of the training documents."""
    return lm.score(read(spark, sf, "documents"))


# --- 11 ranked lexical search ---------------------------------------------------

SEARCH_SQL = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS place,
         regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT DISTINCT item_id, text,
         regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
facts AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
tf AS (SELECT place, term, count(*) AS tf FROM (SELECT place, unnest(w) AS term FROM d) GROUP BY place, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
asked AS (SELECT item_id, text, term, count(*) AS times FROM (SELECT item_id, text, unnest(w) AS term FROM b) GROUP BY item_id, text, term),
weighed AS (
  SELECT item_id, text, term, times * CAST(floor(1000 * ln((2.0 * n_docs + 2) / (2.0 * df + 1))) AS BIGINT) AS weight
  FROM asked JOIN df USING (term), facts),
scored AS (
  SELECT item_id, text, place, doc_id,
         CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len(w) * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM weighed JOIN tf USING (term) JOIN d USING (place), facts GROUP BY item_id, text, place, doc_id),
ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""


@register("op11_ranked_search", SEARCH_SQL)
def ranked_search(spark, sf):
    """The twenty documents that score highest for each benchmark item."""
    return lexical.search(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


# --- 12 importance resampling ---------------------------------------------------


@register("op12_importance_resampling")
def importance_resampling(spark, sf):
    """Weights of all documents towards the benchmark's texts, and a tenth drawn by them."""
    drawn = resampling.draw(read(spark, sf, "documents"), read(spark, sf, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


# --- 13 SentencePiece -----------------------------------------------------------

PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


@register("op13_piece_round_trip")
def piece_round_trip(spark, sf):
    """All documents encoded with an end id, and the texts that their ids decode to."""
    read_back = pieces.decode(pieces.encode(read(spark, sf, "documents"), PIECE_MODEL), PIECE_MODEL)
    return read_back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
