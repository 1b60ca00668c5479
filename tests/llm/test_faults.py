"""Cases that once went wrong: long texts, many edits, odd ids, clashing columns, repeated rows."""

import re
import time

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lagline.llm import decontamination, neardup, pii, repeats, toxicity, warc
from lagline.llm.fingerprints import resemblance, with_fingerprint
from lagline.llm.registry import load_all
from lagline.llm.tokencount import TokenTree, byte_encoder

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_long_text_with_many_disguised_finds():
    part = "write to john at example dot com or to ann@mail.example.com today. "
    seconds = []
    for n in (2_000, 8_000):
        start = time.perf_counter()
        found = pii.find(part * n)
        seconds.append(time.perf_counter() - start)
        assert len(found) == 2 * n
    assert seconds[1] < 8 * seconds[0] + 1


# The base patterns as the contract of the query states them.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text):
    digits = lambda s: [c for c in s if c in "0123456789"]
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m.group())) <= 19 and luhn(digits(m.group()))]
    out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15]
    return out


def test_base_spans_equal_plain_patterns(spark, sf):
    import random

    rng = random.Random(4)
    parts = ["a", "b.c", "@", "x-y.com", "1.2.3.4", "300.1.1.1", "4524132264652876", "4524 1322 6465 2876", "+1 (555) 555-0100", "+", "12", ".", "-", " ", "é", "at", "dot"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(5000)]
    texts += [r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    for text in texts:
        found = pii.find(text)
        assert [f[:3] for f in found if f[3]] == base_spans(text)


def test_many_edits_encode_little_again():
    encode = byte_encoder(RANKS, public_tokenizers.PATTERN).encode_ordinary
    text = "some words of a text that goes on for a while, " * 400
    tree = TokenTree.of(text, encode)
    for i in range(400):
        text, again = tree.edit(text, (len(text) // 2, 0, "inserted words here and there again and again "), encode)
        assert again < 1_500, i
    assert tree.tokens[1] == len(encode(text)) and tree.chars[1] == len(text)
    for _ in range(60):
        text, again = tree.edit(text, (len(text) // 3, 300, ""), encode)
    assert tree.tokens[1] == len(encode(text)) and tree.chars[1] == len(text)
    text, _ = tree.edit(text, (0, len(text), ""), encode)
    text, _ = tree.edit(text, (0, 0, "a new text " * 300), encode)
    assert tree.tokens[1] == len(encode(text))


def test_edits_at_random_places():
    import random

    rng = random.Random(6)
    encode = byte_encoder(RANKS, public_tokenizers.PATTERN).encode_ordinary
    for _ in range(60):
        text = "".join(rng.choices(["word ", " ", "\n", "x", "é", "1234 ", "don't "], k=rng.randint(0, 900)))
        tree = TokenTree.of(text, encode)
        for _ in range(12):
            insert = "".join(rng.choices(["new ", " ", "\n\n", "y", "it's "], k=rng.choice([0, 3, 400])))
            text, _ = tree.edit(text, (rng.randint(0, len(text)), rng.choice([0, 5, 700]), insert), encode)
            assert tree.tokens[1] == len(encode(text)) and tree.chars[1] == len(text)


def test_columns_of_any_name(spark):
    rows = [(1, "one two three four five six seven eight nine ten", 1, 2, 3, 4), (2, "a b c d e f g h", 1, 2, 3, 4), (2, "a b c d e f g h", 1, 2, 3, 4), (3, "a b c d e f g h", 1, 2, 3, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bad_id int, bad_key int, kept_id int, KEPT_KEY int")
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "item_id long, text string")
    clean = decontamination.remove_documents(docs, items)
    assert clean.columns == docs.columns and sorted(r["doc_id"] for r in clean.collect()) == [2, 2, 3]
    one = neardup.remove_near_duplicates(docs)
    assert one.columns == docs.columns and sorted(r["doc_id"] for r in one.collect()) == [1, 2]


def test_repeated_rows_come_out_once(spark):
    long = " ".join(f"word{i}" for i in range(80))
    rows = [(1, "x" + long), (1, "x" + long), (2, "y" + long), (3, "short"), (3, "short"), (4, "short"), (None, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = repeats.without_repeats(docs).collect()
    assert sorted((r["doc_id"] or 0, r["n_bytes"]) for r in found) == sorted([(1, len(long) + 1), (2, len(long) + 1), (3, 5), (4, 5), (0, 0)])
    assert {r["doc_id"]: bytes(r["kept"]) for r in found}[1] == b"x"


def test_rows_of_a_common_id_do_not_pass_the_sample(spark, monkeypatch):
    """With one id on most rows, the rows fitted on still are at most the sample."""
    docs = spark.range(3000).select(F.when(F.col("id") < 2900, 8).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("bad vile text "), "id").alias("text"))
    labels = spark.createDataFrame([(8, 1), *[(i, i % 2) for i in range(2900, 3000)]], "doc_id long, toxic int")
    seen = {}
    stage = toxicity.staged
    monkeypatch.setattr(toxicity, "staged", lambda df, name: seen.setdefault(name, stage(df, name)))
    toxicity.fit(docs, labels, sample=50)
    assert seen["toxicity-sample"].count() == 50


def test_page_ids_of_any_text(spark, tmp_path):
    body = "b" * 2000
    ids = ["", "a\r\nPage: b", "100%", "%0D", "a b", None, "ä"]
    pages = spark.createDataFrame([(i, "u", body) for i in ids] + [("z", None, None)], "page_id string, url string, html string")
    archive = warc.write_archive(pages, str(tmp_path / "w"))
    kind = pages.schema["page_id"].dataType
    found = warc.read_archive(spark, archive).select(warc.page_field("Page", kind).alias("p"), warc.page_field("Refers-To-Page", kind).alias("r"), warc.field("WARC-Type").alias("t"), "payload").collect()
    assert sorted((r["p"] or "", r["p"] is None) for r in found) == sorted((i or "", i is None) for i in [*ids, "z"])
    assert {r["r"] for r in found if r["t"] == "revisit"} == {"ä"} and sum(r["t"] == "revisit" for r in found) == len(ids) - 1


def test_fingerprint_query_row_by_row(spark, sf):
    """Edited texts, wrap-around and likenesses of the whole query against plain Python."""
    import hashlib

    rows = [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    order = sorted(rows, key=lambda r: -r[0])
    following = {d: order[(i + 1) % len(order)][1] for i, (d, _) in enumerate(order)}
    got = {r["doc_id"]: r for r in load_all()["op5_document_fingerprints"].run(spark, sf).collect()}
    assert len(got) == len(rows)
    by_text = {}
    for doc, text in rows:
        n, ahead = len(text), following[doc]
        edited = text[: n - n // 3] + ahead[: n // 3]
        assert got[doc]["n_chars"] == n and got[doc]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert by_text.setdefault(text, got[doc]["fingerprint"]) == got[doc]["fingerprint"]
        assert 0 <= got[doc]["near_edited"] <= 1 and (text != edited or got[doc]["near_edited"] == 1)
    pairs = spark.createDataFrame([(d, t, following[d]) for d, t in rows], "doc_id long, text string, ahead string")
    both = with_fingerprint(with_fingerprint(pairs, "text", "a"), "ahead", "b")
    near = {r["doc_id"]: r["x"] for r in both.select("doc_id", resemblance(F.col("a"), F.col("b")).alias("x")).collect()}
    assert all(near[d] == got[d]["near_next"] for d in near)


@pytest.mark.parametrize("size", [16 << 20, 0])
def test_size_check_counts_item_lists(spark, size):
    """Many items sharing a window are no small broadcast; both ways give the same hits."""
    items = spark.range(300).select(F.col("id").alias("item_id"), F.lit("one two three").alias("text"))
    docs = spark.createDataFrame([(1, "zero one two three"), (2, "none")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in decontamination.report(docs, items, broadcast_bytes=size).collect()} if size else None
    other = {r["doc_id"]: r["n_items"] for r in decontamination.report(docs, items, broadcast_bytes=5_000).collect()}
    assert other == {1: 300, 2: 0} and (found is None or {d: r["n_items"] for d, r in found.items()} == other)


@pytest.mark.parametrize("percent,shared", [(80, 22), (50, 7), (30, 1), (100, 48)])
def test_shared_values_follow_the_threshold(percent, shared):
    assert neardup.shared_values(percent) == shared


@pytest.mark.parametrize("percent", [30, 50, 80])
def test_links_at_other_thresholds(spark, percent):
    """Components equal those of all pairs, low thresholds and sets larger than the sketches too."""
    import random

    rng = random.Random(percent)
    base = [f"w{i}" for i in range(160)]
    texts = []
    for _ in range(60):
        words = list(base)
        for i in rng.sample(range(160), rng.randint(0, 60)):
            words[i] = f"x{rng.randint(0, 10**6)}"
        texts.append(" ".join(words))
    sets = [{tuple(w[i : i + 3]) for i in range(len(w) - 2)} for w in (t.split() for t in texts)]
    component = list(range(len(texts)))

    def root(i):
        while component[i] != i:
            i = component[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                component[max(a, b)] = min(a, b)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs, 3, percent).collect()}
    assert found == {i: root(i) for i in range(len(texts))}
