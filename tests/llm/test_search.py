"""Ranked search, importance resampling and SentencePiece against plain versions, with every odd case."""

import hashlib
import math
import random
import re
import string
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from lagline.llm import lexical, pieces, resampling
from lagline.llm.registry import load_all
from tests.compare import connect, difference
from tests.llm.test_corpus import LONG, TEXTS, frame

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def corpus(n=400, seed=5):
    """Texts of frequent and rare words; a third are copies, some hold items, some are odd."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["É", "日本", "x" * 300, "ſ"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    texts = [" ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 80))) for _ in range(n)]
    texts[: n // 3] = [texts[0]] * (n // 3)
    items = [" ".join(rng.choices(vocabulary, weights, k=rng.randint(1, 30))) for _ in range(25)] + ["w299", "none of these", "W1,w1;W1"]
    for i in range(0, n, 11):
        texts[i] += ". " + items[i % len(items)].upper()
    return texts + TEXTS, items + [None, "", "-- !"]


def ranked(rows, items, best=20):
    """(item, rank) -> (document, score) by the definition, everything compared."""
    bags = [(i, Counter(words(t))) for i, t in rows]
    lengths = [sum(b.values()) for _, b in bags]
    n_docs, n_terms = sum(n > 0 for n in lengths), sum(lengths)
    df = Counter(t for _, b in bags for t in b)
    out = {}
    for item, text in items:
        scored = []
        for (doc, bag), n in zip(bags, lengths):
            score = 0
            for term in words(text):
                if bag[term]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += weight * ((1000000000 * bag[term]) // (1000 * bag[term] + 12 * (75 + (25 * n * n_docs) // n_terms)))
            if score > 0:
                scored.append((-score, doc is None, doc, score))
        for rank, (_, _, doc, score) in enumerate(sorted(scored)[:best], 1):
            out[item, rank] = (doc, score)
    return out


def item_frame(spark, items):
    rows = [(i, t, "a", 1, 2) for i, t in enumerate(items)]
    return spark.createDataFrame(rows + [rows[0]], "item_id long, text string, rank string, score int, query int")


@pytest.mark.parametrize("queries,terms", [(256, 50_000), (3, 20)])
def test_search_equals_scoring_everything(spark, monkeypatch, queries, terms):
    monkeypatch.setattr(lexical, "BLOCK_QUERIES", queries)
    monkeypatch.setattr(lexical, "BLOCK_TERMS", terms)
    monkeypatch.setattr(lexical, "TERM_SLICE", 64)
    texts, items = corpus()
    docs = frame(spark, texts)
    got = {(r["item_id"], r["rank"]): (r["doc_id"], r["score"]) for r in lexical.search(docs.repartition(3), item_frame(spark, items)).collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert got == ranked(rows, list(enumerate(items)))


def test_bounds_are_never_below_scores(spark):
    texts, items = corpus(200, 8)
    bags = [Counter(w.encode() for w in words(t)) for t in texts]
    n = np.array([sum(b.values()) for b in bags])
    rows = [(q, w.encode(), 1000 + len(w)) for q, t in enumerate(items) for w in sorted(set(words(t)))]
    block = lexical.Block(rows, len(items), int((n > 0).sum()), int(n.sum()))
    hashes = np.array([lexical._Hashes()[t] for b in bags for t in b], np.uint64)
    times = np.array([c for b in bags for c in b.values()])
    cells, sizes = lexical.fold(hashes, times, np.array([len(b) for b in bags]))
    for i, end in enumerate(np.cumsum(sizes)):
        if n[i]:
            bound = block.bounds(cells[end - sizes[i] : end][None, :], n[i : i + 1])[0]
            assert all(bound[q] >= block.score(bags[i], int(n[i]), q) for q in range(len(items)))


def test_few_documents_are_rescored(spark, monkeypatch):
    """What the thresholds leave is a small part of the corpus when the items stand in few documents."""
    rng = random.Random(3)
    texts = [" ".join(f"v{rng.randint(0, 5000)}" for _ in range(40)) for _ in range(3000)]
    items = [" ".join(f"q{i}x{j}" for j in range(12)) for i in range(5)]
    for k in range(150):
        texts[k * 20] += " " + items[k % 5]
    seen = {}
    stage = lexical.staged
    monkeypatch.setattr(lexical, "staged", lambda df, name: seen.setdefault(name, stage(df, name)))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = lexical.search(docs, item_frame(spark, items)).collect()
    assert len(found) == 100
    assert seen["search-candidates"].count() < 400


def test_search_of_empty_tables(spark):
    docs, items = frame(spark), item_frame(spark, ["w1"])
    for d, i in ((docs.where("false"), items), (docs, items.where("false")), (docs.where("text = ''"), items)):
        found = lexical.search(d, i)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.count() == 0


def test_texts_with_many_repeats(spark):
    """Frequencies beyond what a coordinate tells apart."""
    texts = ["w " * n + "z" for n in (1, 254, 255, 256, 9000)] + ["z"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["item_id"], r["rank"]): (r["doc_id"], r["score"]) for r in lexical.search(docs, item_frame(spark, ["w", "w z"])).collect()}
    assert got == ranked(list(enumerate(texts)), [(0, "w"), (1, "w z")])


# --- resampling -----------------------------------------------------------------


def drawn(rows, target, order=1, buckets=10_000, least=20, percent=10):
    """document -> [(features, weight, score, rank)] by the definition."""

    def features(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, order + 1) for i in range(len(w) - n + 1)]

    own = [features(t) for _, t in rows]
    s, t = Counter(f for x in own for f in x), Counter(f for x in target for f in features(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    scored = []
    for (doc, text), x in zip(rows, own):
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[f] for f in x)
        scored.append((doc, len(words(text)), len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    eligible = sorted((r for r in scored if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    out = Counter()
    for rank, r in enumerate(eligible, 1):
        out[r[0], *r[2:], rank if rank <= percent * len(eligible) // 100 else None] += 1
    for r in scored:
        if r[1] < least:
            out[r[0], *r[2:], None] += 1
    return out


@pytest.mark.parametrize("order,percent", [(1, 10), (2, 37), (3, 100)])
def test_draw_equals_the_definition(spark, order, percent):
    texts, items = corpus()
    docs = frame(spark, texts)
    found = resampling.draw(docs.repartition(5), item_frame(spark, items).dropDuplicates(["item_id"]), order=order, percent=percent)
    got = Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in found.collect())
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert got == drawn(rows, items, order, percent=percent)


def test_draw_from_empty_tables(spark):
    docs, items = frame(spark), item_frame(spark, ["w1"])
    assert resampling.draw(docs.where("false"), items).count() == 0
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    found = resampling.draw(docs, items.where("false"), percent=50).collect()
    assert Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in found) == drawn(rows, [], percent=50)


def test_runs_never_cross_documents():
    texts = [b"a b", b"", b"c", b"-", b"d e f"]
    n, document, bucket = resampling.run_buckets(texts, 2, 1 << 30, resampling._Checksums())
    assert n.tolist() == [2, 0, 1, 0, 3]
    want = [(0, "a"), (0, "b"), (0, "a b"), (2, "c"), (4, "d"), (4, "e"), (4, "f"), (4, "d e"), (4, "e f")]
    assert sorted(zip(document.tolist(), bucket.tolist())) == sorted((d, zlib.crc32(w.encode()) % (1 << 30)) for d, w in want)


def test_equal_rows_are_cut_over_partitions(spark):
    """A third of all rows equal in id and text: ranks stay unique."""
    docs = spark.range(3000).select(F.when(F.col("id") < 1000, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("w " * 30).alias("text"))
    ranks = [r["rank"] for r in resampling.draw(docs, item_frame(spark, ["w"]), percent=100).collect()]
    assert sorted(ranks) == list(range(1, 3001))


# --- SentencePiece --------------------------------------------------------------


def odd_texts(n=3000, seed=1):
    rng = random.Random(seed)
    parts = ["a", "b", " ", "  ", "▁", "\n", "\r", "é", "日本", "🙂", "\x00", "the", "ing", "\xa0", "　", "<s>", "</s>", "<unk>", "<0x41>", "\t", ";\r", "​", "İ"]
    return ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(n)] + [LONG, "x" * 20_000, " " * 5000]


def test_pieces_equal_the_library(spark):
    texts = odd_texts() + TEXTS
    library = SentencePieceProcessor(model_file=MODEL)
    docs = frame(spark, texts)
    found = pieces.decode(pieces.encode(docs.repartition(3), MODEL), MODEL).collect()
    assert len(found) == docs.count()
    want = {r["doc_id"]: library.encode(r["text"] or "") + [library.eos_id()] for r in docs.collect()}
    for r in found:
        assert r["ids"] == want[r["doc_id"]] and r["text"] == library.decode(want[r["doc_id"]])


def test_a_small_table_starts_anew(monkeypatch):
    monkeypatch.setattr(pieces, "CACHED_CHUNKS", 20)
    table, texts = pieces.ChunkTable(MODEL), odd_texts(500, 4)
    for at in range(0, len(texts), 7):
        ids, counts = table.encode(texts[at : at + 7])
        want = table.model.encode(texts[at : at + 7])
        assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == [len(w) for w in want]


def test_any_ids_decode_as_the_library_does(spark):
    rng = random.Random(2)
    lists = [[rng.choice([0, 1, 2, rng.randint(3, 258), rng.randint(259, 31999), 28705]) for _ in range(rng.randint(0, 8))] for _ in range(4000)]
    table = pieces.ChunkTable(MODEL)
    got = table.decode(np.array([i for x in lists for i in x]), np.array([len(x) for x in lists]))
    assert got == [table.model.decode(x) for x in lists]
    df = spark.createDataFrame([(1, None), (2, []), (3, [264])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in pieces.decode(df, MODEL).collect()} == {1: "", 2: "", 3: "a"}


def test_models_that_merge_across_words_go_whole():
    table = pieces.ChunkTable(MODEL)
    table.local = False
    texts = odd_texts(200, 9)
    ids, counts = table.encode(texts)
    assert ids.tolist() == [i for w in table.model.encode(texts) for i in w] and len(counts) == len(texts)


def test_empty_table_of_texts(spark):
    assert pieces.decode(pieces.encode(frame(spark).where("false"), MODEL), MODEL).count() == 0
    no_end = pieces.encode(frame(spark, ["", None], again=False), MODEL, with_end=False).where("doc_id IS NOT NULL")
    assert [r["ids"] for r in no_end.collect()] == [[], []]


# --- queries --------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op11_ranked_search", "op12_importance_resampling", "op13_piece_round_trip"])
def test_queries_on_the_small_table(spark, sf, name):
    assert difference(spark, connect(sf), name, load_all()[name], sf) is None
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    found = load_all()[name].run(spark, sf).collect()
    if name.startswith("op12"):
        items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
        assert Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in found) == drawn(list(rows.items()), items)
    if name.startswith("op13"):
        library = SentencePieceProcessor(model_file=MODEL)
        for r in found:
            ids = library.encode(rows[r["doc_id"]] or "") + [2]
            digest = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids))]
            assert [r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]] == [len(ids), *digest]
