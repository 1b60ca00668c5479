"""The corpus operators against brute force, on small texts with every odd case."""

import collections
import hashlib
import itertools
import re
import time
import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lagline.llm import decontamination, fingerprints, lm, neardup, packing, pii, repeats, successors, tokencount, tokens, toxicity, warc
from lagline.llm.batches import TEXT_BYTES, by_size, mapped
from lagline.llm.components import components
from lagline.llm.registry import load_all
from tests.compare import connect, difference

WORD_FILE = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, w string, node long, n long, spans string, items int, part int"

LONG = " ".join(f"word{i % 97} and{i % 89}" for i in range(4000))
TEXTS = [
    None,
    "",
    " \t\n",
    "one",
    "one two three",
    LONG,
    LONG + " tail",
    LONG[:3000],
    "x" * 900,
    "é ünï 日本 🙂 ſ İ",
    "Joe@mail.example.com or +1 (555) 555-0100 or 10.0.0.1 or 4524132264652876",
    LONG[:3000],
]


def frame(spark, texts=TEXTS, again=True):
    """Documents with extra columns of clashing names, a null id and a repeated row."""
    rows = [(i, t, "a", 1, 2, "s", 3, 4) for i, t in enumerate(texts)]
    rows += [(None, "no id here", "b", 1, 2, "s", 3, 4)] + ([rows[3]] if again else [])
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.mark.parametrize("name", [n for n, q in load_all().items() if q.sql])
def test_same_rows_as_sql(spark, sf, name):
    assert difference(spark, connect(sf), name, load_all()[name], sf) is None


# --- 1 decontamination


def _alnum(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


@pytest.mark.parametrize("limit", [1 << 20, -1])
def test_hits_by_scan_and_by_join(spark, docs, limit):
    bench = [(1, LONG[200:400]), (2, "One, TWO"), (None, "three"), (4, None), (5, ""), (2, "one two")]
    items = spark.createDataFrame(bench, "item_id long, text string")
    found = decontamination.hits_by_document(docs, items, broadcast_bytes=limit).collect()
    assert len(found) == len(TEXTS) + 1
    windows = collections.defaultdict(set)
    for item, text in bench:
        w = _alnum(text)
        for s in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[s : s + 10])].add(str(item) if item is not None else None)
    for r in found:
        w = _alnum(TEXTS[r["doc_id"]] if r["doc_id"] is not None else "no id here")
        want = {(s + 1, k) for k in {len(x) for x in windows} for s in range(len(w) - k + 1) if tuple(w[s : s + k]) in windows}
        items = {i for s, k in want for i in windows[tuple(w[s - 1 : s - 1 + k])]} - {None}
        assert {tuple(x) for x in r["spans"]} == want and set(r["items"]) == items and r["n_words"] == len(w)


def test_removal_of_documents_and_spans(spark, docs, empty):
    items = spark.createDataFrame([(1, "one two"), (2, "joe mail")], "item_id int, text string")
    kept = decontamination.remove_documents(docs, items)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == set(range(len(TEXTS))) - {4, 10} | {None}
    assert by_id(decontamination.remove_spans(docs, items))[4]["text"] == "  three"
    assert decontamination.report(empty, items).count() == 0
    assert decontamination.report(docs, items.limit(0)).where("contaminated").count() == 0


# --- 2 packing


def test_pieces_make_up_every_text(docs, empty):
    pieces = packing.pack(docs, WORD_FILE, size=64).toPandas()
    encoder = tokens.WordEncoder(WORD_FILE)
    for doc_id, rows in pieces.groupby("doc_id"):
        want = encoder.whole.encode(TEXTS[int(doc_id)] or "", add_special_tokens=False).ids + [2]
        rows = rows.sort_values("start").drop_duplicates("start")
        assert np.concatenate([np.frombuffer(b, "<u4") for b in rows["ids"]]).tolist() == want
        assert (rows["doc_tokens"] == len(want)).all()
    lengths = pieces.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    for _, rows in lengths:
        assert (rows["offset"] == rows["length"].cumsum() - rows["length"]).all()
    assert (lengths["length"].sum().iloc[:-1] == 64).all()
    assert packing.pack(empty, WORD_FILE).count() == 0


def test_words_of_several_texts_are_encoded_once(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_WORDS", 5)
    encoder = tokens.WordEncoder(WORD_FILE)
    learned = []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda new: learned.append(new) or learn(new))
    texts = ["The cat's hat, the cat", "", "don't 12½ Ünï", "İ stays whole", "the hat", "  \t", "日本 text", "cat"]
    for _ in range(3):  # the third time there are more words than are kept
        got = encoder.many(texts)
        assert [g.tolist() for g in got] == [encoder.whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert [len(set(new)) == len(new) for new in learned] == [True] * 3
    assert encoder.many([]) == [] and encoder.many([""])[0].tolist() == []
    table = packing.signs(np.arange(encoder.vocabulary))
    sums = packing.sign_sums(table.astype(np.int8).T, np.concatenate(got), np.array([len(g) for g in got]))
    assert sums.tolist() == [table[g].sum(axis=0).tolist() for g in got]


def test_hilbert_neighbours_touch():
    points = np.array(list(itertools.product(range(8), repeat=3)))
    index = packing.hilbert_index(points, bits=3)
    walk = points[np.argsort(index)]
    assert sorted(index) == list(range(512))
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


# --- 3 near duplicates


def _shingles(t, size):
    w = (t or "").encode().lower().split()
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def test_components_as_by_all_pairs(spark, empty):
    rng = np.random.default_rng(5)
    texts = list(TEXTS)
    for base in range(6):  # groups of edited copies, some near the threshold
        words = [f"b{base}w{i}" for i in range(int(rng.integers(20, 500)))]
        for _ in range(25):
            own = list(words)
            for at in rng.integers(0, len(words), int(rng.integers(0, max(2, len(words) // 25)))):
                own[at] = f"e{rng.integers(1 << 30)}"
            texts.append(" ".join(own) + " Licensed under terms that many texts share")
    got = by_id(neardup.near_duplicates(frame(spark, texts), size=4))
    sets = [_shingles(t, 4) for t in texts]
    label = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
            lo, hi = sorted((label[a], label[b]))
            label = [lo if x == hi else x for x in label]
    assert [got[i]["component_id"] for i in range(len(texts))] == label
    assert [got[i]["n_shingles"] for i in range(len(texts))] == list(map(len, sets))
    assert all(got[i]["kept"] == (label[i] == i) for i in range(len(texts))) and got[None]["kept"]
    assert neardup.near_duplicates(empty).count() == 0


def test_one_of_each_component_stays(docs):
    kept = neardup.remove_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 11 not in ids and 7 in ids and 5 in ids and 6 not in ids


def test_components_of_a_long_path(spark):
    edges = spark.range(400).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.createDataFrame([(1000, 999)], "a long, b long"))
    assert {(r["component"], r["c"]) for r in components(edges).groupBy("component").agg(F.count("*").alias("c")).collect()} == {(0, 401), (999, 2)}


# --- 4 repeated strings


def test_repeats_as_by_all_strings(spark, empty):
    shared = "".join(chr(97 + i * i % 26) + str(i) for i in range(120))
    texts = [*TEXTS, "before " + shared + " after", "other " + shared[:260], shared[100:], "ab" * 400, "é" * 150, "line\n" + shared[:150]]
    got = by_id(repeats.without_repeats(frame(spark, texts)))
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i : i + 200] for b in data for i in range(len(b) - 199))
    for n, b in enumerate(data):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        assert bytes(got[n]["kept"]) == bytes(np.frombuffer(b, np.uint8)[~gone]) and got[n]["n_bytes"] == len(b)
        assert len(got[n]["spans"]) == int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
    assert repeats.without_repeats(empty).count() == 0


# --- 5 fingerprints


def test_fingerprints_estimate_merge_and_round_trip(spark, docs, empty):
    fp = fingerprints.with_fingerprint(docs, "text", "fp", size=64)
    rows = by_id(fp.select("doc_id", "fp", fingerprints.distinct_shingles(F.col("fp"), 64).alias("n"), fingerprints.from_text(fingerprints.as_text(F.col("fp"))).alias("back")))
    for i, t in enumerate(TEXTS):
        want = len(_shingles(t, 5))
        assert rows[i]["n"] == want if want <= 64 else abs(rows[i]["n"] - want) < 0.4 * want
        assert rows[i]["back"] == rows[i]["fp"]
    a, b = fp.where("doc_id = 5").select(F.col("fp").alias("a")), fp.where("doc_id = 7").select(F.col("fp").alias("b"))
    both = a.crossJoin(b).select(
        fingerprints.resemblance(F.col("a"), F.col("b"), 64).alias("r"),
        fingerprints.containment(F.col("b"), F.col("a"), 64).alias("c"),
        fingerprints.merged(F.col("a"), F.col("b"), 64).alias("m"),
        F.col("a"),
    ).first()
    x, y = _shingles(TEXTS[5], 5), _shingles(TEXTS[7], 5)
    assert abs(both["r"] - len(x & y) / len(x | y)) < 0.2 and both["c"] > 0.8 and both["m"]["values"] == both["a"]["values"]


def test_next_document_wraps_and_skips_repeats(docs, empty):
    rows, _ = successors.with_next(docs.select("doc_id", "text"))
    got = {r["doc_id"]: r["next_text"] for r in rows.where("guest = 0").collect()}
    order = [*range(len(TEXTS) - 1, -1, -1), None]
    text = lambda i: "no id here" if i is None else TEXTS[i] or ""
    assert got == {i: text(j) for i, j in zip(order, [*order[1:], order[0]])}
    assert successors.with_next(empty)[0].count() == 0


# --- 6 personal data


def test_plain_and_disguised_finds(docs, empty):
    found = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in pii.spans(docs).collect()}
    assert [k for k, _, _ in found[10]] == ["email", "ip", "card", "phone"] and all(not v for i, v in found.items() if i != 10)
    for text, span in {
        "write joe.doe at example dot com now": "joe.doe at example dot com",
        "joe [at] example [dot] com": "joe [at] example [dot] com",
        "call plus one five five five one two three four five six seven": "plus one five five five one two three four five six seven",
        "card ４５２４132264652876.": "４５２４132264652876",
    }.items():
        assert [text[s:e] for _, s, e, plain in pii.find(text) if not plain] == [span]
    for clean in ("we met at noon. dot the i", "one two three", "ärger um die Straße"):
        assert pii.find(clean) == []
    masked = by_id(docs.withColumn("text", pii.redacted(F.col("text"))))
    assert masked[10]["text"] == "<email> or <phone> or <ip> or <card>" and masked[0]["text"] is None and masked[5]["text"] == LONG
    assert pii.spans(empty).count() == 0


def _disguised(text):
    return [(k, text[s:e]) for k, s, e, plain in pii.find(text) if not plain]


def test_disguise_is_found_without_other_odd_characters():
    card, phone = "4524132264652876", "+12125550199"
    for zero in (0x09E6, 0x0E50, 0x1D7CE, 0x0660, 0xFF10):  # Bengali, Thai, mathematical, Arabic, fullwidth
        odd = {ord("0") + d: chr(zero + d) for d in range(10)}
        assert _disguised(f"card {card.translate(odd)}.") == [("card", card.translate(odd))]
        assert _disguised(f"call {phone.translate(odd)}.") == [("phone", phone.translate(odd))]
    for gap in ("\n", "\t", "\u00a0", " \n "):
        assert _disguised(f"to john{gap}at{gap}example dot com") == [("email", f"john{gap}at{gap}example dot com")]


def test_disguises_in_any_mix():
    for kind, span in (
        ("email", "john [at] example dot com"),
        ("email", "john@example dot com"),
        ("email", "john at example[dot]com"),
        ("email", "john dot smith at example dot com"),
        ("email", "john（at）example d\u200bot com"),
        ("ip", "192 dot 168 dot 0 dot 1"),
        ("ip", "one nine two dot one six eight dot one dot one"),
        ("phone", "+1 two one two five five five 0 1 9 9"),
        ("phone", "plus 1 two one two 555 zero one nine nine"),
        ("card", "four five 2 4 1322 six four-six five two eight seven six".replace("2 4 1322", "24 1322")),
    ):
        assert _disguised(f"{span}") == [(kind, span)], span
        assert _disguised(f"So, {span}; then") == [(kind, span)], span
    assert _disguised("mail at a.b@example dot com") == [("email", "a.b@example dot com")]
    for clean in ("look at example.com now", "one of two at noon", "three dots at the end", "plus one", "we met at ten. dot", "ſix or fıve"):
        assert pii.find(clean) == []


# --- 7 toxicity


def test_chain_sums_are_those_of_all_taggings():
    rng = np.random.default_rng(1)
    chain = toxicity.Chain(rng.normal(size=(toxicity.LEVELS + 1, 2)), rng.normal(size=(2, 2)))
    plain = chain.plain()
    for n, at, levels in ((6, [1, 2, 5], [1, 3, 4]), (5, [], []), (1, [0], [2]), (3, [0, 1, 2], [1, 1, 2])):
        symbols = [0] * n
        for p, v in zip(at, levels):
            symbols[p] = v
        total, toxic, emit, move = 0.0, np.zeros(n), np.zeros_like(chain.emit), np.zeros((2, 2))
        for first, *tags in itertools.product((0, 1), repeat=n + 1):
            weight = 0.5 * np.prod([chain.step(symbols[t])[a, b] for t, (a, b) in enumerate(zip([first, *tags], tags))])
            total += weight
            for t, (a, b) in enumerate(zip([first, *tags], tags)):
                toxic[t] += weight * b
                emit[symbols[t], b] += weight
                move[a, b] += weight
        got = toxicity._expected(chain, plain, n, at, levels)
        assert np.allclose(got[0], emit / total) and np.allclose(got[1], move / total)
        assert np.allclose(toxicity.marginals(chain, plain, n, at, levels), (toxic / total)[at])


def test_held_out_toxicity(spark, empty):
    rng = np.random.default_rng(3)
    words = [f"{a}{b}" for a in "bcdfghklm" for b in ("ara", "iti", "oru", "ene", "ulo")]
    rows, labels = [], []
    for i in range(600):
        text = [str(w) for w in rng.choice(words, 60)]
        if i % 5 == 0:
            for p in rng.integers(0, 60, 3):
                text[p] = str(rng.choice(["vileword", "nastyword"]))
        rows.append((i, " ".join(text)))
        labels.append((i, int(i % 5 == 0)))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels + [(None, 1), (1, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, marks)
    got = by_id(toxicity.scored(docs, model))
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(held) > 150 and all((got[i]["score"] >= toxicity.THRESHOLD) == (i % 5 == 0) for i in held)
    span = got[0]["spans"][0]
    assert "vileword" in rows[0][1][span["start"] : span["end"]] or "nastyword" in rows[0][1][span["start"] : span["end"]]
    assert {r["doc_id"] for r in toxicity.remove_toxic(docs, model).collect()} == {i for i, _ in rows if i % 5}
    prior = toxicity.fit(docs, marks.limit(0))
    assert prior.judge(None)[0] == 0.5 and toxicity.scored(empty, model).count() == 0


def test_copies_of_a_toxic_text_are_toxic_and_hide_no_others(spark):
    rng = np.random.default_rng(5)
    words = [f"{a}{b}" for a in "bcdfghklm" for b in ("ara", "iti", "oru", "ene", "ulo")]
    rows = []
    for i in range(900):
        text = [str(w) for w in rng.choice(words, 60)]
        if i % 15 == 1:
            text[int(rng.integers(0, 60))] = str(rng.choice(["vileword", "nastyword"]))
        rows.append((i, "you are rotten through and through" if i % 3 == 0 else " ".join(text), int(i % 3 == 0 or i % 15 == 1)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs.drop("toxic"), docs.select("doc_id", "toxic"))
    got = by_id(toxicity.scored(docs.drop("toxic"), model))
    assert all((got[i]["score"] >= toxicity.THRESHOLD) == bool(toxic) for i, _, toxic in rows)


# --- 8 archive


def test_records_come_back_byte_for_byte(spark, tmp_path):
    big = "<p>" + "x" * 2000
    pages = spark.createDataFrame(
        [(1, "http://a/\r\nX: y", big), (2, None, big), (2, None, big), (3, "u", "small"), (4, "u", "small"), (5, "u", None), (None, "u", "é" * 700)],
        "page_id long, url string, html string",
    )
    archive = warc.write_archive(pages, str(tmp_path / "w"))
    assert spark.read.parquet(archive.payloads).count() == 4
    rows = warc.records(spark, archive).collect()
    assert len(rows) == 7
    for r in rows:
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        size = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
        assert head.startswith(b"WARC/1.1\r\n") and len(rest) == size + 4 and rest.endswith(b"\r\n\r\n") and b"\r\nX: y" not in head
        if b"WARC-Type: response" in head:
            body = rest[:-4].partition(b"\r\n\r\n")[2]
            assert hashlib.sha1(body).hexdigest().encode() in head
    kinds = collections.Counter(re.search(rb"WARC-Type: (\w+)", bytes(r["record"]))[1] for r in rows)
    assert kinds == {b"response": 5, b"revisit": 2}
    assert warc.read_archive(spark, warc.write_archive(pages.limit(0), str(tmp_path / "e"))).count() == 0


# --- 9 token counts


def test_edited_counts_are_those_of_the_edited_text(spark, docs, empty):
    edits = F.expr("array(struct(5L as start, 3L as deleted, ' new ' as inserted), struct(900L as start, 2000L as deleted, cast(null as string) as inserted))")
    kept = tokencount.trees(docs, RANKS, public_tokenizers.PATTERN)
    got = tokencount.recounted(docs.withColumn("edits", edits), kept, RANKS, public_tokenizers.PATTERN).collect()
    encode = tokencount.byte_encoder(RANKS, public_tokenizers.PATTERN).encode_ordinary
    assert len(got) == len(TEXTS) + 2
    for r in got:
        before = "no id here" if r["doc_id"] is None else TEXTS[r["doc_id"]] or ""
        text = before[:5] + " new " + before[8:]
        text = text[:900] + text[2900:]
        assert (r["n_tokens"], r["edited_text"], r["edited_tokens"]) == (len(encode(before)), text, len(encode(text)))
        if len(before) > 40_000:
            assert r["reencoded_chars"] < 3000
    assert tokencount.trees(empty, RANKS, public_tokenizers.PATTERN).count() == 0


# --- 10 language model


def _plain_model(train, order):
    """Probability of a word after a history, from plain dictionaries."""
    seen = [collections.Counter(tuple(t[i : i + o]) for t in train for i in range(len(t) - o + 1)) for o in range(1, order + 1)]
    kept = [seen[0], *({g: n for g, n in c.items() if n >= lm.MIN_COUNT} for c in seen[1:])]
    total, distinct = sum(seen[0].values()), len(seen[0])
    once, twice = (sum(n == k for n in seen[0].values()) for k in (1, 2))
    d = (once + 1) / (once + 2 * twice + 2)

    def p(history, word):
        if not history:
            return (seen[0][(word,)] - d if (word,) in seen[0] else d * distinct) / total
        arcs = {g[-1]: n for g, n in kept[len(history)].items() if g[:-1] == history}
        if not arcs:
            return p(history[1:], word)
        n = kept[len(history) - 1][history]
        left = 1 - sum(a - lm.DISCOUNT for a in arcs.values()) / n
        return max(arcs.get(word, 0) - lm.DISCOUNT, 0) / n + left * p(history[1:], word)

    return p, seen[0], total, distinct


@pytest.mark.parametrize("order", [2, 3, 4])
def test_scores_are_those_of_a_plain_model(spark, empty, monkeypatch, order):
    monkeypatch.setattr(lm, "CHUNK_BYTES", 500)
    monkeypatch.setattr(lm, "STRETCH", 100)
    monkeypatch.setattr(lm, "PIECE", 20)
    monkeypatch.setattr(lm, "MIN_COUNT", 3)
    lines = ["the cat sat on the mat", "the cat sat on a hat", "A dog sat on the cat", "on the mat the cat sat", "", None, "the the the the"]
    texts = {i: lines[i % len(lines)] if i % 5 else f"word{i} the cat sat on" for i in range(60)}
    df = spark.createDataFrame([*texts.items(), (3, texts[3]), (None, "the cat")], "doc_id long, text string").repartition(3)
    got = lm.score(df, order).collect()
    assert len(got) == len(texts) + 2
    text_of = lambda r: lm.tokens("the cat" if r["doc_id"] is None else texts[r["doc_id"]])
    p, c, total, distinct = _plain_model([text_of(r) for r in got if not r["held_out"]], order)
    assert any(r["held_out"] for r in got)
    for r in got:
        words = text_of(r)
        assert (r["n_tokens"], r["train_tokens"], r["n_known"]) == (len(words), total, sum(c[(w,)] > 0 for w in words))
        assert np.isclose(r["base_score"], sum(np.log10((c[(w,)] + 1) / (total + distinct + 1)) for w in words))
        assert np.isclose(r["score"], sum(np.log10(p(tuple(words[max(0, i - order + 1) : i]), w)) for i, w in enumerate(words)))
    histories = [(), (b"the",), (b"sat", b"on"), (b"never",)]
    assert all(np.isclose(sum(p(h[-(order - 1) :], w) for w in [g[0] for g in c] + [b"unseen"]), 1) for h in histories)
    assert lm.score(empty, order).count() == 0


def test_scores_of_all_kinds_of_texts(docs):
    got = lm.score(docs).collect()
    assert len(got) == len(TEXTS) + 2
    assert all(r["score"] < 0 and r["base_score"] < 0 for r in got)


def test_codes_come_back_unchanged():
    for codes in ([], [0], [5, 70_000, 2**31 - 1, 5]):
        codes = np.array(codes, np.int32)
        assert (lm._unpacked(lm._packed(codes)) == codes).all()


def test_columns_come_back_unchanged():
    for n in (0, 1, 1000):
        columns = np.random.default_rng(n).integers(0, 2**63, (3, n)) >> np.array([[0], [40], [62]])
        assert (lm._columns_unpacked(lm._columns_packed(*columns), 3) == columns.astype(np.uint64)).all()


def test_each_ngram_of_a_chunk_moves_once(spark, monkeypatch):
    asked = []
    answered = lm.released
    monkeypatch.setattr(lm, "released", lambda df, name: asked.append((name, df)) or answered(df, name))
    df = spark.createDataFrame([(i, "the same words again and again") for i in range(500)], "doc_id long, text string").coalesce(1)
    got = lm.score(df).collect()
    assert len(got) == 500 and len({(r["held_out"], r["score"]) for r in got}) == 2
    answers = {name: d.collect() for name, d in asked}
    # One training and one held-out chunk: 6 words, 6 pairs and 5 triples with the end, whatever the number of texts.
    for name, width, distinct in (("lm-counts-1", 4, 6), ("lm-counts-2", 4, 6), ("lm-counts-3", 2, 5)):
        sizes = [lm._columns_unpacked(r["body"], width).shape[1] for r in answers[name]]
        assert sum(sizes) == 2 * distinct
        assert sum(r["v"] for r in answers[name]) == distinct


def test_shuffle_files_are_given_up_after_a_step(spark):
    from lagline.llm.staging import released

    def files():
        found = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {f for f in (found.apply(i).getName() for i in range(found.size())) if f.startswith("shuffle")}

    before = files()
    out = released(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "given-up")
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert out.count() == 7


# --- pipeline


def test_stages_keep_columns_and_clean_documents(spark, sf):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name == "packing":
            assert {r["doc_id"] for r in out.select("doc_id").distinct().collect()} == {r["doc_id"] for r in docs.collect()}
        else:
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), docs.schema)
    assert docs.count() > 100


def test_chain_takes_all_steps_whatever_the_number_of_sequences(monkeypatch):
    rng = np.random.default_rng(2)
    sequences = []
    for _ in range(3000):
        n = int(rng.integers(1, 60))
        at = sorted(rng.choice(n, int(rng.integers(0, min(n, 6) + 1)), replace=False).tolist())
        sequences.append((n, at, [int(v) for v in rng.integers(1, toxicity.LEVELS + 1, len(at))], bool(rng.integers(0, 2))))
    chain = toxicity.Chain(rng.normal(size=(toxicity.LEVELS + 1, 2)), rng.normal(size=(2, 2)))
    counted = {(n, tuple(at), tuple(levels), toxic): 1 + i % 3 for i, (n, at, levels, toxic) in enumerate(sequences[:300])}
    emit, move = toxicity._Batch(counted).expected(chain)
    one_by_one = [(times, toxicity._expected(chain, chain.plain(), n, list(at), list(levels))) for (n, at, levels, _), times in counted.items()]
    assert np.allclose(emit, sum(times * e for times, (e, _) in one_by_one))
    assert np.allclose(move, sum(times * m for times, (_, m) in one_by_one))
    steps = []
    expected = toxicity._Batch.expected
    monkeypatch.setattr(toxicity._Batch, "expected", lambda self, chain: steps.append(1) or expected(self, chain))
    toxicity.fit_chain(sequences)
    assert len(steps) == toxicity.STEPS
    assert np.isfinite(toxicity.fit_chain([]).emit).all()


def test_every_ngram_of_training_texts_is_a_state(spark, monkeypatch):
    texts = {i: f"word{i} follows word{i + 1} once only" for i in range(40)}
    df = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    got = lm.score(df).collect()
    p, *_ = _plain_model([lm.tokens(texts[r["doc_id"]]) for r in got if not r["held_out"]], 3)
    for r in got:
        words = lm.tokens(texts[r["doc_id"]])
        assert np.isclose(r["score"], sum(np.log10(p(tuple(words[max(0, i - 2) : i]), w)) for i, w in enumerate(words)))
    monkeypatch.setattr(lm, "MIN_COUNT", 8)
    fewer = {r["doc_id"]: r["score"] for r in lm.score(df).collect()}
    assert all(r["score"] > fewer[r["doc_id"]] for r in got if not r["held_out"])


def test_slices_dont_hold_their_batch():
    held, floor = [], pa.total_allocated_bytes()

    def batches():
        for _ in range(3):
            held.append(pa.total_allocated_bytes() - floor)
            yield pa.RecordBatch.from_pydict({"text": ["x" * 1000] * 8000})

    rows = 0
    for part in by_size(batches(), size=1 << 18):
        rows += part.num_rows
    assert rows == 24000 and max(held) < 1 << 20  # a batch has 8 MB


def test_few_texts_at_once_are_python_strings():
    texts = [None, "", "é🙂"] + [f"{i} " * 200 for i in range(10000)]
    column = pa.array(texts)
    tracemalloc.start()
    got = mapped(column, lambda t: -1 if t is None else len(t), pa.int64())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.to_pylist() == [-1 if t is None else len(t) for t in texts]
    assert peak < 4 * TEXT_BYTES < column.nbytes
    assert mapped(column, lambda t: t, column.type).equals(column) and mapped(column[:0], len, pa.int64()).to_pylist() == []


def test_stages_take_a_long_batch_in_slices():
    texts = [None, ""] + [f"{i} " * 200 for i in range(3000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": range(len(texts)), "text_key": range(len(texts)), "text": texts})
    found = list(neardup._sketched(4)(iter([batch])))
    assert len(found) > 1 and sum((f.column("doc_id").to_pylist() for f in found), []) == list(range(len(texts)))
    assert sum((f.column("n").to_pylist() for f in found), []) == [len(neardup.shingle_set(t, 4)) for t in texts]
    raw = [np.arange(i % 3000 + 1, dtype=np.uint16).tobytes() for i in range(3000)]
    counts = [len(r) // 2 for r in raw]
    places = np.cumsum(counts) - counts
    batch = pa.RecordBatch.from_pydict({"doc_id": range(3000), "n_ids": counts, "place": places, "ids": raw})
    cut = list(packing._cut(4096)(iter([batch])))
    assert len(cut) > 6 and sum((c.column("length").to_pylist() for c in cut), [])[:2] == [1, 2]
    assert sum(sum(c.column("length").to_pylist()) for c in cut) == sum(counts)
