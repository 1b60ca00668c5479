"""Every stage of the corpus pipeline against brute force on what the stage before kept."""

import re
import string
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lagline.llm import pii, toxicity
from lagline.session import stage_table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


@pytest.fixture(scope="module")
def outputs(spark, sf):
    """The rows of the documents table and after each stage."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs = docs.withColumn("bad_id", docs["doc_id"]).withColumn("kept_id", docs["lang"])  # names the stages use
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stage_table(stage(spark, out[-1], sf), f"test-{name}"))
    return dict(zip(["documents", *[n for n, _ in corpus_pipeline.STAGES]], out))


def texts(df):
    return {r["doc_id"]: r["text"] or "" for r in df.collect()}


def test_columns_stay_until_the_last_stage(outputs):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "personal_data", "packing"]
    for name in names[:-1]:
        assert outputs[name].columns == outputs["documents"].columns


def test_toxic_documents_go(spark, sf, outputs):
    model = toxicity.fit(outputs["documents"], spark.read.parquet(f"{sf}/labels.parquet"))
    before = texts(outputs["documents"])
    scores = {d: model.judge(t)[0] for d, t in before.items()}
    near = {d for d, s in scores.items() if abs(s - toxicity.THRESHOLD) < 1e-6}
    assert set(texts(outputs["toxicity"])) - near == {d for d, s in scores.items() if s < toxicity.THRESHOLD} - near


def test_one_of_each_group_stays(outputs):
    before = texts(outputs["toxicity"])
    sets = {}
    for d, t in before.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate(LOWER))
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    parent = {d: d for d in before}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(before)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    assert set(texts(outputs["near_duplicates"])) == {d for d in ids if root(d) == d}


def test_benchmark_passages_go(spark, sf, outputs):
    windows = set()
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        w = WORD.findall((r["text"] or "").translate(LOWER))
        k = min(10, len(w))
        windows |= {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
    sizes = {len(w) for w in windows}
    clean = set()
    for d, t in texts(outputs["near_duplicates"]).items():
        w = WORD.findall(t.translate(LOWER))
        if not any(tuple(w[i : i + k]) in windows for k in sizes for i in range(len(w) - k + 1)):
            clean.add(d)
    assert set(texts(outputs["decontamination"])) == clean


def test_personal_data_is_replaced(outputs):
    before = {r["doc_id"]: r["text"] for r in outputs["decontamination"].collect()}
    for r in outputs["personal_data"].collect():
        old = before[r["doc_id"]]
        assert r["text"] == (old if old is None else pii._redacted(old, pii.find(old)))
        assert r["text"] is None or r["n_chars"] == len(r["text"])
    assert len(before) == outputs["personal_data"].count()


def test_every_token_is_packed_once(outputs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    want = {d: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for d, t in texts(outputs["personal_data"]).items()}
    pieces, places = defaultdict(dict), defaultdict(list)
    for r in outputs["packing"].collect():
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert len(ids) == r["length"] and r["doc_tokens"] == len(want[r["doc_id"]])
        pieces[r["doc_id"]][r["start"]] = ids
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert {d: [i for s in sorted(p) for i in p[s]] for d, p in pieces.items()} == want
    for spots in places.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= 4096
