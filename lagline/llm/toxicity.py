"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels are per document. Words that stand in far more toxic than clean labelled documents carry
evidence in ``LEVELS`` strengths. Shares are taken once of all documents, so that a text labelled
many times counts as often, and once of distinct texts, so that its copies don't hide the words of
other toxic texts; a word telling in either carries evidence. In toxic documents those tokens are
labelled toxic, all other tokens clean. The field has two states, a weight for every state and strength, and weights for
transitions. It is fitted by conditional likelihood on the labelled tokens. Forward-backward
marginals of a text's tokens give its offending spans, and their largest and their sum give the
document score through a logistic curve fitted to the document labels.

Most tokens carry no evidence, and runs of them are one power of the same 2 x 2 matrix: sums over
all taggings take steps per piece of evidence, not per token, and are exact.

Fitting uses at most ``SAMPLE`` labelled documents, chosen by a hash of the id; scoring covers
every document.

Defined cases: a null or wordless text has no tokens and gets the score of a text without
evidence; without toxic or without clean labels there is no evidence and every score is the
smoothed share of toxic labels; a document labelled twice is toxic if one label says so; null
labels don't count; every row gives a row, repeated ones too.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagline.llm.batches import mapped
from lagline.llm.staging import staged

SAMPLE = 8_000
LEXICON = 5_000  # words that the model holds at most, the most significant ones
LEVELS = 4
SIGNIFICANT = 3.0  # standard errors between a word's odds in toxic and in clean documents
TELLING = 4.5  # least log odds ratio of a word that carries evidence
THRESHOLD = 0.7
STEPS = 150
TOXIC_TOKEN = 0.5

_WORD = re.compile(r"[^\W\d_]+")


def _tokens(text: str) -> list[str]:
    low = text.lower()
    return _WORD.findall(low) if len(low) == len(text) else [w.lower() for w in _WORD.findall(text)]


def _evidence(text: str, lexicon: dict[str, int]) -> tuple[int, list[int], list[int]]:
    """How many tokens a text has; the places and strengths of those with evidence."""
    levels = list(map(lexicon.get, _tokens(text)))
    at = [i for i, v in enumerate(levels) if v is not None]
    return len(levels), at, [levels[i] for i in at]


@dataclass
class Chain:
    """Weights of the field; state 1 is toxic. Level 0 is a token without evidence."""

    emit: np.ndarray  # [levels + 1, 2]
    move: np.ndarray  # [2, 2]

    def step(self, level: int) -> np.ndarray:
        return np.exp(self.move + self.emit[level][None, :])

    def plain(self):
        """The step of a token without evidence, taken apart so that powers are cheap."""
        roots, vectors = np.linalg.eig(self.step(0))
        order = np.argsort(-roots.real)
        roots, vectors = roots.real[order], vectors.real[:, order]
        return roots, vectors, np.linalg.inv(vectors)


def _power(plain, length: int) -> np.ndarray:
    """The step's power divided by its largest root's, which cancels in all shares."""
    roots, vectors, inverse = plain
    return (vectors * np.array([1.0, (roots[1] / roots[0]) ** length])) @ inverse


def _pieces(n: int, at: list[int]) -> list[int]:
    """Lengths of the runs without evidence before, between and after the places."""
    ends = [*at, n]
    return [e - s for s, e in zip([0, *(a + 1 for a in at)], ends)]


def _passes(chain: Chain, plain, n: int, at: list[int], levels: list[int]):
    """Forward vectors before and backward vectors after every run and place, each scaled."""
    runs = _pieces(n, at)
    maps = []
    for k, run in enumerate(runs):
        maps.append(_power(plain, run))
        if k < len(at):
            maps.append(chain.step(levels[k]))
    ahead = [np.array([0.5, 0.5])]
    for m in maps:
        v = ahead[-1] @ m
        ahead.append(v / v.sum())
    back = [np.ones(2)]
    for m in reversed(maps):
        v = m @ back[-1]
        back.append(v / v.sum())
    return runs, maps, ahead, back[::-1]


def marginals(chain: Chain, plain, n: int, at: list[int], levels: list[int]) -> list[float]:
    """Chance of the toxic state at each place with evidence."""
    _, _, ahead, back = _passes(chain, plain, n, at, levels)
    out = []
    for k in range(len(at)):
        both = ahead[2 * k + 2] * back[2 * k + 2]
        out.append(float(both[1] / both.sum()))
    return out


def _expected(chain: Chain, plain, n: int, at: list[int], levels: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Expected (level, state) and (state, state) counts over all taggings of a sequence."""
    emit, move = np.zeros_like(chain.emit), np.zeros((2, 2))
    runs, maps, ahead, back = _passes(chain, plain, n, at, levels)
    roots, vectors, inverse = plain
    ratio = roots[1] / roots[0]
    for k, m in enumerate(maps):
        a, b = ahead[k], back[k + 1]
        total = a @ m @ b
        if k % 2:
            pair = a[:, None] * m * b[None, :] / total
            level = levels[k // 2]
        else:
            run = runs[k // 2]
            if not run:
                continue
            # Sum over the run's steps of (roots before the step) x (roots after it).
            cross = (1 - ratio**run) / (1 - ratio) if ratio != 1 else run
            sums = np.array([[run, cross], [cross, run * ratio ** (run - 1)]]) / roots[0]
            left, right = a @ vectors, inverse @ b
            around = inverse.T @ (left[:, None] * sums * right[None, :]) @ vectors.T
            pair = around * chain.step(0) / total
            level = 0
        move += pair
        emit[level] += pair.sum(axis=0)
    return emit, move


class _Batch:
    """Distinct sequences side by side, those with most evidence first; step k is their k-th run or place."""

    def __init__(self, counted: dict[tuple, int]) -> None:
        ordered = sorted(counted.items(), key=lambda item: -len(item[0][1]))
        self.times = np.array([times for _, times in ordered], float)
        runs = [_pieces(n, list(at)) for (n, at, _, _), _ in ordered]
        levels = [found for (_, _, found, _), _ in ordered]
        self.steps: list[tuple[np.ndarray, bool]] = []  # run lengths or levels of the first sequences, and which of the two
        for k in range(max(map(len, runs), default=0)):
            self.steps.append((np.array([r[k] for r in itertools.takewhile(lambda r: len(r) > k, runs)], np.int64), True))
            if some := [v[k] for v in itertools.takewhile(lambda v: len(v) > k, levels)]:
                self.steps.append((np.array(some, np.int64), False))

    def expected(self, chain: Chain) -> tuple[np.ndarray, np.ndarray]:
        """``_expected`` of all sequences, summed up."""
        emit, move = np.zeros_like(chain.emit), np.zeros((2, 2))
        roots, vectors, inverse = chain.plain()
        ratio = roots[1] / roots[0]
        by_level = np.stack([chain.step(level) for level in range(len(chain.emit))])
        dominant, fading = np.outer(vectors[:, 0], inverse[0]), np.outer(vectors[:, 1], inverse[1])
        maps, ahead = [], []
        v = np.full((len(self.times), 2), 0.5)
        for values, is_run in self.steps:
            m = dominant + (ratio**values)[:, None, None] * fading if is_run else by_level[values]
            ahead.append(v[: len(m)].copy())
            v[: len(m)] = np.einsum("si,sij->sj", v[: len(m)], m)
            v[: len(m)] /= v[: len(m)].sum(axis=1, keepdims=True)
            maps.append(m)
        b = np.ones((len(self.times), 2))
        for (values, is_run), m, a in zip(self.steps[::-1], maps[::-1], ahead[::-1]):
            after = b[: len(m)]
            through = np.einsum("sij,sj->si", m, after)
            share = self.times[: len(m)] / (a * through).sum(axis=1)
            if is_run:
                # Sum over a run's steps of (roots before the step) x (roots after it).
                cross = (1 - ratio**values) / (1 - ratio) if ratio != 1 else values.astype(float)
                last = values * ratio ** np.maximum(values - 1, 0)
                left, right = (a @ vectors) * share[:, None], after @ inverse.T
                sums = np.array([[left[:, 0] * right[:, 0] @ values, left[:, 0] * right[:, 1] @ cross], [left[:, 1] * right[:, 0] @ cross, left[:, 1] * right[:, 1] @ last]])
                pair = inverse.T @ (sums / roots[0]) @ vectors.T * by_level[0]
                move += pair
                emit[0] += pair.sum(axis=0)
            else:
                pairs = a[:, :, None] * m * after[:, None, :] * share[:, None, None]
                move += pairs.sum(axis=0)
                np.add.at(emit, values, pairs.sum(axis=1))
            b[: len(m)] = through / through.sum(axis=1, keepdims=True)
        return emit, move


def _observed(n: int, at: list[int], levels: list[int], toxic: bool, shape) -> tuple[np.ndarray, np.ndarray]:
    """Counts of the labelled tagging; the first token's move counts from either state equally."""
    emit, move = np.zeros(shape), np.zeros((2, 2))
    marked = set(at) if toxic else set()
    emit[0, 0] = n - len(at)
    for p, level in zip(at, levels):
        emit[level, 1 if p in marked else 0] += 1
    if n:
        move[:, 1 if 0 in marked else 0] += 0.5
        both = sum(1 for p in marked if p + 1 in marked)
        into = sum(1 for p in marked if p > 0) - both
        out = sum(1 for p in marked if p < n - 1) - both
        move += np.array([[n - 1 - both - into - out, into], [out, both]])
    return emit, move


def fit_chain(sequences: list[tuple[int, list[int], list[int], bool]], steps: int = STEPS) -> Chain:
    """Fit by ``steps`` gradient steps on the conditional likelihood; equal sequences are computed once, all at a time."""
    counted: dict[tuple, int] = {}
    for n, at, levels, toxic in sequences:
        # Plain texts differ in length alone; rounding it to two digits keeps few distinct ones.
        size = n if at else int(float(f"{n:.1e}"))
        key = (size, tuple(at), tuple(levels), toxic and bool(at))
        counted[key] = counted.get(key, 0) + 1
    batch = _Batch(counted)
    shape = (LEVELS + 1, 2)
    seen_emit, seen_move = np.zeros(shape), np.zeros((2, 2))
    for (n, at, levels, toxic), times in counted.items():
        e, m = _observed(n, list(at), list(levels), toxic, shape)
        seen_emit += times * e
        seen_move += times * m
    # Start from the smoothed shares of the labelled tokens, which is already near the optimum.
    emit = np.log((seen_emit + 1) / (seen_emit + 1).sum(axis=0))
    move = np.log((seen_move + 1) / (seen_move + 1).sum(axis=1, keepdims=True))
    chain = Chain(emit, move)
    scale_e, scale_m = seen_emit.sum(axis=1, keepdims=True) + 10, seen_move.sum(axis=1, keepdims=True) + 10
    for _ in range(steps):
        hoped_emit, hoped_move = batch.expected(chain)
        chain = Chain(chain.emit + (seen_emit - hoped_emit) / scale_e, chain.move + (seen_move - hoped_move) / scale_m)
    return chain


def _summary(found: list[float]) -> list[float]:
    """What a document's marginals tell the logistic curve."""
    return [1.0, max(found, default=0.0), float(np.log1p(sum(found)))]


def _fit_curve(rows: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic weights by Newton steps, with a slight pull to zero."""
    weights = np.zeros(rows.shape[1])
    pull = np.full(rows.shape[1], 1e-2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + np.diag(pull)
        move = np.linalg.solve(curve, rows.T @ (toxic - p) - pull * weights)
        weights += np.clip(move, -4, 4)
        if np.abs(move).max() < 1e-8:
            break
    return weights


@dataclass
class Model:
    lexicon: dict[str, int]
    chain: Chain
    curve: np.ndarray

    def __post_init__(self):
        self.plain = self.chain.plain()

    def judge(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """Score of a text, and its toxic tokens as (start, end, marginal) in code points."""
        text = text or ""
        n, at, levels = _evidence(text, self.lexicon)
        found = marginals(self.chain, self.plain, n, at, levels) if at else []
        score = 1 / (1 + np.exp(-np.clip(np.dot(self.curve, _summary(found)), -30, 30)))
        spans: list[tuple[int, int, float]] = []
        if at:
            places = {i: p for i, p in zip(at, found) if p >= TOXIC_TOKEN}
            last = -2
            for i, m in enumerate(_WORD.finditer(text)):
                if i in places:
                    if i == last + 1 and spans:  # neighbouring tokens are one span
                        s, _, p = spans[-1]
                        spans[-1] = (s, m.end(), max(p, places[i]))
                    else:
                        spans.append((*m.span(), places[i]))
                    last = i
        return float(score), spans


def held_out(doc_id: Column) -> Column:
    """Whether a document's labels are kept from fitting."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most ``sample`` labelled documents that aren't held out."""
    known = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # at most `sample` ids
    # Repeated ids may give more rows than that: the first ones in the order of the ids' hashes stay.
    texts = staged(texts.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(sample), "toxicity-sample")
    copies = texts.groupBy("toxic", "text").agg(F.count("*").alias("n"))
    spelled = F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"\p{L}+"), F.lit(0))
    words = copies.select("toxic", "n", F.explode(F.array_distinct(spelled)).alias("word"))
    sums = [F.coalesce(F.sum(n * t), F.lit(0)).alias(c) for n, cs in ((F.col("n"), "ab"), (F.lit(1), "cd")) for t, c in zip((F.col("toxic"), 1 - F.col("toxic")), cs)]
    counts = staged(words.groupBy("word").agg(*sums), "toxicity-words")
    totals = copies.agg(*sums).first()

    def told(toxic: str, clean: str) -> Column:
        """Log odds ratio and its standard errors, if it is telling; both counts are of the same unit."""
        a, b = F.col(toxic) + 0.5, F.col(clean) + 0.5
        odds = F.log(a / (int(totals[toxic]) - F.col(toxic) + 0.5)) - F.log(b / (int(totals[clean]) - F.col(clean) + 0.5))
        z = odds / F.sqrt(1 / a + 1 / b)
        return F.when((z >= SIGNIFICANT) & (odds >= TELLING), F.struct(z.alias("z"), odds.alias("odds")))

    # Greatest skips the unit in which a word isn't telling.
    kept = counts.select("word", F.greatest(told("a", "b"), told("c", "d")).alias("best")).where("best IS NOT NULL").select("word", "best.*")
    kept = kept.orderBy(F.desc("z"), "word").limit(LEXICON).collect() if totals["a"] and totals["b"] else []
    odds_of = np.array([r["odds"] for r in kept])
    cuts = np.quantile(odds_of, np.arange(1, LEVELS) / LEVELS) if len(kept) else []
    lexicon = {r["word"]: 1 + int(np.searchsorted(cuts, r["odds"], side="right")) for r in kept}

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_evidence(t or "", lexicon) for t in batch.column("text").to_pylist()]
            n, at, levels = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(n, pa.int64()), pa.array(at, pa.list_(pa.int64())), pa.array(levels, pa.list_(pa.int64())), batch.column("toxic").cast(pa.int64())],
                names=["n", "at", "levels", "toxic"],
            )

    found = texts.select("text", "toxic").mapInArrow(sequences, "n long, at array<long>, levels array<long>, toxic long").collect()
    rows = [(r["n"], list(r["at"]), list(r["levels"]), bool(r["toxic"])) for r in found]
    chain = fit_chain(rows)
    plain = chain.plain()
    summaries = [_summary(marginals(chain, plain, n, at, levels) if at else []) for n, at, levels, _ in rows]
    if not lexicon:
        share = (sum(r[3] for r in rows) + 0.5) / (len(rows) + 1)
        return Model({}, chain, np.array([np.log(share / (1 - share)), 0.0, 0.0]))
    return Model(lexicon, chain, _fit_curve(np.array(summaries), np.array([float(r[3]) for r in rows])))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, text_key, score, spans`` of every text; spans are (start, end, marginal)."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())]))
    names = ("start", "end", "marginal")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            judged = [model.judge(t) for t in batch.column("text").to_pylist()]
            spans = [[dict(zip(names, s)) for s in found] for _, found in judged]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array([s for s, _ in judged], pa.float64()), pa.array(spans, kind)],
                names=["doc_id", "text_key", "score", "spans"],
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, text_key long, score double, spans array<struct<start:long,end:long,marginal:double>>"
    return docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").mapInArrow(run, schema)


def remove_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """Documents below the threshold, with all their columns; texts aren't shuffled."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return mapped(texts, lambda t: model.judge(t)[0], pa.float64())

    return docs.where(score(F.coalesce("text", F.lit(""))) < threshold)
