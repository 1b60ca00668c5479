"""Most frequent values by bounded summaries against full counts."""

from collections import Counter

import numpy as np
import pytest

from lagline.functions import heavy


def expected(columns, k, nulls=True):
    out = []
    for name, values in columns.items():
        counts = Counter(v for v in values if nulls or v is not None)
        best = sorted(counts.items(), key=lambda x: (-x[1], x[0] is None, x[0] or ""))[:k]
        out += [(name, v, n, i + 1) for i, (v, n) in enumerate(best)]
    return sorted(out, key=str)


def frame(spark, columns, parts=5):
    rows = list(zip(*columns.values()))
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns)).repartition(parts)


def columns(n=6000, seed=2):
    rng = np.random.default_rng(seed)
    heavy_values = [f"z{v}" for v in rng.zipf(1.3, n)]
    return {
        "zipf": heavy_values,
        "flat": [f"f{i}" for i in range(n)],
        "gaps": [None if i % 3 else f"g{i % 50}" for i in range(n)],
        "ties": [f"t{i % 400}" for i in range(n)],
        "none": [None] * n,
        "a.b": ["x"] * n,
    }


@pytest.mark.parametrize("counters", [4096, 60, 20])
@pytest.mark.parametrize("nulls", [True, False])
def test_equals_full_counts(spark, counters, nulls):
    data = columns()
    found = heavy.most_frequent(frame(spark, data), list(data), 7, nulls, counters)
    assert sorted([tuple(r) for r in found.collect()], key=str) == expected(data, 7, nulls)


def test_frequent_values_are_proven_without_a_full_count(spark, monkeypatch):
    """With few counters the summaries of a skewed column still rule all others out."""
    data = {"v": ["a"] * 3000 + ["b"] * 2000 + [f"x{i}" for i in range(2000)]}
    df = frame(spark, data)
    monkeypatch.setattr(heavy, "value_counts", None)  # counting everything would fail
    seen = {}
    stage = heavy.stage_table
    monkeypatch.setattr(heavy, "stage_table", lambda df, name: seen.setdefault(name, stage(df, name)))
    found = heavy.most_frequent(df, ["v"], 2, counters=30)
    assert [(r["value"], r["n"]) for r in found.orderBy("rank").collect()] == [("a", 3000), ("b", 2000)]
    assert seen["value-summaries"].count() <= 5 * 31  # tasks times counters


def test_empty_table(spark):
    assert heavy.most_frequent(frame(spark, {"v": ["a"]}).where("false"), ["v"], 3).count() == 0
