import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lagline.functions import quantiles as q
from lagline.functions.quantiles import quantiles

PROBABILITIES = [0.0, 0.25, 0.333, 0.5, 0.75, 0.99, 1.0]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(1)
    n = 3000
    pdf = pd.DataFrame(
        {
            "even": rng.normal(size=n),
            "hot": np.where(rng.random(n) < 0.4, 7.0, rng.random(n) * 14),  # a third at one value
            "few": rng.integers(0, 4, n).astype(float),
            "same": 5.0,
            "gaps": np.where(rng.random(n) < 0.3, np.nan, rng.exponential(size=n)),
        }
    )
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in pdf.to_numpy()]
    schema = ", ".join(f"{c} double" for c in pdf.columns)
    return pdf, spark.createDataFrame(rows, schema).repartition(4).cache()


@pytest.mark.parametrize("limit", [10_000, 50, 3])
def test_equals_linear_interpolation(frame, limit):
    pdf, df = frame
    found = quantiles(df, list(pdf.columns), PROBABILITIES, limit=limit)
    for c in pdf.columns:
        want = np.quantile(pdf[c].dropna(), PROBABILITIES)
        assert np.allclose(found[c], want, rtol=0, atol=1e-12), c


def test_column_without_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0)], "a double, b double")
    assert quantiles(df, ["a", "b"], [0.5]) == {"a": [None], "b": [1.5]}


def test_sketch_is_close(frame):
    pdf, df = frame
    found = quantiles(df, ["even"], [0.5], exact=False)["even"][0]
    assert abs((pdf["even"] <= found).mean() - 0.5) < 0.01


def test_stored_sketches_merge(frame, spark, tmp_path):
    """Sketches of parts, written and merged, lead to the exact quantiles of the whole."""
    pdf, df = frame
    columns = list(pdf.columns)
    parts = [df.where("even < 0"), df.where("even >= 0")]
    for i, part in enumerate(parts):
        q.quantile_sketches(part, columns).write.parquet(str(tmp_path / str(i)))
    kept = q.merged_sketches(*[spark.read.parquet(str(tmp_path / str(i))) for i in range(2)])
    assert {r["column"]: r["n"] for r in kept.collect()} == pdf.count().to_dict()
    found = quantiles(df, columns, PROBABILITIES, sketches=kept)
    for c in columns:
        assert np.allclose(found[c], np.quantile(pdf[c].dropna(), PROBABILITIES), rtol=0, atol=1e-12), c


def test_large_column_needs_few_scans(spark, monkeypatch):
    """A million values: the sketch's bracket holds few enough to be counted and read at once."""
    scans = []
    for step in ("_settle", "_narrow", "_read"):
        kept = getattr(q, step)
        monkeypatch.setattr(q, step, lambda *a, kept=kept, step=step: scans.append(step) or kept(*a))
    df = spark.range(1_000_000).select(((F.col("id") * 7919) % 1_000_003).cast("double").alias("x"))
    got = quantiles(df, ["x"], [0.25, 0.5, 0.75])["x"]
    values = np.sort(np.arange(1_000_000) * 7919 % 1_000_003)
    assert got == np.quantile(values, [0.25, 0.5, 0.75]).tolist()
    assert scans.count("_narrow") <= 1 and scans[-1] == "_read"
