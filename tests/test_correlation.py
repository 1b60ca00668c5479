import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors

from lagline.operators import contingency, correlation


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(7)
    n = 500
    base = rng.normal(size=n)
    pdf = pd.DataFrame({f"x{i}": rng.normal(size=n) * 10**i + 1000 for i in range(3)})
    pdf["copy"] = pdf["x0"] * 3 + 1
    pdf["mixed"] = base + pdf["x1"] / 10
    pdf["gaps"] = np.where(rng.random(n) < 0.4, np.nan, pdf["x0"] + rng.normal(size=n))
    pdf["more_gaps"] = np.where(rng.random(n) < 0.3, np.nan, base)
    pdf["same"] = 0.1
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in pdf.to_numpy()]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in pdf.columns)).repartition(3).cache()
    return pdf, df


@pytest.mark.parametrize("block,held", [(128, 64 << 20), (3, 64 << 20), (2, 1)])
def test_pairs_equal_pandas(frame, monkeypatch, block, held):
    monkeypatch.setattr(correlation, "BLOCK", block)
    monkeypatch.setattr(correlation, "HELD_BYTES", held)
    pdf, df = frame
    columns = list(pdf.columns)
    want = pdf.corr()
    pairs = correlation.correlation_pairs(df, columns).collect()
    assert len(pairs) == len(columns) * (len(columns) - 1) // 2
    for p in pairs:
        r = want.loc[p["left"], p["right"]]
        if "same" in (p["left"], p["right"]):
            assert p["r"] is None
        else:
            assert abs(p["r"] - r) < 1e-9


def test_matrix_has_both_triangles(frame):
    pdf, df = frame
    matrix = correlation.correlation_matrix(df, ["x0", "copy", "mixed"]).toPandas()
    square = matrix.pivot(index="left", columns="right", values="r")
    assert np.allclose(square, square.T) and np.allclose(np.diag(square), 1)


def test_pruning_keeps_the_column_closer_to_the_target(spark):
    rng = np.random.default_rng(8)
    target = rng.normal(size=400)
    near, far = target + 0.3 * rng.normal(size=400), target + 0.9 * rng.normal(size=400)
    alone = rng.normal(size=400)
    rows = [tuple(map(float, r)) for r in np.column_stack([far, alone, target, near])]
    df = spark.createDataFrame(rows, "far double, alone double, target double, near double")
    assert correlation.prune_for_target(df, df.columns, "target", 0.5) == ["far"]


def test_pruning_follows_a_chain(spark):
    """Each column is close to the next; which of them go follows the greedy rule column by column."""
    rng = np.random.default_rng(9)
    target = rng.normal(size=600)
    chain = [target + rng.normal(size=600)]
    for _ in range(6):
        chain.append(chain[-1] + 0.6 * rng.normal(size=600))
    pdf = pd.DataFrame({**{f"x{i}": c for i, c in enumerate(chain)}, "target": target})
    df = spark.createDataFrame([tuple(map(float, r)) for r in pdf.to_numpy()], ", ".join(f"{c} double" for c in pdf.columns))
    r, gone = pdf.corr().abs(), set()
    others = [c for c in pdf.columns if c != "target"]
    for a in others:
        for b in others[others.index(a) + 1 :]:
            if a in gone:
                break
            if b not in gone and r.loc[a, b] > 0.5:
                gone.add(b if r.loc[a, "target"] >= r.loc[b, "target"] else a)
    assert 2 <= len(gone) < len(others)
    assert correlation.prune_for_target(df, list(pdf.columns), "target", 0.5) == [c for c in pdf.columns if c in gone]


def test_vector_slots(spark, frame):
    pdf, _ = frame
    x = pdf[["x0", "copy", "mixed", "same", "x1"]].to_numpy()
    df = spark.createDataFrame([(Vectors.dense(r),) for r in x.tolist()], ["v"]).repartition(3)
    assert correlation.vector_selection(df, "v", x.mean(axis=0).tolist(), 0.01, 0.9) == [0, 2, 4]


def test_dropped_column_still_drops_later_ones(spark):
    pairs = spark.createDataFrame([("a", "b", 0.99), ("b", "c", 0.98), ("a", "c", 0.5)], "left string, right string, r double")
    got = correlation.columns_correlated_with_earlier(pairs, 0.95).collect()
    assert sorted(r["column"] for r in got) == ["b", "c"]


# Critical points of the chi-square distribution at 0.05 and 0.001.
@pytest.mark.parametrize(
    "dof,at_05,at_001",
    [(1, 3.841459, 10.827566), (2, 5.991465, 13.815511), (3, 7.814728, 16.266236), (4, 9.487729, 18.466827),
     (5, 11.070498, 20.515006), (24, 36.415029, 51.178598), (49, 66.338649, 85.350564)],
)
def test_chi_square_tail(dof, at_05, at_001):
    assert abs(contingency.chi2_tail(at_05, dof) - 0.05) < 1e-6
    assert abs(contingency.chi2_tail(at_001, dof) - 0.001) < 1e-6
    assert contingency.chi2_tail(0.0, dof) == 1.0


def test_two_by_two_is_corrected(spark):
    rows = [("a", 0)] * 10 + [("a", 1)] * 20 + [("b", 0)] * 25 + [("b", 1)] * 12 + [(None, 1)] * 5
    df = spark.createDataFrame(rows, "kind string, late int")
    got = contingency.chi_square(df, ["kind"], "late").first()
    observed = np.array([[10, 20], [25, 12]])
    expected = observed.sum(1, keepdims=True) * observed.sum(0) / observed.sum()
    want = ((np.abs(observed - expected) - 0.5) ** 2 / expected).sum()
    assert got["dof"] == 1 and abs(got["statistic"] - want) < 1e-9 and got["significant"]
    margins = contingency.contingency_with_margins(df, ["kind"], "late").toPandas().set_index("category")
    assert margins.loc["All", "n"] == 67 and margins.loc["a", "n_1"] == 20
