"""Distributions and correlation against numpy and pandas."""

import random

import numpy as np
import pandas as pd
import pytest

from tagloom.operators import stats
from tagloom.operators.scaling import Scaler


@pytest.fixture(scope="module")
def numbers(spark):
    rng = random.Random(11)
    rows = [
        (rng.choice("ab"), 4 if rng.random() < 0.4 else rng.randrange(200), rng.random(), 3, rng.gauss(0, 1))
        for _ in range(2000)
    ]
    pdf = pd.DataFrame(rows, columns=["g", "v", "x", "k", "z"])
    pdf["y"] = pdf["x"] * 2 + pdf["z"] * 0.01
    return pdf, spark.createDataFrame(pdf).repartition(5).persist()


def test_describe(numbers):
    pdf, df = numbers
    got = stats.describe(df, "v").first()
    want = pdf["v"].describe()
    assert list(got) == pytest.approx(list(want))


def test_histogram(numbers):
    pdf, df = numbers
    counts, edges = np.histogram(pdf["v"], bins=40)
    rows = stats.histogram(df, "v", 40).orderBy("bin").collect()
    assert [r["n"] for r in rows] == list(counts)
    assert [r["low_edge"] for r in rows] == pytest.approx(list(edges[:-1]))
    grouped = stats.histogram(df, "x", 20, "g").collect()
    assert len(grouped) == 40 and sum(r["n"] for r in grouped) == len(pdf)


def test_histogram_counts_the_source_once(numbers):
    from plans import plan_of

    plan = plan_of(stats.histogram(numbers[1], "v", 40))
    assert "Cartesian" not in plan and "InMemoryTableScan" not in plan  # only the written counts


def test_box(numbers):
    pdf, df = numbers
    for r in stats.box_stats(df, "v", "g").collect():
        v = pdf.loc[pdf["g"] == r["g"], "v"]
        q1, q2, q3 = np.percentile(v, [25, 50, 75])
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = v[(v >= low) & (v <= high)]
        assert (r["q1"], r["median"], r["q3"]) == pytest.approx((q1, q2, q3))
        assert (r["whisker_low"], r["whisker_high"]) == (inside.min(), inside.max())
        assert r["n_outliers"] == len(v) - len(inside)


def test_correlation(numbers):
    pdf, df = numbers
    columns = ["v", "x", "k", "y"]
    want = pdf[columns].corr()
    long_form = stats.correlation(df, columns)
    for r in long_form.collect():
        expected = want.loc[r["feature_a"], r["feature_b"]]
        assert (r["r"] is None) if np.isnan(expected) else r["r"] == pytest.approx(expected)
    assert stats.drop_correlated(df, columns, 0.95) == ["v", "x", "k"]
    wide = stats.correlation_matrix(long_form, columns).orderBy("i").collect()
    assert [r["feature_a"] for r in wide] == columns and wide[1]["k"] is None


def test_scaler(numbers):
    pdf, df = numbers
    scaler = Scaler.fit(df, ["v", "k"])
    out = scaler.transform(df).toPandas()
    want = (pdf["v"] - pdf["v"].mean()) / pdf["v"].std(ddof=0)
    assert sorted(out["v_scaled"]) == pytest.approx(sorted(want))
    assert (out["k_scaled"] == 0).all()
    assert Scaler.from_dict(scaler.to_dict()) == scaler


def test_value_counts(numbers):
    pdf, df = numbers
    got = {r["g"]: (r["n"], r["share_pct"]) for r in stats.value_counts(df, "g", 2).collect()}
    for g, n in pdf["g"].value_counts().items():
        assert got[g] == (n, pytest.approx(round(100 * n / len(pdf), 2)))
