"""Exact quantiles by narrowing counted ranges, against numpy on distinct and tied doubles."""

import numpy as np

from tagloom.operators import stats


def test_equal_to_percentile(spark, monkeypatch):
    monkeypatch.setattr(stats, "RANGE_BUCKETS", 8)
    monkeypatch.setattr(stats, "RANGE_ROWS", 3)
    rng = np.random.default_rng(0)
    values = np.concatenate([rng.lognormal(0, 3, 400), rng.normal(0, 1e-9, 50), [5.0] * 30, [-1e300, 1e300]])
    rows = [(["a", "b", None][i % 3], float(v)) for i, v in enumerate(values)] + [("a", None), ("c", 2.5)]
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = {r["g"]: [r[f"q{i}"] for i in range(5)] for r in stats.exact_quantiles(df, "x", probs, "g").collect()}
    for g in ["a", "b", None]:
        mine = np.array([v for (k, v) in rows if k == g and v is not None])
        want = np.percentile(mine, [p * 100 for p in probs], method="linear")
        assert np.allclose(got[g], want, rtol=1e-12, atol=0)
    assert got["c"] == [2.5] * 5
    whole = stats.exact_quantiles(df, "x", probs).first()
    assert np.allclose([whole[f"q{i}"] for i in range(5)], np.percentile(np.append(values, 2.5), [p * 100 for p in probs]), rtol=1e-12, atol=0)
