"""Metrics against committed figures and brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tagloom.operators import evaluate, predictions
from tagloom.schemas import PROB_COLUMNS

# True counts, predicted counts, true positives and the published metrics.
PUBLISHED = [
    ((215, 2879, 624), (337, 2843, 538), (130, 2662, 492),
     {"accuracy": 0.883271, "balanced_accuracy": 0.772580, "f1_macro": 0.749425, "f1_weighted": 0.889841,
      "precision_macro": 0.745530, "recall_macro": 0.772580}),
    ((215, 2879, 624), (675, 2315, 728), (147, 2249, 580),
     {"accuracy": 0.800430, "balanced_accuracy": 0.798127, "f1_macro": 0.684775, "f1_weighted": 0.833679,
      "precision_macro": 0.661990, "recall_macro": 0.798127}),
    ((215, 2879, 624), (67, 3003, 648), (37, 2769, 549),
     {"accuracy": 0.902367, "balanced_accuracy": 0.671231, "f1_macro": 0.689045, "f1_weighted": 0.889103,
      "precision_macro": 0.773846, "recall_macro": 0.671231}),
]
CHANCE = [(0.693234, 0.691491), (0.615420, 0.579409), (0.721345, 0.716412)]


def _cells_from_margins(true, pred, hit):
    """Any confusion matrix with these margins; all count metrics depend on them only."""
    off_row = [t - h for t, h in zip(true, hit)]
    off_col = [p - h for p, h in zip(pred, hit)]
    # Off-diagonal cells a=(0,1) free, the other five follow from the margins.
    for a in range(off_row[0] + 1):
        c01, c02 = a, off_row[0] - a
        c21 = off_col[1] - c01
        c20 = off_row[2] - c21
        c10 = off_col[0] - c20
        c12 = off_row[1] - c10
        if min(c21, c20, c10, c12) >= 0 and c12 + c02 == off_col[2]:
            return [[hit[0], c01, c02], [c10, hit[1], c12], [c20, c21, hit[2]]]
    raise AssertionError("no such matrix")


@pytest.mark.parametrize("i", range(3))
def test_published_metrics(spark, i):
    true, pred, hit, want = PUBLISHED[i]
    matrix = _cells_from_margins(true, pred, hit)
    rows = [(t, p, matrix[t][p]) for t in range(3) for p in range(3)]
    df = spark.createDataFrame(rows, "true_class_id int, pred_class_id int, n long")
    cells = evaluate.confusion_row(df, rows="n")
    got = evaluate.metrics(cells).first()
    for name, value in want.items():
        assert got[name] == pytest.approx(value, abs=1e-6)
    assert got["mcc"] == pytest.approx(CHANCE[i][0], abs=1e-6)
    assert got["cohen_kappa"] == pytest.approx(CHANCE[i][1], abs=1e-6)
    report = {r["label"]: r for r in evaluate.classification_report(cells).collect()}
    assert report["hate"]["support"] == 215
    assert report["macro avg"]["f1_score"] == pytest.approx(want["f1_macro"], abs=1e-6)
    assert report["weighted avg"]["recall"] == pytest.approx(want["accuracy"], abs=1e-6)


def test_one_class_only(spark):
    df = spark.createDataFrame([(1, 1)] * 5, "true_class_id int, pred_class_id int")
    got = evaluate.metrics(evaluate.confusion_row(df)).first()
    assert (got["accuracy"], got["f1_macro"], got["mcc"], got["cohen_kappa"]) == (1.0, 1.0, 0.0, 0.0)
    assert evaluate.confusion(df).count() == 9


@pytest.fixture(scope="module")
def scored(spark):
    """Class-0 probabilities take few values; one of them is held by half of the rows."""
    rng = random.Random(7)
    rows = []
    for i in range(1500):
        p0 = 0.25 if rng.random() < 0.5 else round(rng.random(), 2)
        p1 = (1 - p0) * rng.random()
        rows.append((i, rng.choice((0, 1, 1, 1, 2)), p0, p1, 1 - p0 - p1))
    names = ", ".join(f"{p} double" for p in PROB_COLUMNS)
    return rows, spark.createDataFrame(rows, f"tweet_id long, true_class_id int, {names}").repartition(6).persist()


def test_auc_by_pairs(scored):
    rows, df = scored
    got = {r["class_id"]: r["auc"] for r in evaluate.auc_ovr(df).collect()}
    for k in range(3):
        pos = [r[2 + k] for r in rows if r[1] == k]
        neg = [r[2 + k] for r in rows if r[1] != k]
        wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
        assert got[k] == pytest.approx(wins / (len(pos) * len(neg)))
    assert evaluate.macro_auc(df).first()[0] == pytest.approx(sum(got.values()) / 3)


def test_auc_of_absent_class_is_null(spark, scored):
    _, df = scored
    assert evaluate.macro_auc(df.where("true_class_id <> 0")).first()[0] is None


def test_log_loss(scored):
    rows, df = scored
    eps = 2.220446049250313e-16
    want = -sum(math.log(min(max(r[2 + r[1]], eps), 1 - eps)) for r in rows) / len(rows)
    assert evaluate.log_loss(df).first()[0] == pytest.approx(want)


def _macro_f1(pairs):
    scores = []
    for k in range(3):
        hit = sum(t == k == p for t, p in pairs)
        seen = sum(t == k for t, _ in pairs) + sum(p == k for _, p in pairs)
        if seen:
            scores.append(2 * hit / seen)
    return sum(scores) / len(scores)


def test_thresholds_by_brute_force(scored):
    rows, df = scored
    got = {r["i"]: r["f1_macro"] for r in evaluate.threshold_scores(df).collect()}
    want = {}
    for i in range(90):
        t = 0.05 + i * 0.01
        pairs = [(r[1], 0 if r[2] >= t else (1 if r[3] >= r[4] else 2)) for r in rows]
        want[i] = _macro_f1(pairs)
    assert got == pytest.approx(want)
    best = evaluate.tune_threshold(df).first()
    assert best["i"] == min(i for i in want if want[i] == max(want.values()))
    applied = evaluate.apply_threshold(df, best["threshold"])
    f1 = evaluate.metrics(evaluate.confusion_row(applied)).first()["f1_macro"]
    assert f1 == pytest.approx(best["f1_macro"])


def test_threshold_reads_data_in_one_small_aggregate(scored):
    from plans import plan_of

    plan = plan_of(evaluate.threshold_scores(scored[1]))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_softmax_and_rows(spark):
    df = spark.createDataFrame([(1, 2, [1.0, 1.0, 0.0]), (2, 0, [800.0, -800.0, 0.0])],
                               "tweet_id long, true_class_id int, s array<double>")
    rows = predictions.prediction_rows(predictions.from_scores(df, "s"), "m").orderBy("tweet_id").collect()
    assert rows[0]["pred_class"] == "hate" and rows[1]["prob_hate"] == 1.0
    e = math.e
    assert rows[0]["prob_neither"] == pytest.approx(1 / (2 * e + 1))
    bare = predictions.prediction_rows(df.withColumn("pred_class_id", F.lit(1)), "m", False).first()
    assert bare["prob_hate"] is None and bare["pred_class"] == "offensive"


def test_review_queue(scored):
    rows, df = scored
    got = [r["tweet_id"] for r in evaluate.review_queue(df, 20).collect()]
    assert got == [r[0] for r in sorted(rows, key=lambda r: (-r[2], r[0]))[:20]]


def test_auc_of_missing_scores_is_null(spark):
    rows = [(0, 0.9, 0.1), (0, None, 0.2), (1, 0.1, 0.8), (1, 0.4, 0.9)]
    df = spark.createDataFrame(rows, "true_class_id int, a double, b double")
    got = {r["class_id"]: r["auc"] for r in evaluate.auc_ovr(df, probs=["a", "b"], classes=[0, 1]).collect()}
    assert got == {0: None, 1: 1.0}
