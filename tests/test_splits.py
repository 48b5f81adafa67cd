"""Splits, folds, samples and row numbers against brute force, with hot classes and keys."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from tagloom.operators import quality
from tagloom.operators.ranking import running_totals, top_overall, top_per_group, with_batches, with_row_number
from tagloom.operators.sizing import small_side
from tagloom.operators.splits import (
    class_weights,
    exact_sample,
    stratified_folds,
    stratified_split,
    with_class_weight,
)


def _hash(key):
    return hashlib.md5(f"{key}|42".encode()).hexdigest()


@pytest.fixture(scope="module")
def skewed(spark):
    """Class 1 holds nine tenths of the rows, class 2 a single one."""
    rng = random.Random(1)
    rows = [(i * 7 + 3, 2 if i == 0 else (1 if rng.random() < 0.9 else 0)) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "tweet_id long, class_id int").repartition(8).persist()


def _ordered(rows, class_id):
    return sorted((k for k, c in rows if c == class_id), key=lambda k: (_hash(k), k))


def test_split_matches_full_sort(skewed):
    rows, df = skewed
    got = {r["tweet_id"]: r["split"] for r in stratified_split(df).collect()}
    assert len(got) == len(rows)
    for class_id in (0, 1, 2):
        keys = _ordered(rows, class_id)
        n = len(keys)
        a, b = math.floor(n * 70 / 100), math.floor(n * 85 / 100)
        assert {got[k] for k in keys[:a]} <= {"train"}
        assert {got[k] for k in keys[a:b]} <= {"validation"}
        assert {got[k] for k in keys[b:]} <= {"test"}


def test_split_is_repeatable_and_disjoint(skewed):
    _, df = skewed
    first = stratified_split(df)
    again = stratified_split(df.repartition(3))
    assert first.exceptAll(again).count() == 0
    assert quality.split_overlap(first).count() == 0
    parts = [first.where(F.col("split") == s) for s in ("train", "validation", "test")]
    assert sum(p.count() for p in parts) == df.count()
    assert quality.leaked_keys(parts[0], parts[2]).count() == 0


def test_folds_and_sample(skewed):
    rows, df = skewed
    got = {r["tweet_id"]: r["fold"] for r in stratified_folds(df, 3).collect()}
    keys = _ordered(rows, 1)
    n = len(keys)
    for i, k in enumerate(keys):
        assert got[k] == sum(i >= math.floor(n * j / 3) for j in (1, 2))
    sample = [r["tweet_id"] for r in exact_sample(df, 0.25).collect()]
    everything = sorted((k for k, _ in rows), key=lambda k: (_hash(k), k))
    assert sorted(sample) == sorted(everything[: round(0.25 * len(rows))])


def test_class_weights(skewed):
    rows, df = skewed
    counts = {c: sum(1 for _, x in rows if x == c) for c in (0, 1, 2)}
    for r in class_weights(df).collect():
        assert r["weight"] == pytest.approx(len(rows) / (3 * counts[r["class_id"]]))
    assert with_class_weight(df).agg(F.sum("weight")).first()[0] == pytest.approx(len(rows))


def test_row_numbers_with_hot_key(spark):
    rng = random.Random(2)
    rows = [(500 if rng.random() < 0.5 else rng.randrange(10**12), i) for i in range(4000)]
    df = spark.createDataFrame(rows, "k long, t long").repartition(8)
    got = [(r["k"], r["t"]) for r in with_row_number(df, "k", tie=["t"]).orderBy("rn").collect()]
    assert got == sorted(rows)
    batches = with_batches(df, "k", 7, tie=["t"]).groupBy("batch_id").count().collect()
    assert sorted(r["count"] for r in batches)[1:] == [7] * (len(rows) // 7)


def test_running_totals_per_group(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.random(), rng.randrange(5)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "g string, s double, v long")
    got = {(r["g"], r["s"]): r["below"] for r in running_totals(df, "s", {"below": F.col("v")}, ["g"]).collect()}
    for g in "ab":
        total = 0
        for _, s, v in sorted(r for r in rows if r[0] == g):
            assert got[(g, s)] == total
            total += v


def test_empty_input(spark):
    df = spark.createDataFrame([], "tweet_id long, class_id int")
    assert stratified_split(df).count() == 0
    assert with_row_number(df, "tweet_id").count() == 0


def test_tops(spark):
    df = spark.createDataFrame([("a", "x", 3), ("a", "y", 3), ("a", "z", 1), ("b", "q", 9)], "g string, w string, n int")
    top = top_per_group(df, ["g"], [F.desc("n"), "w"], 1).collect()
    assert {(r["g"], r["w"]) for r in top} == {("a", "x"), ("b", "q")}
    assert [r["w"] for r in top_overall(df, [F.desc("n"), "w"], 3).orderBy("rank").collect()] == ["q", "x", "y"]


def test_group_limit_is_pushed_below_the_shuffle(spark):
    from plans import plan_of

    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    assert plan_of(top_per_group(df, ["g"], ["id"], 2)).count("WindowGroupLimit") == 2


def test_large_side_is_not_broadcast(spark):
    df = spark.range(50)
    assert small_side(df, max_rows=10) is df
    assert small_side(df, max_rows=100).count() == 50


def test_overlap_is_found(spark):
    df = spark.createDataFrame([(1, "train"), (1, "test"), (2, "test"), (2, "test")], "tweet_id long, split string")
    assert [tuple(r) for r in quality.split_overlap(df).collect()] == [(1, "test", "train")]


def test_rows_without_key_come_first(spark):
    df = spark.createDataFrame([(None, "a"), (3.0, "b"), (None, "c"), (1.0, "d"), (2.0, "e")], "k double, name string")
    got = {r["name"]: r["rn"] for r in with_row_number(df, "k", tie=["name"]).collect()}
    assert got == {"a": 1, "c": 2, "d": 3, "e": 4, "b": 5}
    grouped = spark.createDataFrame([(None, 1.0), (None, 2.0), ("x", None), ("x", 5.0)], "g string, k double")
    rows = running_totals(grouped, "k", {"before": F.lit(1)}, group=["g"]).collect()
    assert sorted((r["g"] or "", r["k"] or 0.0, r["before"]) for r in rows) == [("", 1.0, 0), ("", 2.0, 1), ("x", 0.0, 0), ("x", 5.0, 1)]
