"""Sources, sinks and integrity checks."""

import os

import pytest
from pyspark.sql import functions as F

from plans import plan_of
from tagloom.operators import evaluate, quality, runs
from tagloom.plans.reports import REPORTS, run_reports
from tagloom.schemas import PREDICTIONS, classes_table
from tagloom.session import scratch_table_path, shared_dir
from tagloom.sources import driver_tables as src
from tagloom.sources import tables as store
from tagloom.sources.raw import loaded_view, normalise, read_raw_csv

CSV = '''"",count,hate_speech,offensive_language,neither,class,tweet
0,3,0,0,3,2,"plain text"
1,3,2,1,0,0,"a ""quoted"" word, and
a second line"
2,6,1,5,0,1,null
'''


@pytest.fixture()
def csv_tables(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(CSV)
    return normalise(read_raw_csv(spark, str(path)))


def test_csv_source(csv_tables):
    rows = csv_tables["tweets"].orderBy("tweet_id").collect()
    assert [r["text"] for r in rows] == ["plain text", 'a "quoted" word, and\na second line', "null"]
    assert [r["class_id"] for r in rows] == [2, 0, 1]
    loaded = loaded_view(csv_tables)
    assert loaded.count() == 3
    assert quality.vote_violations(loaded).count() == 0


def test_tables_are_recreated(spark, csv_tables, tmp_path):
    for _ in range(2):
        store.save_tables(csv_tables, str(tmp_path / "db"))
    tables = store.load_tables(spark, str(tmp_path / "db"))
    assert store.row_count(tables["tweets"]).first()["n"] == 3
    assert loaded_view(tables).count() == 3


def test_class_join_broadcasts(spark, root):
    assert "BroadcastHashJoin" in plan_of(loaded_view(src.tables(spark, root)))


def test_bucketed_tables_join_without_shuffle(spark, root):
    store.save_bucketed(src.tables(spark, root), 4, prefix="bucketed_")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = spark.table("bucketed_tweets").join(spark.table("bucketed_annotations"), "tweet_id")
        assert "Exchange" not in plan_of(joined)
        assert joined.count() == 87
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_filter_reaches_the_scan(spark, csv_tables, tmp_path):
    store.save_tables(csv_tables, str(tmp_path / "db"))
    tweets = store.load_tables(spark, str(tmp_path / "db"))["tweets"]
    plan = plan_of(tweets.where("class_id = 0").select("tweet_id"))
    assert "EqualTo(class_id,0)" in plan
    assert "ReadSchema: struct<tweet_id:bigint,class_id:int>" in plan


def _rows(spark, model, n, pred):
    return spark.range(n).select(
        F.col("id").alias("tweet_id"),
        F.lit(1).alias("true_class_id"),
        F.lit(pred).alias("pred_class_id"),
        F.lit("x").alias("pred_class"),
        *(F.lit(None).cast("double").alias(p) for p in ("prob_hate", "prob_offensive", "prob_neither")),
        F.lit(model).alias("model_name"),
    )


def test_predictions_upsert(spark, tmp_path):
    path = str(tmp_path / "predictions")
    store.upsert_predictions(_rows(spark, "a", 5, 0), path)
    store.upsert_predictions(_rows(spark, "b (x)", 3, 1), path)
    store.upsert_predictions(_rows(spark, "a", 4, 2), path)
    stored = store.read_predictions(spark, path)
    assert {r["model_name"]: r["n"] for r in store.prediction_counts(stored).collect()} == {"a": 4, "b (x)": 3}
    assert stored.where("model_name = 'a'").select("pred_class_id").distinct().first()[0] == 2
    assert stored.columns == PREDICTIONS.fieldNames()
    assert "PartitionFilters: [isnotnull(model_name" in plan_of(stored.where("model_name = 'a'"))


def test_results_resume(spark, tmp_path):
    path = str(tmp_path / "labels")
    assert store.load_results(spark, path, 10) is None
    done = spark.createDataFrame([(1, 0), (2, 1)], "tweet_id long, label_id int")
    store.append_results(done, path, 10)
    store.append_results(spark.createDataFrame([(3, 2)], "tweet_id long, label_id int"), path, 10)
    assert store.load_results(spark, path, 10).count() == 3
    assert store.load_results(spark, path, 11) is None
    todo = spark.range(5).withColumnRenamed("id", "tweet_id")
    left = store.pending(todo, store.load_results(spark, path, 10))
    assert sorted(r[0] for r in left.collect()) == [0, 4]
    assert store.pending(todo, None).count() == 5
    # An answer given again replaces the first; a run of another input is kept apart.
    store.append_results(spark.createDataFrame([(1, 2)], "tweet_id long, label_id int"), path, 10)
    assert {r[0]: r[1] for r in store.load_results(spark, path, 10).collect()} == {1: 2, 2: 1, 3: 2}
    store.append_results(spark.createDataFrame([(7, 0)], "tweet_id long, label_id int"), path, 11)
    assert [tuple(r) for r in store.load_results(spark, path, 11).collect()] == [(7, 0)]
    assert store.load_results(spark, path, 10).count() == 3
    bad = tmp_path / "bad" / "n_total=10"
    bad.mkdir(parents=True)
    (bad / "part.parquet").write_text("not parquet")
    assert store.load_results(spark, str(tmp_path / "bad"), 10) is None
    store.replace_results(done, str(tmp_path / "bad"), 10)
    assert store.load_results(spark, str(tmp_path / "bad"), 10).count() == 2


def test_optional_source(spark, tmp_path):
    assert store.read_if_exists(spark, str(tmp_path / "none")) is None
    spark.range(2).write.parquet(str(tmp_path / "some"))
    assert store.read_if_exists(spark, str(tmp_path / "some")).count() == 2


def test_reports_are_stored(spark, root, tmp_path):
    results = run_reports(src.tables(spark, root), str(tmp_path / "reports"))
    assert list(results) == list(REPORTS)
    assert spark.read.parquet(str(tmp_path / "reports/Q1")).count() == 3


def test_metrics_json(spark, tmp_path):
    df = spark.createDataFrame([(0, 0), (1, 2), (2, 2)], "true_class_id int, pred_class_id int")
    cells = evaluate.confusion_row(df)
    path = str(tmp_path / "metrics")
    store.save_metrics_json(evaluate.metrics(cells), evaluate.classification_report(cells), "m", path)
    row = spark.read.json(path).first()
    assert row["model"] == "m" and row["metrics"]["accuracy"] == pytest.approx(2 / 3)
    assert len(row["classification_report"]) == 6


def test_runs_and_comparison(spark, tmp_path):
    rows = runs.run_rows(spark, "a", {"C": 1.0}, {"f1_macro": 0.5}).unionByName(
        runs.run_rows(spark, "b", {"C": 3.0}, {"f1_macro": 0.5})
    )
    runs.append_runs(rows, str(tmp_path / "runs"))
    compared = runs.comparison(spark.read.parquet(str(tmp_path / "runs")), ["f1_macro"])
    assert runs.best_run(compared, "val_f1_macro").first()["model"] == "a"
    store.save_csv(compared, str(tmp_path / "cmp"))
    store.append_csv(compared, str(tmp_path / "cmp"))
    assert spark.read.option("header", True).csv(str(tmp_path / "cmp")).count() == 4


def test_integrity_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "tweet_id long, text string")
    assert quality.duplicate_keys(df, ["tweet_id"]).first()["n_rows"] == 2
    assert {r["column_name"]: r["n_null"] for r in quality.null_counts(df, ["tweet_id", "text"]).collect()} == {
        "tweet_id": 0, "text": 1}
    assert quality.orphans(df, spark.range(2), "tweet_id", "id").count() == 1
    assert quality.unknown_classes(spark.createDataFrame([(0,), (7,)], "class_id int")).count() == 1
    with pytest.raises(ValueError):
        quality.assert_no_leakage(["char_count", "hate_votes"])
    assert classes_table(spark).count() == 3


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert os.path.dirname(scratch_table_path(spark, "x")) == shared_dir(spark)


def test_exploratory_report(spark, root):
    from tagloom.plans.reports import exploratory_report

    report = exploratory_report(src.tables(spark, root))
    assert len(report) == 10
    assert report["char_count_bins"].count() == 40
    assert report["correlation"].count() == 49
