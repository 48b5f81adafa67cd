"""Augmentation merge and external-label batches on small hand-made tables."""

import json

import pytest
from pyspark.sql import functions as F

from tagloom.operators import augment, labelling


@pytest.fixture(scope="module")
def train(spark):
    rows = [(i, f"text number {i}", 3, i % 3, "x", 0, 0, 3, f"text number {'abcdefghij'[i % 10]}", 3) for i in range(30)]
    names = ("tweet_id long, text string, annotator_count int, class_id int, class_name string, hate_votes int, "
             "offensive_votes int, neither_votes int, clean_text string, clean_word_count int")
    return spark.createDataFrame(rows, names)


def test_rare_batches(train):
    rows = augment.quote(augment.assign_template(augment.rare_class_batches(train, size=4))).orderBy("tweet_id").collect()
    assert [r["tweet_id"] for r in rows] == list(range(0, 30, 3))
    assert [(r["batch_id"], r["number"]) for r in rows] == [(i // 4, i % 4 + 1) for i in range(10)]
    for r in rows:
        assert 1 <= r["template_id"] <= 25
        assert r["quote_context"] == augment.QUOTE_TEMPLATES[r["template_id"] - 1].format(text=r["clean_text"])


def test_variants_to_training_rows(spark, train):
    good = {"original_text": "one", "counterfactuals": ["two", "three", "!!!"], "misspelling": "fuor",
            "paraphrase": "five", "quote_context": 'Someone wrote: "one"'}
    df = spark.createDataFrame([(0, json.dumps(good)), (3, "{broken")], "tweet_id long, payload string")
    flat = augment.flatten_variants(augment.parse_responses(df))
    rows = augment.with_new_ids(augment.synthetic_rows(flat), train).orderBy("tweet_id").collect()
    assert [r["tweet_id"] for r in rows] == list(range(30, 37))
    assert [r["class_id"] for r in rows] == [0] * 6 + [2]
    assert rows[0]["class_name"] == "hate_speech" and rows[-1]["class_name"] == "neither"
    assert (rows[0]["hate_votes"], rows[-1]["neither_votes"], rows[0]["annotator_count"]) == (3, 3, 3)
    without = augment.flatten_variants(augment.parse_responses(df), keep_original=False)
    assert without.count() == 6

    merged = augment.merge_into_train(train, augment.with_new_ids(augment.synthetic_rows(flat), train))
    assert merged.columns == train.columns
    assert merged.count() == 36  # "!!!" is cleaned to nothing
    assert merged.where("tweet_id >= 30 AND clean_text = 'someone wrote one'").count() == 1
    assert augment.merge_into_train(train, None) is train


def test_align_columns(train):
    out = augment.align_columns(train, ["clean_text", "extra", "tweet_id"])
    assert out.columns == ["clean_text", "extra", "tweet_id"]
    assert out.where("extra IS NOT NULL").count() == 0


@pytest.fixture(scope="module")
def numbered(train):
    return labelling.number_rows(train.select("tweet_id", "text", "class_id"), size=4)


def test_requests(numbered):
    first = labelling.build_requests(numbered).orderBy("group_id").collect()
    assert len(first) == 8 and first[-1]["n_texts"] == 2
    assert first[1]["body"].split("\n") == [f'{i}: "text number {i + 4}"' for i in range(4)]


def test_prompts(numbered, train):
    examples = labelling.few_shot_examples(train)
    prompt = labelling.build_prompts(labelling.build_requests(numbered), examples, "Sort these.").orderBy("group_id").first()["prompt"]
    assert prompt.startswith('Sort these.\n\nText: "text number 0"\nClassification: {"label_id": 0, "label_name": "Hate Speech"}')
    assert prompt.endswith('3: "text number 3"')


def test_incomplete_groups(spark, numbered, train):
    def answer(group, indices):
        return (group, json.dumps([{"index": i, "label_id": 1, "label_name": "x"} for i in indices]))

    payloads = [answer(0, [0, 1, 2, 3]), answer(1, [3, 2, 1, 0, 0]), answer(2, [0, 1, 2]), answer(3, [0, 1, 2, 4]),
                answer(4, [1, 2, 3, 4]), (5, "no json"), answer(7, [0, 1])]
    responses = labelling.parse_responses(spark.createDataFrame(payloads, "group_id long, payload string"))
    checked = labelling.validate_groups(numbered, responses)
    assert {r["group_id"] for r in checked.where("complete").collect()} == {0, 1, 7}
    labels = labelling.accepted_labels(numbered, responses, checked)
    assert labels.count() == 10
    assert labelling.single_requests(numbered, checked).count() == 20
    final = labelling.with_fallback(train, labels)
    assert final.where("needs_review").count() == 20
    assert final.where("needs_review").select("label_id").distinct().first()[0] == 2
    open_groups = labelling.pending_groups(numbered, labels).select("group_id").distinct().collect()
    assert {r[0] for r in open_groups} == {2, 3, 4, 5, 6}


def test_answers_without_label_and_repeated_answers(spark):
    numbered = spark.createDataFrame([(i, i // 2, i % 2) for i in range(6)], "tweet_id long, group_id long, index int")
    rows = [[(0, 1), (1, None)], [(0, 2), (1, 1), (0, 0)], [(0, 1), (None, 1), (1, 2), (1, None)]]
    payloads = [(g, json.dumps([{"index": i, "label_id": v, "label_name": ""} for i, v in own])) for g, own in enumerate(rows)]
    responses = labelling.parse_responses(spark.createDataFrame(payloads, "group_id long, payload string"))
    checked = labelling.validate_groups(numbered, responses)
    assert {r["group_id"]: r["complete"] for r in checked.collect()} == {0: False, 1: True, 2: True}
    labels = {r["tweet_id"]: r["label_id"] for r in labelling.accepted_labels(numbered, responses, checked).collect()}
    assert labels == {2: 0, 3: 1, 4: 1, 5: 2}
    singles = spark.createDataFrame([(0, 2), (1, None), (2, 2)], "tweet_id long, label_id int")
    merged = labelling.merged_labels(numbered, responses, checked, singles)
    assert {r["tweet_id"]: r["label_id"] for r in merged.collect()} == labels | {0: 2}


@pytest.mark.parametrize("n, calls, margin, warning", [
    (3718, 372, 128, "ok"), (4500, 450, 50, "thin margin"), (5001, 501, -1, "over limit")])
def test_budget(spark, n, calls, margin, warning):
    r = labelling.budget(spark.range(n)).first()
    assert (r["primary_calls"], r["margin"], r["warning"]) == (calls, margin, warning)


def test_error_kinds(spark):
    messages = {
        "Invalid json output: \n For troubleshooting, visit: http://x": "content_block",
        "invalid JSON output:": "content_block",
        "Invalid json output: {half For troubleshooting": "malformed",
        "429: too many": "malformed",
        "no colon": "malformed",
    }
    df = spark.createDataFrame([(m,) for m in messages], "message string")
    got = {r["message"]: r["kind"] for r in df.withColumn("kind", labelling.error_kind("message")).collect()}
    assert got == messages


def test_attempts(spark):
    rows = [(1, False, "malformed"), (1, True, None), (2, False, "content_block"), (3, False, "malformed"),
            (4, False, "malformed"), (4, False, "malformed")]
    df = spark.createDataFrame(rows, "id int, ok boolean, kind string")
    got = labelling.attempt_accounting(df, "id", "ok")
    assert {r["id"]: r["status"] for r in got.collect()} == {1: "done", 2: "fallback", 3: "retry", 4: "fallback"}
    assert got.agg(F.sum("calls")).first()[0] == len(rows)
