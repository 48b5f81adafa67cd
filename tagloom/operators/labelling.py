"""Batches for an outside labelling service: requests out, answers in, nothing called."""

from pyspark.sql import functions as F

from tagloom.functions.votes import name_of
from tagloom.operators.ranking import with_batches
from tagloom.operators.sizing import small_side
from tagloom.schemas import DISPLAY_NAMES, LABEL_RESPONSE

GROUP_SIZE = 10
FALLBACK_LABEL = 2
DAILY_LIMIT = 500
MAX_RETRIES = 2


def number_rows(texts, key="tweet_id", size=GROUP_SIZE):
    """Place of every text: request group and index within it."""
    return with_batches(texts, key, size).withColumnsRenamed({"batch_id": "group_id", "position": "index"})


def build_requests(numbered, text="text"):
    """One row per group with its numbered text block (at most ``size`` texts each)."""
    line = F.format_string('%d: "%s"', F.col("index"), F.col(text))
    lines = F.array_sort(F.collect_list(F.struct("index", line.alias("line"))))
    return numbered.groupBy("group_id").agg(
        F.count(F.lit(1)).alias("n_texts"), F.concat_ws("\n", lines.getField("line")).alias("body")
    )


def few_shot_examples(labelled, text="text", key="tweet_id"):
    """One worked example per class: the class's first row.

    Only keys are aggregated (a text in the aggregate would force a sort of all texts).
    """
    first = small_side(labelled.groupBy("class_id").agg(F.min(key).alias(key)).select(key))
    return labelled.join(first, key, "left_semi").select(
        "class_id", F.col(text).alias("text"), name_of("class_id", DISPLAY_NAMES).alias("label_name")
    )


def build_prompts(requests, examples, instruction):
    """Instruction, worked examples and numbered texts as one prompt per request."""
    block = F.format_string(
        'Text: "%s"\nClassification: {"label_id": %d, "label_name": "%s"}', "text", "class_id", "label_name"
    )
    blocks = F.array_sort(F.collect_list(F.struct("class_id", block.alias("block"))))
    shots = examples.agg(F.concat_ws("\n\n", blocks.getField("block")).alias("shots"))
    joined = requests.crossJoin(F.broadcast(shots))  # one-row side
    return joined.select(
        "group_id",
        F.concat_ws(
            "\n\n", F.lit(instruction), F.col("shots"), F.format_string("Texts (%d):", "n_texts"), "body"
        ).alias("prompt"),
    )


def budget(texts, size=GROUP_SIZE, daily_limit=DAILY_LIMIT):
    """Calls needed when every group succeeds, and what is left for retries."""
    counted = texts.agg(F.count(F.lit(1)).alias("n_texts"))
    primary = F.ceil(F.col("n_texts") / F.lit(size)).cast("long")
    margin = F.lit(daily_limit) - F.col("primary_calls")
    return counted.withColumn("primary_calls", primary).withColumn("margin", margin).withColumn(
        "warning",
        F.when(F.col("margin") < 0, "over limit")
        .when(F.col("margin") < F.col("primary_calls") * 0.2, "thin margin")
        .otherwise("ok"),
    )


def parse_responses(df, payload="payload"):
    """JSON answers to rows (group_id, position, index, label_id); ``position`` is the place in the answer."""
    parsed = df.withColumn("_r", F.from_json(payload, LABEL_RESPONSE))
    return parsed.select("group_id", F.posexplode("_r").alias("position", "_a")).select("group_id", "position", "_a.index", "_a.label_id")


def _last_answers(responses):
    """One label per group and index: the last that holds a label. An answer without label is none."""
    given = responses.where(F.col("label_id").isNotNull() & F.col("index").isNotNull())
    return given.groupBy("group_id", "index").agg(F.max_by("label_id", "position").alias("label_id"))


def validate_groups(numbered, responses):
    """Whether each group was answered for exactly its indices 0..n-1."""
    asked = numbered.groupBy("group_id").agg(F.count(F.lit(1)).alias("n_texts"))
    # First per index, then per group: repeated answers cannot pile up in one place.
    answered = _last_answers(responses).groupBy("group_id").agg(
        F.count(F.lit(1)).alias("n_indices"),
        F.min("index").alias("lowest"),
        F.max("index").alias("highest"),
    )
    complete = (
        (F.col("n_indices") == F.col("n_texts"))
        & (F.col("lowest") == 0)
        & (F.col("highest") == F.col("n_texts") - 1)
    )
    return asked.join(answered, "group_id", "left").select(
        "group_id",
        "n_texts",
        F.coalesce("n_indices", F.lit(0)).alias("n_indices"),
        F.coalesce(complete, F.lit(False)).alias("complete"),
    )


def accepted_labels(numbered, responses, checked):
    """Labels of the rows of complete groups; of repeated answers the last counts."""
    per_index = _last_answers(responses)
    good = checked.where("complete").select("group_id")
    return (
        numbered.join(good, "group_id", "left_semi")
        .join(per_index, ["group_id", "index"])
        .select("tweet_id", "label_id")
    )


def single_requests(numbered, checked):
    """Rows of incomplete groups, to be asked one by one."""
    return numbered.join(checked.where(~F.col("complete")).select("group_id"), "group_id", "left_semi")


def merged_labels(numbered, responses, checked, single_answers, key="tweet_id"):
    """Labels of complete groups, and of the other rows the answers asked one by one.

    ``single_answers`` holds (key, label_id); rows without label and rows of complete groups
    are not taken, and of several answers for a row the largest label counts.
    """
    single = single_answers.where(F.col("label_id").isNotNull()).groupBy(key).agg(F.max("label_id").cast("int").alias("label_id"))
    asked = single_requests(numbered, checked).select(key).join(single, key)
    return accepted_labels(numbered, responses, checked).withColumn("label_id", F.col("label_id").cast("int")).unionByName(asked)


def with_fallback(texts, labels, fallback=FALLBACK_LABEL, key="tweet_id"):
    """Final label per row; rows never labelled get the fallback and a review flag."""
    joined = texts.join(labels.select(key, "label_id"), key, "left")
    return joined.withColumns(
        {
            "needs_review": F.col("label_id").isNull(),
            "label_id": F.coalesce("label_id", F.lit(fallback)),
        }
    )


def pending_groups(numbered, labels, key="tweet_id"):
    """Groups with at least one row still unlabelled: what a resumed run has to send."""
    open_rows = numbered.join(labels.select(key), key, "left_anti")
    return numbered.join(open_rows.select("group_id").distinct(), "group_id", "left_semi")


def error_kind(message):
    """``content_block`` for an empty rejected answer, ``malformed`` otherwise."""
    message = F.col(message) if isinstance(message, str) else message
    after = F.element_at(F.split(message, ":", 2), -1)
    body = F.split(after, "For troubleshooting", 2)[0]
    blocked = F.lower(message).contains("invalid json output") & (
        F.regexp_replace(body, r"[\x09-\x0d\x1c-\x20\x85\p{Z}]+", "") == ""
    )
    return F.when(blocked, "content_block").otherwise("malformed")


def attempt_accounting(attempts, key, ok, kind="kind", max_retries=MAX_RETRIES):
    """Calls made per request and what happens next with it."""
    counted = attempts.groupBy(key).agg(
        F.count(F.lit(1)).alias("calls"),
        F.count_if(F.col(ok)).alias("n_ok"),
        F.count_if(~F.col(ok) & (F.col(kind) == "content_block")).alias("n_blocked"),
    )
    status = (
        F.when(F.col("n_ok") > 0, "done")
        .when(F.col("n_blocked") > 0, "fallback")  # a blocked text would be blocked again
        .when(F.col("calls") >= max_retries, "fallback")
        .otherwise("retry")
    )
    return counted.withColumn("status", status)
