"""Registered queries: batches for an outside labelling service."""

from pyspark.sql import functions as F

from tagloom.operators import labelling
from tagloom.operators.ranking import with_row_number
from tagloom.plans.catalog import query
from tagloom.plans.oracle_parts import LOADED
from tagloom.session import scratch_table_path
from tagloom.sources import driver_tables as src
from tagloom.sources import tables as store

# In these examples some ids get no answer, some an answer without label, and some two answers
# of which the last counts, so groups stay open and repeats occur.
UNANSWERED, UNLABELLED, REPEATED = 37, 41, 5

NUMBERED = f"""numbered AS (
  SELECT *, (rn - 1) // 10 AS group_id, (rn - 1) % 10 AS index
  FROM (SELECT tweet_id, text, class_id, row_number() OVER (ORDER BY tweet_id) AS rn FROM tweets)),
answers AS (SELECT group_id, index, class_id AS label_id FROM numbered 
  WHERE tweet_id % {UNANSWERED} <> 0 AND tweet_id % {UNLABELLED} <> 0),
checked AS (
  SELECT group_id, count(*) AS n_texts, count(a.index) AS n_indices, count(*) = count(a.index) AS complete
  FROM numbered n LEFT JOIN answers a USING (group_id, index) GROUP BY group_id),
accepted AS (
  SELECT tweet_id, class_id AS label_id FROM numbered JOIN checked USING (group_id) WHERE complete)"""


def numbered_items(spark, root):
    return labelling.number_rows(src.tables(spark, root)["tweets"].select("tweet_id", "text", "class_id"))


def answers(numbered):
    """JSON answers per group, as a service would send them back."""
    answered = numbered.where(F.col("tweet_id") % UNANSWERED != 0)
    label = F.when(F.col("tweet_id") % UNLABELLED != 0, F.col("class_id"))
    repeated = (F.col("tweet_id") % REPEATED == 0) & label.isNotNull()
    first = F.when(repeated, F.array(F.lit(2), F.lit(0))).otherwise(F.array(F.lit(0)))
    # A group holds ten rows at most, so its answer is bounded. The wrong answers come first.
    one = F.struct(F.col("wrong"), "index", F.when(F.col("wrong") > 0, F.lit(2)).otherwise(label).alias("label_id"), F.lit("").alias("label_name"))
    rows = answered.withColumn("wrong", F.explode(first))
    ordered = F.sort_array(F.collect_list(one), asc=False)
    bare = F.transform(ordered, lambda a: F.struct(a["index"].alias("index"), a["label_id"].alias("label_id"), a["label_name"].alias("label_name")))
    return rows.groupBy("group_id").agg(F.to_json(bare).alias("payload"))


def checked_groups(spark, root):
    numbered = numbered_items(spark, root)
    responses = labelling.parse_responses(answers(numbered))
    return numbered, responses, labelling.validate_groups(numbered, responses)


@query(
    "label_requests",
    "group_id b, n_texts b, body s",
    """SELECT group_id, count(*) AS n_texts,
         string_agg(concat(index, ': "', text, '"'), chr(10) ORDER BY index) AS body
       FROM (SELECT doc_id, text, (row_number() OVER (ORDER BY doc_id) - 1) // 10 AS group_id,
               (row_number() OVER (ORDER BY doc_id) - 1) % 10 AS index FROM documents)
       GROUP BY group_id""",
)
def label_requests(spark, root):
    documents = src.documents(spark, root)
    return labelling.build_requests(labelling.number_rows(documents, "doc_id"))


_INSTRUCTION = "Assign every numbered text to exactly one category and answer with its index."


@query(
    "label_prompts",
    "group_id b, prompt s",
    f"""SELECT group_id, concat('{_INSTRUCTION}', chr(10), chr(10), shots, chr(10), chr(10),
          'Texts (', n, '):', chr(10), chr(10), body) AS prompt
        FROM (SELECT group_id, count(*) AS n,
                string_agg(concat(index, ': "', text, '"'), chr(10) ORDER BY index) AS body
              FROM numbered GROUP BY group_id)
        CROSS JOIN (
          SELECT string_agg(concat('Text: "', text, '"', chr(10), 'Classification: {{"label_id": ', class_id,
            ', "label_name": "', display_name, '"}}'), chr(10) || chr(10) ORDER BY class_id) AS shots
          FROM (SELECT class_id, arg_min(text, tweet_id) AS text FROM tweets GROUP BY class_id)
          JOIN classes USING (class_id))""",
    [LOADED, NUMBERED],
)
def label_prompts(spark, root):
    requests = labelling.build_requests(numbered_items(spark, root))
    examples = labelling.few_shot_examples(src.tables(spark, root)["tweets"])
    return labelling.build_prompts(requests, examples, _INSTRUCTION)


@query(
    "label_budget",
    "n_texts b, primary_calls b, margin b, warning s",
    """SELECT n AS n_texts, c AS primary_calls, 500 - c AS margin,
         CASE WHEN 500 - c < 0 THEN 'over limit' WHEN 500 - c < c * 0.2 THEN 'thin margin' ELSE 'ok' END AS warning
       FROM (SELECT count(*) AS n, CAST(ceil(count(*) / 10.0) AS BIGINT) AS c FROM documents)""",
)
def label_budget(spark, root):
    return labelling.budget(src.table(spark, root, "documents"))


@query(
    "label_validate",
    "group_id b, n_texts b, n_indices b, complete l",
    "SELECT * FROM checked",
    [LOADED, NUMBERED],
)
def label_validate(spark, root):
    return checked_groups(spark, root)[2]


@query(
    "label_single_requests",
    "tweet_id b, group_id b, index b",
    "SELECT tweet_id, group_id, index FROM numbered JOIN checked USING (group_id) WHERE NOT complete",
    [LOADED, NUMBERED],
)
def label_single_requests(spark, root):
    numbered, _, checked = checked_groups(spark, root)
    return labelling.single_requests(numbered, checked)


@query(
    "label_fallback",
    "tweet_id b, label_id b, needs_review l",
    """SELECT tweet_id, coalesce(label_id, 2) AS label_id, label_id IS NULL AS needs_review
       FROM tweets LEFT JOIN accepted USING (tweet_id)""",
    [LOADED, NUMBERED],
)
def label_fallback(spark, root):
    numbered, responses, checked = checked_groups(spark, root)
    labels = labelling.accepted_labels(numbered, responses, checked)
    return labelling.with_fallback(src.tables(spark, root)["tweets"].select("tweet_id"), labels)


@query(
    "label_merged",
    "tweet_id b, label_id b, needs_review l",
    f"""SELECT tweet_id, CASE WHEN complete OR tweet_id % {UNANSWERED} <> 0 THEN class_id ELSE 2 END AS label_id,
         NOT (complete OR tweet_id % {UNANSWERED} <> 0) AS needs_review
       FROM numbered JOIN checked USING (group_id)""",
    [LOADED, NUMBERED],
)
def label_merged(spark, root):
    """Group answers, then the answers of single rows of open groups, then the fallback."""
    numbered, responses, checked = checked_groups(spark, root)
    singles = labelling.single_requests(numbered, checked).where(F.col("tweet_id") % UNANSWERED != 0)
    answers_one_by_one = singles.select("tweet_id", F.col("class_id").alias("label_id"))
    labels = labelling.merged_labels(numbered, responses, checked, answers_one_by_one)
    return labelling.with_fallback(numbered.select("tweet_id"), labels)


@query(
    "label_resume",
    "tweet_id b, group_id b, index b",
    "SELECT tweet_id, group_id, index FROM numbered WHERE group_id NOT IN (SELECT group_id FROM checked WHERE complete)",
    [LOADED, NUMBERED],
)
def label_resume(spark, root):
    """Finished labels are stored; a later run reads them back and sends the rest."""
    numbered, responses, checked = checked_groups(spark, root)
    path = scratch_table_path(spark, "labels")
    n_total = numbered.count()
    store.append_results(labelling.accepted_labels(numbered, responses, checked), path, n_total)
    return labelling.pending_groups(numbered, store.load_results(spark, path, n_total))


@query(
    "label_pending_rows",
    "tweet_id b",
    "SELECT doc_id AS tweet_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def label_pending_rows(spark, root):
    todo = src.table(spark, root, "documents").select(F.col("doc_id").alias("tweet_id"))
    done = src.table(spark, root, "labels").select(F.col("doc_id").alias("tweet_id"))
    return store.pending(todo, done)


# Every event read as one call: errors were rejected empty, clicks timed out, views came
# back garbled, the rest succeeded.
def _attempts(spark, root):
    kind = F.col("event_type")
    message = (
        F.when(kind == "error", "Invalid json output: For troubleshooting, see the guide")
        .when(kind == "click", "Timeout: no answer")
        .when(kind == "view", F.concat(F.lit("Invalid json output: "), "props", F.lit(" For troubleshooting")))
    )
    events = src.table(spark, root, "events")
    return events.select("event_id", "user_id", kind.alias("event_type"), message.alias("message"))


@query(
    "label_errors",
    "kind s, event_type s, n b",
    """SELECT CASE WHEN event_type = 'error' THEN 'content_block' ELSE 'malformed' END AS kind, event_type,
         count(*) AS n FROM events WHERE event_type IN ('error', 'click', 'view') GROUP BY ALL""",
)
def label_errors(spark, root):
    failed = _attempts(spark, root).where(F.col("message").isNotNull())
    kinds = failed.withColumn("kind", labelling.error_kind("message"))
    return kinds.groupBy("kind", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "label_attempts",
    "user_id b, calls b, n_ok b, n_blocked b, status s",
    """SELECT *, CASE WHEN n_ok > 0 THEN 'done' WHEN n_blocked > 0 OR calls >= 2 THEN 'fallback'
         ELSE 'retry' END AS status
       FROM (SELECT user_id, count(*) AS calls, count(*) FILTER (event_type IN ('purchase', 'signup')) AS n_ok,
               count(*) FILTER (event_type = 'error') AS n_blocked FROM events GROUP BY user_id)""",
)
def label_attempts(spark, root):
    calls = _attempts(spark, root).withColumns(
        {"ok": F.col("message").isNull(), "kind": labelling.error_kind("message")}
    )
    return labelling.attempt_accounting(calls, "user_id", "ok")


@query(
    "row_numbers",
    "o_orderkey b, rn b",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders",
)
def row_numbers(spark, root):
    return with_row_number(src.table(spark, root, "orders").select("o_orderkey"), "o_orderkey")
