"""Registered queries: splits, augmentation, vocabularies, TF-IDF, metrics, predictions."""

from pyspark.sql import functions as F

from tagloom.functions.arrays import truncate_tokens
from tagloom.functions.text import clean_tokens
from tagloom.operators import augment, evaluate, predictions, quality, runs, splits, terms
from tagloom.plans.catalog import query
from tagloom.plans.catalog_text import clean_items, split_items, staged_clean, staged_items
from tagloom.plans.oracle_parts import CLEAN, LOADED, SCORED, SPLIT, clean_sql, terms_cte
from tagloom.session import scratch_table_path
from tagloom.sources import driver_tables as src
from tagloom.sources import tables as store

# --- splits, folds, samples, weights ------------------------------------------------------


@query("stratified_split", "tweet_id b, class_id b, split s", "SELECT * FROM split", [SPLIT])
def stratified_split(spark, root):
    return split_items(spark, root)


@query(
    "split_counts",
    "split s, n b, class_0 b, class_1 b, class_2 b",
    """SELECT split, count(*) AS n, count(*) FILTER (class_id = 0) AS class_0,
         count(*) FILTER (class_id = 1) AS class_1, count(*) FILTER (class_id = 2) AS class_2
       FROM split GROUP BY split""",
    [SPLIT],
)
def split_counts(spark, root):
    return store.split_class_counts(split_items(spark, root))


@query("split_store", "tweet_id b, class_id b, clean_word_count b",
       "SELECT * FROM split WHERE split = 'validation'", [SPLIT])
def split_store(spark, root):
    """Written by split, read back for one split: only that folder is scanned."""
    path = scratch_table_path(spark, "splits")
    store.save_splits(split_items(spark, root), path)
    return store.load_split(spark, path, "validation")


@query(
    "split_disjoint",
    "first_split s, second_split s, n_shared b",
    """SELECT * FROM (VALUES ('train', 'validation', 0), ('train', 'test', 0), ('validation', 'test', 0))
       AS v(first_split, second_split, n_shared)""",
)
def split_disjoint(spark, root):
    parts = staged_items(spark, root).select("tweet_id", "split")
    out = None
    for a, b in (("train", "validation"), ("train", "test"), ("validation", "test")):
        shared = quality.leaked_keys(parts.where(F.col("split") == a), parts.where(F.col("split") == b))
        row = store.row_count(shared).select(
            F.lit(a).alias("first_split"), F.lit(b).alias("second_split"), F.col("n").alias("n_shared")
        )
        out = row if out is None else out.union(row)
    return out


@query("split_overlap", "tweet_id b, first_split s, last_split s", """
    SELECT tweet_id, min(split) AS first_split, max(split) AS last_split
    FROM split GROUP BY tweet_id HAVING min(split) <> max(split)""", [SPLIT])
def split_overlap(spark, root):
    return quality.split_overlap(split_items(spark, root))


@query(
    "cv_folds",
    "tweet_id b, class_id b, fold b",
    """SELECT tweet_id, class_id,
         CASE WHEN rn <= floor(n * 1 / 3.0) THEN 0 WHEN rn <= floor(n * 2 / 3.0) THEN 1 ELSE 2 END AS fold
       FROM (SELECT tweet_id, class_id, count(*) OVER (PARTITION BY class_id) AS n,
               row_number() OVER (PARTITION BY class_id ORDER BY md5(concat(tweet_id, '|42')), tweet_id) AS rn
             FROM clean)""",
    [CLEAN],
)
def cv_folds(spark, root):
    return splits.stratified_folds(staged_clean(spark, root))


@query(
    "class_weights",
    "class_id b, n_class b, weight d",
    """SELECT class_id, count(*) AS n_class,
         CAST((SELECT count(*) FROM train) AS DOUBLE)
           / ((SELECT count(DISTINCT class_id) FROM train) * count(*)) AS weight
       FROM train GROUP BY class_id""",
    [SPLIT],
)
def class_weights(spark, root):
    return splits.class_weights(split_items(spark, root).where("split = 'train'"))


@query("distinct_classes", "class_id b", "SELECT DISTINCT class_id FROM loaded", [LOADED])
def distinct_classes(spark, root):
    return src.tables(spark, root)["tweets"].select("class_id").distinct()


@query(
    "sample_fraction",
    "doc_id b",
    """SELECT doc_id FROM (
         SELECT doc_id, row_number() OVER (ORDER BY md5(concat(doc_id, '|42')), doc_id) AS rn,
           count(*) OVER () AS n FROM documents)
       WHERE rn <= round_even(n * 0.25::DOUBLE, 0)""",
)
def sample_fraction(spark, root):
    return splits.exact_sample(src.table(spark, root, "documents"), 0.25, "doc_id")


# --- augmentation -------------------------------------------------------------------------

_FRAMES = ", ".join("'" + t.replace("'", "''") + "'" for t in augment.QUOTE_TEMPLATES)
_TEMPLATE = "CAST(concat('0x', substr(md5(concat(tweet_id, '|42')), 1, 8)) AS BIGINT) % 25 + 1"
RARE = f"""rare AS (
  SELECT *, (rn - 1) // 20 AS batch_id, (rn - 1) % 20 + 1 AS number, {_TEMPLATE} AS template_id
  FROM (SELECT *, row_number() OVER (ORDER BY tweet_id) AS rn FROM train WHERE class_id = 0))"""
VARIANTS = f"""variants AS (
  SELECT tweet_id AS source_id, 0 AS ordinal, 'original' AS kind, clean_text AS text, 0 AS class_id FROM rare
  UNION ALL SELECT tweet_id, 1, 'counterfactual', replace(clean_text, 'the', 'das'), 0 FROM rare
  UNION ALL SELECT tweet_id, 2, 'counterfactual', replace(clean_text, 'the', 'le'), 0 FROM rare
  UNION ALL SELECT tweet_id, 3, 'counterfactual', replace(clean_text, 'the', 'el'), 0 FROM rare
  UNION ALL SELECT tweet_id, 4, 'misspelling', replace(clean_text, 'e', '3'), 0 FROM rare
  UNION ALL SELECT tweet_id, 5, 'paraphrase', concat('so ', clean_text), 0 FROM rare
  UNION ALL SELECT tweet_id, 6, 'quote', replace([{_FRAMES}][template_id], '{{text}}', clean_text), 2 FROM rare),
augmented AS (
  SELECT *, (SELECT max(tweet_id) FROM train) + row_number() OVER (ORDER BY source_id, ordinal) AS tweet_id
  FROM variants)"""


def rare_rows(spark, root):
    train = staged_items(spark, root).where("split = 'train'").drop("split")
    batched = augment.rare_class_batches(train)
    return train, augment.quote(augment.assign_template(batched))


def augmented_rows(spark, root):
    """Answers in the shape a variant service returns, then flattened to full rows."""
    train, quoted = rare_rows(spark, root)
    swapped = F.array(*(F.replace("clean_text", F.lit("the"), F.lit(w)) for w in ("das", "le", "el")))
    answers = quoted.select(
        "tweet_id",
        F.to_json(
            F.struct(
                F.col("clean_text").alias("original_text"),
                swapped.alias("counterfactuals"),
                F.replace("clean_text", F.lit("e"), F.lit("3")).alias("misspelling"),
                F.concat(F.lit("so "), "clean_text").alias("paraphrase"),
                "quote_context",
            )
        ).alias("payload"),
    )
    flat = augment.flatten_variants(augment.parse_responses(answers))
    return train, augment.with_new_ids(augment.synthetic_rows(flat), train)


@query(
    "augment_batches",
    "tweet_id b, batch_id b, number b, template_id b, quote_context s",
    f"SELECT *, replace([{_FRAMES}][template_id], '{{text}}', clean_text) AS quote_context FROM rare",
    [SPLIT, RARE],
)
def augment_batches(spark, root):
    return rare_rows(spark, root)[1]


@query(
    "augment_quotes",
    "tweet_id b, source_id b, ordinal b, kind s, text s, class_id b, class_name s, annotator_count b, "
    "hate_votes b, offensive_votes b, neither_votes b",
    """SELECT *, CASE class_id WHEN 0 THEN 'hate_speech' ELSE 'neither' END AS class_name,
         3 AS annotator_count, CASE class_id WHEN 0 THEN 3 ELSE 0 END AS hate_votes,
         0 AS offensive_votes, CASE class_id WHEN 2 THEN 3 ELSE 0 END AS neither_votes
       FROM augmented""",
    [SPLIT, RARE, VARIANTS],
)
def augment_quotes(spark, root):
    return augmented_rows(spark, root)[1]


@query(
    "train_union",
    "tweet_id b, class_id b, class_name s, clean_text s, clean_word_count b",
    f"""SELECT tweet_id, class_id, class_name, clean_text, clean_word_count FROM train
        UNION ALL
        SELECT tweet_id, class_id, CASE class_id WHEN 0 THEN 'hate_speech' ELSE 'neither' END,
          c, len(string_split(c, ' '))
        FROM (SELECT *, {clean_sql('text')} AS c FROM augmented) WHERE c <> ''""",
    [SPLIT, RARE, VARIANTS],
)
def train_union(spark, root):
    train, rows = augmented_rows(spark, root)
    return augment.merge_into_train(train, rows)


@query(
    "align_columns",
    "doc_id b, text s, title s",
    "SELECT doc_id, text, NULL AS title FROM documents",
)
def align_columns(spark, root):
    documents = src.table(spark, root, "documents")
    return augment.align_columns(documents, ["doc_id", "text", "title"])


# --- vocabularies -------------------------------------------------------------------------

VOCAB = """tokens AS (SELECT tweet_id, unnest(string_split(clean_text, ' ')) AS token FROM train),
vocabulary AS (
  SELECT token, freq, row_number() OVER (ORDER BY freq DESC, token) + 1 AS token_id
  FROM (SELECT token, count(*) AS freq FROM tokens GROUP BY token ORDER BY freq DESC, token LIMIT 20000))"""


def _train(spark, root):
    return split_items(spark, root).where("split = 'train'")


@query("vocab", "token s, token_id b, freq b", "SELECT * FROM vocabulary", [SPLIT, VOCAB])
def vocab(spark, root):
    return terms.build_vocabulary(_train(spark, root))


@query(
    "max_token_length",
    "max_len b",
    "SELECT max(len(string_split(clean_text, ' '))) AS max_len FROM train",
    [SPLIT],
)
def max_token_length(spark, root):
    return terms.max_token_length(_train(spark, root))


@query(
    "encode_pad",
    "tweet_id b, split s, ids s",
    """SELECT tweet_id, split, concat(string_agg(coalesce(token_id, 1), ',' ORDER BY pos),
         repeat(',0', CAST(any_value(max_len) - count(*) AS BIGINT))) AS ids
       FROM (SELECT tweet_id, split, max_len, unnest(t) AS token, generate_subscripts(t, 1) AS pos
             FROM (SELECT tweet_id, split, max_len, string_split(clean_text, ' ')[1:max_len] AS t FROM split,
                    (SELECT max(len(string_split(clean_text, ' '))) AS max_len FROM train)))
       LEFT JOIN vocabulary USING (token) GROUP BY tweet_id, split""",
    [SPLIT, VOCAB],
)
def encode_pad(spark, root):
    items = staged_items(spark, root)
    train = items.where("split = 'train'")
    max_len = terms.max_token_length(train).first()["max_len"]
    ids = terms.encode(items, terms.build_vocabulary(train), max_len)
    text = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    return items.select("tweet_id", "split").join(ids, "tweet_id").withColumn("ids", text)


@query(
    "truncate_tokens",
    "tweet_id b, tokens s",
    "SELECT tweet_id, array_to_string(string_split(clean_text, ' ')[1:128], ' ') AS tokens FROM clean",
    [CLEAN],
)
def truncated(spark, root):
    cut = F.array_join(truncate_tokens(clean_tokens("clean_text"), 128), " ")
    return clean_items(spark, root).select("tweet_id", cut.alias("tokens"))


_CLEAN_DOCS = f"""docs AS (SELECT doc_id, {clean_sql('text')} AS clean_text FROM documents)"""


@query(
    "tfidf_vocab",
    "term s, tf b, df b, term_no b",
    "SELECT * FROM vocab",
    [_CLEAN_DOCS, terms_cte("docs", "doc_id", terms.ENGLISH_STOP_WORDS)],
)
def tfidf_vocab(spark, root):
    from tagloom.functions.text import clean_text

    docs = src.documents(spark, root).select("doc_id", clean_text("text").alias("clean_text"))
    return terms.select_terms(terms.term_statistics(terms.with_terms(docs)))


@query(
    "tfidf_weights",
    "tweet_id b, term s, weight d",
    """SELECT tweet_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY tweet_id)) AS weight
       FROM (SELECT tweet_id, term, (1 + ln(count(*)))
               * (ln((1.0 + (SELECT count(*) FROM train)) / (1 + any_value(df))) + 1) AS w
             FROM grams JOIN vocab USING (term) GROUP BY tweet_id, term)""",
    [SPLIT, terms_cte("train", "tweet_id", terms.ENGLISH_STOP_WORDS)],
)
def tfidf_weights(spark, root):
    train = staged_items(spark, root).where("split = 'train'")
    return terms.TfIdf.fit(train).weights(train)


# --- metrics ------------------------------------------------------------------------------


def scored(spark, root):
    return predictions.with_argmax_class(src.scored_items(spark, root))


CELLS = """cells AS (
  SELECT t.k AS true_class_id, p.k AS pred_class_id,
    (SELECT count(*) FROM scored s WHERE s.true_class_id = t.k AND s.pred_class_id = p.k) AS n
  FROM (SELECT unnest(range(3)) AS k) t, (SELECT unnest(range(3)) AS k) p),
margins AS (
  SELECT k, (SELECT sum(n) FROM cells WHERE true_class_id = k) AS t,
    (SELECT sum(n) FROM cells WHERE pred_class_id = k) AS p,
    (SELECT sum(n) FROM cells WHERE true_class_id = k AND pred_class_id = k) AS hit,
    (SELECT sum(n) FROM cells) AS total
  FROM (SELECT unnest(range(3)) AS k)),
rates AS (
  SELECT *, CASE WHEN p = 0 THEN 0.0 ELSE CAST(hit AS DOUBLE) / p END AS prec,
    CASE WHEN t = 0 THEN 0.0 ELSE CAST(hit AS DOUBLE) / t END AS rec,
    CASE WHEN t + p = 0 THEN 0.0 ELSE CAST(2 * hit AS DOUBLE) / (t + p) END AS f1 FROM margins)"""


@query(
    "confusion",
    "true_class_id b, pred_class_id b, n b",
    "SELECT * FROM cells",
    [SCORED, CELLS],
)
def confusion(spark, root):
    return evaluate.confusion(scored(spark, root))


@query(
    "metrics",
    ", ".join(f"{m} d" for m in evaluate.METRICS),
    """SELECT sum(hit) / any_value(total) AS accuracy, avg(rec) FILTER (t > 0) AS balanced_accuracy,
         avg(f1) FILTER (t + p > 0) AS f1_macro, sum(f1 * t) / any_value(total) AS f1_weighted,
         avg(prec) FILTER (t + p > 0) AS precision_macro, avg(rec) FILTER (t + p > 0) AS recall_macro,
         (sum(hit) * any_value(total) - sum(t * p))
           / sqrt((any_value(total) * any_value(total) - sum(p * p)) * (any_value(total) * any_value(total) - sum(t * t))::DOUBLE) AS mcc,
         (sum(hit) / any_value(total)::DOUBLE - sum(t * p) / (any_value(total) * any_value(total))::DOUBLE)
           / (1 - sum(t * p) / (any_value(total) * any_value(total))::DOUBLE) AS cohen_kappa
       FROM rates""",
    [SCORED, CELLS],
)
def metrics(spark, root):
    return evaluate.metrics(evaluate.confusion_row(scored(spark, root)))


@query(
    "class_report",
    "line b, label s, precision d, recall d, f1_score d, support b",
    """SELECT k AS line, CASE k WHEN 0 THEN 'hate' WHEN 1 THEN 'offensive' ELSE 'neither' END AS label,
         prec AS precision, rec AS recall, f1 AS f1_score, t AS support FROM rates
       UNION ALL SELECT 3, 'accuracy', NULL, NULL, sum(hit) / any_value(total)::DOUBLE, any_value(total) FROM rates
       UNION ALL SELECT 4, 'macro avg', avg(prec), avg(rec), avg(f1), any_value(total) FROM rates
       UNION ALL SELECT 5, 'weighted avg', sum(prec * t) / any_value(total)::DOUBLE,
         sum(rec * t) / any_value(total)::DOUBLE, sum(f1 * t) / any_value(total)::DOUBLE, any_value(total) FROM rates""",
    [SCORED, CELLS],
)
def class_report(spark, root):
    return evaluate.classification_report(evaluate.confusion_row(scored(spark, root)))


AUC = """long_scores AS (
  SELECT 0 AS class_id, prob_hate AS score, true_class_id = 0 AS pos FROM scored
  UNION ALL SELECT 1, prob_offensive, true_class_id = 1 FROM scored
  UNION ALL SELECT 2, prob_neither, true_class_id = 2 FROM scored),
ranked AS (
  SELECT class_id, pos, rank() OVER (PARTITION BY class_id ORDER BY score)
    + (count(*) OVER (PARTITION BY class_id, score) - 1) / 2.0 AS r FROM long_scores),
aucs AS (
  SELECT class_id, (sum(r) FILTER (pos) - count(*) FILTER (pos) * (count(*) FILTER (pos) + 1) / 2.0)
    / (count(*) FILTER (pos) * count(*) FILTER (NOT pos)) AS auc
  FROM ranked GROUP BY class_id)"""


@query("auc_ovr", "class_id b, auc d", "SELECT * FROM aucs", [SCORED, AUC])
def auc_ovr(spark, root):
    return evaluate.auc_ovr(scored(spark, root))


@query("auc_macro", "auc_roc_ovr d", "SELECT avg(auc) AS auc_roc_ovr FROM aucs", [SCORED, AUC])
def auc_macro(spark, root):
    return evaluate.macro_auc(scored(spark, root))


@query(
    "log_loss",
    "log_loss d",
    """SELECT avg(-ln(least(greatest(CASE true_class_id WHEN 0 THEN prob_hate WHEN 1 THEN prob_offensive
         ELSE prob_neither END, 2.220446049250313e-16), 1 - 2.220446049250313e-16))) AS log_loss FROM scored""",
    [SCORED],
)
def log_loss(spark, root):
    return evaluate.log_loss(scored(spark, root))


THRESHOLDS = """candidates AS (
  SELECT i, CAST(0.05 AS DOUBLE) + CAST(i AS DOUBLE) * CAST(0.01 AS DOUBLE) AS threshold
  FROM (SELECT unnest(range(90)) AS i)),
called AS (
  SELECT i, threshold, true_class_id, CASE WHEN prob_hate >= threshold THEN 0
    WHEN prob_offensive >= prob_neither THEN 1 ELSE 2 END AS pred FROM scored, candidates),
threshold_f1 AS (
  SELECT i, threshold, avg(CASE WHEN t + p = 0 THEN NULL ELSE 2.0 * hit / (t + p) END) AS f1_macro
  FROM (SELECT i, threshold, k, count(*) FILTER (true_class_id = k) AS t, count(*) FILTER (pred = k) AS p,
          count(*) FILTER (true_class_id = k AND pred = k) AS hit
        FROM called, (SELECT unnest(range(3)) AS k) GROUP BY i, threshold, k)
  GROUP BY i, threshold)"""


@query(
    "threshold_scores",
    "i b, threshold d, f1_macro d",
    "SELECT * FROM threshold_f1",
    [SCORED, THRESHOLDS],
)
def threshold_scores(spark, root):
    return evaluate.threshold_scores(scored(spark, root))


@query(
    "threshold_tune",
    "i b, threshold d, f1_macro d",
    "SELECT * FROM threshold_f1 ORDER BY round(f1_macro, 12) DESC, i LIMIT 1",
    [SCORED, THRESHOLDS],
)
def threshold_tune(spark, root):
    return evaluate.tune_threshold(scored(spark, root))


@query(
    "apply_threshold",
    "tweet_id b, pred_class_id b",
    """SELECT tweet_id, CASE WHEN prob_hate >= (SELECT threshold FROM threshold_f1 ORDER BY round(f1_macro, 12) DESC, i LIMIT 1) THEN 0
         WHEN prob_offensive >= prob_neither THEN 1 ELSE 2 END AS pred_class_id FROM scored""",
    [SCORED, THRESHOLDS],
)
def apply_threshold(spark, root):
    """The class-0 threshold tuned on the scored rows (threshold_tune), applied to them."""
    rows = scored(spark, root)
    tuned = evaluate.tune_threshold(rows).first()["threshold"]
    return evaluate.apply_threshold(src.scored_items(spark, root), tuned)


@query(
    "softmax_argmax",
    "tweet_id b, pred_class_id b, prob_hate d, prob_offensive d, prob_neither d",
    """SELECT tweet_id, pred_class_id, e0 / (e0 + e1 + e2) AS prob_hate, e1 / (e0 + e1 + e2) AS prob_offensive,
         e2 / (e0 + e1 + e2) AS prob_neither
       FROM (SELECT tweet_id, pred_class_id, exp((r0 - greatest(r0, r1, r2)) / 25.0) AS e0,
               exp((r1 - greatest(r0, r1, r2)) / 25.0) AS e1, exp((r2 - greatest(r0, r1, r2)) / 25.0) AS e2
             FROM scored JOIN scored_raw USING (tweet_id))""",
    [SCORED],
)
def softmax_argmax(spark, root):
    raw = [(((F.col("tweet_id") * (37 + 10 * k) + 13 * k) % 101) + 1) / F.lit(25.0) for k in range(3)]
    items = src.tables(spark, root)["tweets"].select("tweet_id", F.array(*raw).alias("scores"))
    return predictions.from_scores(items, "scores")


# --- prediction rows ----------------------------------------------------------------------

_PRED_OUT = (
    "tweet_id b, true_class_id b, pred_class_id b, pred_class s, prob_hate d, prob_offensive d, "
    "prob_neither d, model_name s"
)
_PRED_SQL = """SELECT tweet_id, true_class_id, pred_class_id,
  CASE pred_class_id WHEN 0 THEN 'hate' WHEN 1 THEN 'offensive' ELSE 'neither' END AS pred_class,
  prob_hate, prob_offensive, prob_neither, '{}' AS model_name FROM scored"""
_NO_PROBS = """SELECT tweet_id, true_class_id, true_class_id AS pred_class_id,
  CASE true_class_id WHEN 0 THEN 'hate' WHEN 1 THEN 'offensive' ELSE 'neither' END AS pred_class,
  CAST(NULL AS DOUBLE) AS prob_hate, CAST(NULL AS DOUBLE) AS prob_offensive,
  CAST(NULL AS DOUBLE) AS prob_neither, 'labels only' AS model_name FROM scored"""


@query("prediction_rows", _PRED_OUT, _PRED_SQL.format("scored"), [SCORED])
def prediction_rows(spark, root):
    return predictions.prediction_rows(scored(spark, root), "scored")


def _labels_only(spark, root):
    rows = scored(spark, root).withColumn("pred_class_id", F.col("true_class_id"))
    return predictions.prediction_rows(rows, "labels only", has_probabilities=False)


def _stored_predictions(spark, root):
    """Two models stored, one of them written again: its rows are replaced, not doubled."""
    path = scratch_table_path(spark, "predictions")
    first = predictions.prediction_rows(evaluate.apply_threshold(scored(spark, root), 0.3), "scored")
    store.upsert_predictions(first, path)
    store.upsert_predictions(_labels_only(spark, root), path)
    store.upsert_predictions(predictions.prediction_rows(scored(spark, root), "scored"), path)
    return store.read_predictions(spark, path)


@query(
    "predictions_upsert",
    _PRED_OUT,
    f"{_PRED_SQL.format('scored')} UNION ALL {_NO_PROBS}",
    [SCORED],
)
def predictions_upsert(spark, root):
    return _stored_predictions(spark, root)


@query(
    "prediction_counts",
    "model_name s, n b",
    "SELECT 'scored' AS model_name, count(*) AS n FROM scored UNION ALL SELECT 'labels only', count(*) FROM scored",
    [SCORED],
)
def prediction_counts(spark, root):
    return store.prediction_counts(_stored_predictions(spark, root))


@query(
    "predictions_join",
    "tweet_id b, text s, class_id b, pred_class s",
    f"SELECT tweet_id, text, class_id, pred_class FROM ({_PRED_SQL.format('scored')}) JOIN tweets USING (tweet_id)",
    [SCORED],
)
def predictions_join(spark, root):
    rows = predictions.prediction_rows(scored(spark, root), "scored")
    return predictions.with_texts(rows, src.tables(spark, root)["tweets"])


@query("prediction_orphans", "tweet_id b, model_name s", """
    SELECT item_id AS tweet_id, 'unseen' AS model_name FROM benchmark
    WHERE item_id NOT IN (SELECT tweet_id FROM tweets)""", [LOADED])
def prediction_orphans(spark, root):
    unseen = src.table(spark, root, "benchmark").select(
        F.col("item_id").alias("tweet_id"), F.lit("unseen").alias("model_name")
    )
    return quality.orphans(unseen, src.tables(spark, root)["tweets"], "tweet_id")


@query(
    "review_queue",
    "tweet_id b, prob_hate d",
    "SELECT tweet_id, prob_hate FROM scored ORDER BY prob_hate DESC, tweet_id LIMIT 25",
    [SCORED],
)
def review_queue(spark, root):
    return evaluate.review_queue(scored(spark, root), 25)


# --- tracked runs -------------------------------------------------------------------------


def _run_metrics(spark, root):
    """Three decision rules over the same scores, evaluated side by side."""
    rows = scored(spark, root)
    rules = rows.withColumn(
        "run",
        F.explode(F.array(F.lit("argmax"), F.lit("threshold 0.3"), F.lit("threshold 0.5"))),
    )
    other = F.when(F.col("prob_offensive") >= F.col("prob_neither"), 1).otherwise(2)
    rules = rules.withColumn(
        "pred_class_id",
        F.when(F.col("run") == "argmax", F.col("pred_class_id"))
        .when((F.col("run") == "threshold 0.3") & (F.col("prob_hate") >= 0.3), 0)
        .when((F.col("run") == "threshold 0.5") & (F.col("prob_hate") >= 0.5), 0)
        .otherwise(other),
    )
    return evaluate.metrics(evaluate.confusion_row(rules, by=["run"]), by=["run"])


RUNS = """rules AS (
  SELECT 'argmax' AS run, true_class_id, pred_class_id AS pred FROM scored
  UNION ALL SELECT 'threshold 0.3', true_class_id, CASE WHEN prob_hate >= 0.3 THEN 0
    WHEN prob_offensive >= prob_neither THEN 1 ELSE 2 END FROM scored
  UNION ALL SELECT 'threshold 0.5', true_class_id, CASE WHEN prob_hate >= 0.5 THEN 0
    WHEN prob_offensive >= prob_neither THEN 1 ELSE 2 END FROM scored),
run_scores AS (
  SELECT run, any_value(acc) AS accuracy, avg(CASE WHEN t + p = 0 THEN NULL ELSE 2.0 * hit / (t + p) END) AS f1_macro
  FROM (SELECT run, k, count(*) FILTER (true_class_id = pred) / count(*)::DOUBLE AS acc,
          count(*) FILTER (true_class_id = k) AS t, count(*) FILTER (pred = k) AS p,
          count(*) FILTER (true_class_id = k AND pred = k) AS hit
        FROM rules, (SELECT unnest(range(3)) AS k) GROUP BY run, k) GROUP BY run)"""


@query(
    "runs_long",
    "run s, kind s, name s, value d",
    """SELECT run, 'metric' AS kind, 'accuracy' AS name, accuracy AS value FROM run_scores
       UNION ALL SELECT run, 'metric', 'f1_macro', f1_macro FROM run_scores""",
    [SCORED, RUNS],
)
def runs_long(spark, root):
    return runs.metric_rows(_run_metrics(spark, root).select("run", "accuracy", "f1_macro"), "run")


@query(
    "model_comparison",
    "model s, val_accuracy d, val_f1_macro d",
    "SELECT run AS model, accuracy AS val_accuracy, f1_macro AS val_f1_macro FROM run_scores",
    [SCORED, RUNS],
)
def model_comparison(spark, root):
    long_form = runs.metric_rows(_run_metrics(spark, root), "run")
    return runs.comparison(long_form, evaluate.METRICS)


@query(
    "runs_best",
    "model s, val_f1_macro d",
    """SELECT run AS model, f1_macro AS val_f1_macro FROM run_scores ORDER BY round(f1_macro, 12) DESC, run LIMIT 1""",
    [SCORED, RUNS],
)
def runs_best(spark, root):
    return runs.best_run(model_comparison(spark, root), "val_f1_macro")
