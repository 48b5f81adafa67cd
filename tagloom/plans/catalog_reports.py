"""Registered queries: relational reports, integrity checks and distributions."""

from pyspark.sql import functions as F

from tagloom.functions.text import EXPLORATORY
from tagloom.functions.votes import majority_class
from tagloom.operators import quality, stats
from tagloom.operators.terms import REPORT_STOP_WORDS, top_tokens
from tagloom.plans import reports
from tagloom.plans.catalog import query
from tagloom.plans.oracle_parts import CLEAN, LOADED, words_sql
from tagloom.schemas import classes_table
from tagloom.sources import driver_tables as src
from tagloom.sources import tables as store
from tagloom.sources.raw import loaded_view, register_views


def _report(builder):
    return lambda spark, root: builder(src.tables(spark, root))


query(
    "q1_class_distribution",
    "class_name s, n b, pct d",
    """SELECT class_name, count(*) AS n,
         round(100.0 * count(*) / (SELECT count(*) FROM loaded), 2) AS pct
       FROM loaded GROUP BY class_name""",
    [LOADED],
)(_report(reports.class_distribution))

query(
    "q2_length_by_class",
    "class_name s, avg_chars d, max_chars b",
    """SELECT class_name, round(avg(length(text)), 1) AS avg_chars, max(length(text)) AS max_chars
       FROM loaded GROUP BY class_name""",
    [LOADED],
)(_report(reports.length_by_class))

query(
    "q3_votes_by_class",
    "class_name s, avg_hate_votes d, avg_offensive_votes d, avg_neither_votes d",
    """SELECT class_name, round(avg(hate_votes), 2) AS avg_hate_votes,
         round(avg(offensive_votes), 2) AS avg_offensive_votes,
         round(avg(neither_votes), 2) AS avg_neither_votes
       FROM loaded GROUP BY class_name""",
    [LOADED],
)(_report(reports.votes_by_class))

query(
    "q4_panel_mix",
    "annotator_count b, n_tweets b, hate b, offensive b, neither b",
    """SELECT annotator_count, count(*) AS n_tweets, count(*) FILTER (class_id = 0) AS hate,
         count(*) FILTER (class_id = 1) AS offensive, count(*) FILTER (class_id = 2) AS neither
       FROM tweets GROUP BY annotator_count""",
    [LOADED],
)(_report(reports.panel_mix))

query(
    "q5_contested",
    "contested_offensive b",
    """SELECT count(*) FILTER (class_id = 1 AND hate_votes > 0) AS contested_offensive FROM loaded""",
    [LOADED],
)(_report(reports.contested))

query(
    "q6_consensus_topk",
    "tweet_id b, hate_votes b, annotator_count b, snippet s",
    """SELECT tweet_id, hate_votes, annotator_count, substr(text, 1, 60) AS snippet
       FROM loaded WHERE class_id = 0
       ORDER BY hate_votes DESC, annotator_count DESC, tweet_id LIMIT 10""",
    [LOADED],
)(_report(reports.strongest_consensus))


@query(
    "report_suite",
    "report s, n_rows b",
    """SELECT 'Q1' AS report, count(DISTINCT class_id) AS n_rows FROM loaded
       UNION ALL SELECT 'Q2', count(DISTINCT class_id) FROM loaded
       UNION ALL SELECT 'Q3', count(DISTINCT class_id) FROM loaded
       UNION ALL SELECT 'Q4', count(DISTINCT annotator_count) FROM loaded
       UNION ALL SELECT 'Q5', 1
       UNION ALL SELECT 'Q6', least(10, count(*) FILTER (class_id = 0)) FROM loaded""",
    [LOADED],
)
def report_suite(spark, root):
    results = reports.run_reports(src.tables(spark, root))
    out = None
    for key, df in results.items():
        counted = store.row_count(df).select(F.lit(key).alias("report"), F.col("n").alias("n_rows"))
        out = counted if out is None else out.union(counted)
    return out


@query(
    "load_view",
    "tweet_id b, text s, annotator_count b, class_id b, class_name s, hate_votes b, "
    "offensive_votes b, neither_votes b",
    "SELECT * FROM loaded",
    [LOADED],
)
def load_view(spark, root):
    return loaded_view(src.tables(spark, root)).orderBy("tweet_id")


@query(
    "normalised_tweets",
    "tweet_id b, text s, annotator_count b, class_id b",
    "SELECT * FROM tweets",
    [LOADED],
)
def normalised_tweets(spark, root):
    return src.tables(spark, root)["tweets"]


@query(
    "normalised_annotations",
    "tweet_id b, hate_votes b, offensive_votes b, neither_votes b",
    "SELECT * FROM annotations",
    [LOADED],
)
def normalised_annotations(spark, root):
    return src.tables(spark, root)["annotations"]


@query("sql_source", "class_name s, n_contested b", """
    SELECT class_name, count(*) AS n_contested FROM loaded
    WHERE greatest(hate_votes, offensive_votes, neither_votes) < annotator_count
    GROUP BY class_name""", [LOADED])
def sql_source(spark, root):
    register_views(src.tables(spark, root))
    return spark.sql(
        """SELECT class_name, count(*) AS n_contested
           FROM annotations JOIN tweets USING (tweet_id) JOIN classes USING (class_id)
           WHERE greatest(hate_votes, offensive_votes, neither_votes) < annotator_count
           GROUP BY class_name"""
    )


@query("row_count", "n b", "SELECT count(*) AS n FROM tweets", [LOADED])
def row_count(spark, root):
    return store.row_count(src.tables(spark, root)["tweets"])


@query(
    "panel_votes_argmax",
    "tweet_id b, hate_votes b, offensive_votes b, neither_votes b, annotator_count b, class_id b",
    """SELECT *, CASE WHEN hate_votes >= offensive_votes AND hate_votes >= neither_votes THEN 0
              WHEN offensive_votes >= neither_votes THEN 1 ELSE 2 END AS class_id
       FROM (SELECT user_id AS tweet_id, count(*) FILTER (event_type = 'error') AS hate_votes,
               count(*) FILTER (event_type = 'click') AS offensive_votes,
               count(*) FILTER (event_type NOT IN ('error', 'click')) AS neither_votes,
               count(*) AS annotator_count
             FROM events GROUP BY user_id)""",
)
def panel_votes_argmax(spark, root):
    return src.panel_votes(spark, root).withColumn("class_id", majority_class())


# --- integrity ----------------------------------------------------------------------------


@query(
    "pk_duplicates",
    "table_name s, key_value s, n_rows b",
    """SELECT 'labels' AS table_name, CAST(doc_id AS VARCHAR) AS key_value, count(*) AS n_rows
         FROM labels GROUP BY doc_id HAVING count(*) > 1
       UNION ALL
       SELECT 'conversations', concat(conv_id, '/', turn), count(*)
         FROM conversations GROUP BY conv_id, turn HAVING count(*) > 1
       UNION ALL
       SELECT 'role', role, count(*) FROM conversations GROUP BY role HAVING count(*) > 1""",
)
def pk_duplicates(spark, root):
    labels, chats = src.table(spark, root, "labels"), src.table(spark, root, "conversations")
    text = F.concat(F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string"))
    parts = (
        ("labels", quality.duplicate_keys(labels, ["doc_id"]), F.col("doc_id").cast("string")),
        ("conversations", quality.duplicate_keys(chats, ["conv_id", "turn"]), text),
        ("role", quality.duplicate_keys(chats, ["role"]), F.col("role")),
    )
    out = None
    for name, found, key in parts:
        rows = found.select(F.lit(name).alias("table_name"), key.alias("key_value"), "n_rows")
        out = rows if out is None else out.union(rows)
    return out


@query(
    "fk_orphans",
    "doc_id b",
    "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def fk_orphans(spark, root):
    documents = src.table(spark, root, "documents")
    return quality.orphans(documents, src.table(spark, root, "labels"), "doc_id").select("doc_id")


@query(
    "not_null",
    "column_name s, n_null b",
    """SELECT 'tweet_id' AS column_name, count(*) FILTER (tweet_id IS NULL) AS n_null FROM loaded
       UNION ALL SELECT 'text', count(*) FILTER (text IS NULL) FROM loaded
       UNION ALL SELECT 'annotator_count', count(*) FILTER (annotator_count IS NULL) FROM loaded
       UNION ALL SELECT 'class_id', count(*) FILTER (class_id IS NULL) FROM loaded""",
    [LOADED],
)
def not_null(spark, root):
    tweets = src.tables(spark, root)["tweets"]
    return quality.null_counts(tweets, ["tweet_id", "text", "annotator_count", "class_id"])


@query("unique_class_name", "class_name s, n_rows b", """
    SELECT class_name, count(*) AS n_rows FROM classes GROUP BY class_name HAVING count(*) > 1
    UNION ALL SELECT role, count(*) FROM conversations GROUP BY role HAVING count(*) > 1""", [LOADED])
def unique_class_name(spark, root):
    chats = src.table(spark, root, "conversations")
    found = quality.duplicate_keys(chats, [F.col("role").alias("class_name")])
    return quality.duplicate_keys(classes_table(spark), ["class_name"]).unionByName(found)


@query(
    "vote_invariants",
    "tweet_id b, sum_ok l, class_ok l",
    """SELECT tweet_id, sum_ok, class_ok FROM (
         SELECT tweet_id, coalesce(hate_votes + offensive_votes + neither_votes = annotator_count, FALSE) AS sum_ok,
           hate_votes IS NOT NULL AND offensive_votes IS NOT NULL AND neither_votes IS NOT NULL
           AND coalesce(class_id = CASE WHEN hate_votes >= offensive_votes AND hate_votes >= neither_votes THEN 0
             WHEN offensive_votes >= neither_votes THEN 1 ELSE 2 END, FALSE) AS class_ok
         FROM (SELECT user_id AS tweet_id, count(*) AS annotator_count,
                 count(*) FILTER (event_type = 'error') AS hate_votes,
                 count(*) FILTER (event_type = 'click') AS offensive_votes,
                 count(*) FILTER (event_type NOT IN ('error', 'click')) AS neither_votes
               FROM events GROUP BY user_id)
         JOIN (SELECT tweet_id, class_id FROM tweets) USING (tweet_id))
       WHERE NOT sum_ok OR NOT class_ok""",
    [LOADED],
)
def vote_invariants(spark, root):
    # Panels voted by events, classes taken from the labels: the two need not agree.
    labelled = src.tables(spark, root)["tweets"].select("tweet_id", "class_id")
    return quality.vote_violations(src.panel_votes(spark, root).join(labelled, "tweet_id"))


@query(
    "duplicate_texts",
    "text_digest s, n_rows b, first_id b",
    """SELECT sha256(text) AS text_digest, count(*) AS n_rows, min(doc_id) AS first_id
       FROM documents GROUP BY text HAVING count(*) > 1""",
)
def duplicate_texts(spark, root):
    return quality.duplicate_texts(src.table(spark, root, "documents"), key="doc_id")


# --- distributions ------------------------------------------------------------------------


@query(
    "value_counts",
    "label s, n b, share_pct d",
    """SELECT short_name AS label, count(*) AS n,
         round(100.0 * count(*) / (SELECT count(*) FROM loaded), 2) AS share_pct
       FROM loaded GROUP BY short_name""",
    [LOADED],
)
def value_counts(spark, root):
    return stats.value_counts(stats.class_labels(src.tables(spark, root)["tweets"]), "label", 2)


@query(
    "ordered_class_counts",
    "class_id b, class_name s, n b",
    "SELECT class_id, class_name, count(tweet_id) AS n FROM classes LEFT JOIN tweets USING (class_id) GROUP BY ALL",
    [LOADED],
)
def ordered_class_counts(spark, root):
    return stats.ordered_class_counts(src.tables(spark, root)["tweets"], classes_table(spark))


_WORDS = "SELECT short_name AS label, clean_word_count AS v FROM clean"


@query(
    "clean_word_count",
    "label s, mean_word_count d",
    f"SELECT label, avg(v) AS mean_word_count FROM ({_WORDS}) GROUP BY label",
    [CLEAN],
)
def clean_word_count(spark, root):
    frame = reports.exploratory_frame(src.tables(spark, root))
    return stats.mean_by_class(frame, "word_count", "mean_word_count", "label")


@query(
    "describe_chars",
    "n b, mean d, std d, minimum d, q25 d, q50 d, q75 d, maximum d",
    """SELECT count(*) AS n, avg(v) AS mean, stddev_samp(v) AS std, min(v) AS minimum,
         quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50, quantile_cont(v, 0.75) AS q75,
         max(v) AS maximum FROM (SELECT length(text) AS v FROM documents)""",
)
def describe_chars(spark, root):
    sized = src.table(spark, root, "documents").select(F.length("text").alias("char_count"))
    return stats.describe(sized, "char_count")


@query(
    "hist_chars",
    "bin b, low_edge d, high_edge d, n b",
    """SELECT bin, lo + (hi - lo) * bin / 40.0 AS low_edge, lo + (hi - lo) * (bin + 1) / 40.0 AS high_edge,
         coalesce(n, 0) AS n
       FROM (SELECT unnest(range(40)) AS bin)
       CROSS JOIN (SELECT min(length(text)) AS lo, max(length(text)) AS hi FROM documents)
       LEFT JOIN (
         SELECT least(((length(text) - lo) * 40) // (hi - lo), 39) AS bin, count(*) AS n
         FROM documents, (SELECT min(length(text)) AS lo, max(length(text)) AS hi FROM documents)
         GROUP BY 1) USING (bin)""",
)
def hist_chars(spark, root):
    sized = src.table(spark, root, "documents").select(F.length("text").alias("char_count"))
    return stats.histogram(sized, "char_count", 40)


_AGREE = """SELECT short_name AS label,
  CAST(greatest(hate_votes, offensive_votes, neither_votes) AS DOUBLE) / annotator_count AS a FROM loaded"""


@query(
    "hist_agreement",
    "label s, bin b, low_edge d, high_edge d, n b",
    f"""SELECT label, bin, lo + (hi - lo) * bin / 20.0 AS low_edge,
          lo + (hi - lo) * (bin + 1) / 20.0 AS high_edge, coalesce(n, 0) AS n
        FROM (SELECT unnest(range(20)) AS bin)
        CROSS JOIN (SELECT DISTINCT short_name AS label FROM loaded)
        CROSS JOIN (SELECT min(a) AS lo, max(a) AS hi FROM ({_AGREE}))
        LEFT JOIN (
          SELECT label, CAST(least(floor((a - lo) * 20 / (hi - lo)), 19) AS BIGINT) AS bin, count(*) AS n
          FROM ({_AGREE}), (SELECT min(a) AS lo, max(a) AS hi FROM ({_AGREE})) GROUP BY ALL)
        USING (label, bin)""",
    [LOADED],
)
def hist_agreement(spark, root):
    from tagloom.functions.votes import agreement

    loaded = stats.class_labels(loaded_view(src.tables(spark, root)))
    return stats.histogram(loaded.withColumn("agreement", agreement()), "agreement", 20, "label")


@query(
    "box_words",
    "label s, q1 d, median d, q3 d, whisker_low d, whisker_high d, n_outliers b",
    f"""WITH w AS ({_WORDS}),
        q AS (SELECT label, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
                quantile_cont(v, 0.75) AS q3 FROM w GROUP BY label)
        SELECT label, any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3,
          least(min(v) FILTER (v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1)), any_value(q1)) AS whisker_low,
          greatest(max(v) FILTER (v >= q1 - 1.5 * (q3 - q1) AND v <= q3 + 1.5 * (q3 - q1)), any_value(q3)) AS whisker_high,
          count(*) FILTER (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS n_outliers
        FROM w JOIN q USING (label) GROUP BY label""",
    [CLEAN],
)
def box_words(spark, root):
    frame = reports.exploratory_frame(src.tables(spark, root))
    return stats.box_stats(frame, "word_count", "label")


@query(
    "agreement_by_class",
    "label s, mean_agreement d",
    f"SELECT label, avg(a) AS mean_agreement FROM ({_AGREE}) GROUP BY label",
    [LOADED],
)
def agreement_by_class(spark, root):
    loaded = stats.class_labels(loaded_view(src.tables(spark, root)))
    return stats.agreement_by_class(loaded, "label")


@query(
    "unanimous_share",
    "unanimous_pct d",
    f"SELECT 100.0 * count(*) FILTER (a = 1) / count(*) AS unanimous_pct FROM ({_AGREE})",
    [LOADED],
)
def unanimous_share(spark, root):
    return stats.unanimous_share(loaded_view(src.tables(spark, root)))


_STOPS = ", ".join(f"'{w}'" for w in REPORT_STOP_WORDS)


@query(
    "top_tokens",
    "class_id b, token s, n b, rank b",
    f"""SELECT * FROM (
          SELECT class_id, token, count(*) AS n,
            row_number() OVER (PARTITION BY class_id ORDER BY count(*) DESC, token) AS rank
          FROM (SELECT class_id, unnest(string_split(clean_text, ' ')) AS token FROM clean)
          WHERE length(token) > 2 AND token NOT IN ({_STOPS}) GROUP BY class_id, token)
        WHERE rank <= 12""",
    [CLEAN],
)
def top_words(spark, root):
    return top_tokens(reports.exploratory_frame(src.tables(spark, root)))


_EXPLORE = """SELECT length(text) AS char_count, clean_word_count AS word_count,
  length(text) - length(replace(text, '!', '')) AS exclaim,
  length(text) - length(replace(text, '?', '')) AS question,
  length(text) - length(replace(text, '@', '')) AS mention,
  length(text) - length(replace(text, '#', '')) AS hashtag,
  length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS uppercase"""


@query(
    "eda_char_features",
    "tweet_id b, " + ", ".join(f"{c} b" for c in EXPLORATORY),
    f"{_EXPLORE}, tweet_id FROM clean",
    [CLEAN],
)
def eda_char_features(spark, root):
    return reports.exploratory_frame(src.tables(spark, root))


def pearson_sql(source, columns, absolute=False):
    """Long-form correlation over a CTE; constant columns give NULL."""
    parts = []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            r = f"(SELECT CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 THEN corr({a}, {b}) END FROM {source})"
            r = f"(SELECT CASE WHEN stddev_pop({a}) > 0 THEN 1.0 END FROM {source})" if a == b else r
            r = f"abs({r})" if absolute else r
            parts.append(f"SELECT {i} AS i, {j} AS j, '{a}' AS feature_a, '{b}' AS feature_b, {r} AS r")
    return " UNION ALL ".join(parts)


@query(
    "corr_eda",
    "i b, j b, feature_a s, feature_b s, r d",
    pearson_sql("explore", EXPLORATORY),
    [CLEAN, f"explore AS ({_EXPLORE} FROM clean)"],
)
def corr_eda(spark, root):
    return stats.correlation(reports.exploratory_frame(src.tables(spark, root)), EXPLORATORY)


@query(
    "stats_table",
    "metric s, key s, value d",
    f"""SELECT 'class_rows' AS metric, short_name AS key, count(*) AS value FROM loaded GROUP BY 2
        UNION ALL SELECT 'class_share_pct', short_name,
          round(100.0 * count(*) / (SELECT count(*) FROM loaded), 2) FROM loaded GROUP BY 2
        UNION ALL SELECT 'mean_word_count', label, avg(v) FROM ({_WORDS}) GROUP BY 2
        UNION ALL SELECT 'mean_agreement', label, avg(a) FROM ({_AGREE}) GROUP BY 2
        UNION ALL SELECT 'char_count_mean', '', avg(length(text)) FROM loaded
        UNION ALL SELECT 'char_count_std', '', stddev_samp(length(text)) FROM loaded
        UNION ALL SELECT 'char_count_median', '', quantile_cont(length(text), 0.5) FROM loaded
        UNION ALL SELECT 'char_count_max', '', max(length(text)) FROM loaded
        UNION ALL SELECT 'unanimous_pct', '', 100.0 * count(*) FILTER (a = 1) / count(*) FROM ({_AGREE})""",
    [CLEAN],
)
def stats_table(spark, root):
    report = reports.exploratory_report(src.tables(spark, root), only=reports.PRINTED)
    return reports.exploratory_stats(report)
