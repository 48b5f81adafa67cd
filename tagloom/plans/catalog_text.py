"""Registered queries: text cleaning, structural features and their correlation."""

from pyspark.sql import functions as F

from tagloom.functions.text import (
    STRUCTURAL,
    clean_text,
    structural_features,
    with_clean_text,
    with_structural_features,
)
from tagloom.operators import stats
from tagloom.operators.scaling import Scaler
from tagloom.operators.splits import stratified_split
from tagloom.plans.catalog import query
from tagloom.plans.catalog_reports import pearson_sql
from tagloom.plans.oracle_parts import (
    SPLIT,
    clean_sql,
    runs_cte,
    structural_cte,
    structural_sql,
)
from tagloom.session import scratch_table_path
from tagloom.sources import driver_tables as src
from tagloom.sources.raw import loaded_view
from tagloom.sources.tables import save_stage


def clean_items(spark, root):
    return with_clean_text(loaded_view(src.tables(spark, root)))


def split_items(spark, root):
    return staged_items(spark, root)


def staged_clean(spark, root):
    """Cleaned texts, written once; what follows reads just the columns it needs."""
    return save_stage(clean_items(spark, root), scratch_table_path(spark, "clean"))


def staged_items(spark, root):
    """Split texts; the split is settled on the written clean texts."""
    return stratified_split(staged_clean(spark, root))


@query(
    "clean_text",
    "doc_id b, clean_text s, clean_word_count b",
    f"""SELECT doc_id, clean_text, len(string_split(clean_text, ' ')) AS clean_word_count
        FROM (SELECT doc_id, {clean_sql('text')} AS clean_text FROM documents) WHERE clean_text <> ''""",
)
def clean_documents(spark, root):
    return with_clean_text(src.documents(spark, root))


_UNESCAPED = (
    r"regexp_replace(replace(replace(replace(html, '&middot;', '·'), '&copy;', '©'), '&quot;', '\"'),"
    r" '&amp;?', '&', 'g')"
).replace('\\"', '"')


@query(
    "clean_pages",
    "page_id b, clean_text s",
    f"SELECT page_id, {clean_sql(_UNESCAPED)} AS clean_text FROM pages",
)
def clean_pages(spark, root):
    pages = src.pages(spark, root)
    return pages.select("page_id", clean_text("html").alias("clean_text"))


@query(
    "clean_conversations",
    "tweet_id s, clean_text s",
    f"""SELECT concat(conv_id, '/', turn) AS tweet_id, {clean_sql('text')} AS clean_text
        FROM conversations WHERE {clean_sql('text')} <> ''""",
)
def clean_conversations(spark, root):
    return with_clean_text(src.conversation_turns(spark, root))


@query("dropped_empty", "n_kept b, n_dropped b", f"""
    SELECT count(*) FILTER (c <> '') AS n_kept, count(*) FILTER (c = '') AS n_dropped
    FROM (SELECT {clean_sql('text')} AS c FROM documents)""")
def dropped_empty(spark, root):
    cleaned = src.documents(spark, root).select(clean_text("text").alias("clean"))
    return cleaned.agg(
        F.count_if(F.col("clean") != "").alias("n_kept"),
        F.count_if(F.col("clean") == "").alias("n_dropped"),
    )


_EXACT = [c for c in STRUCTURAL if c != "elongated_count"]
_KINDS = {"avg_word_len": "d", "unique_word_ratio": "d", "uppercase_ratio": "d"}


@query(
    "structural_features",
    "doc_id b, " + ", ".join(f"{c} {_KINDS.get(c, 'b')}" for c in _EXACT),
    "SELECT doc_id, "
    + ", ".join(f"{expr} AS {c}" for c, expr in structural_sql("text").items())
    + " FROM documents",
)
def document_features(spark, root):
    return with_structural_features(src.documents(spark, root))


@query(
    "elongated_runs",
    "doc_id b, elongated_count b",
    "SELECT doc_id, coalesce(elongated_count, 0) AS elongated_count FROM documents LEFT JOIN runs USING (doc_id)",
    [runs_cte("documents", "doc_id", "text")],
)
def elongated_runs(spark, root):
    documents = src.documents(spark, root)
    return documents.select("doc_id", structural_features("text")["elongated_count"])


@query(
    "page_features",
    "page_id b, " + ", ".join(f"{c} {_KINDS.get(c, 'b')}" for c in _EXACT),
    "SELECT page_id, "
    + ", ".join(f"{expr} AS {c}" for c, expr in structural_sql("html").items())
    + " FROM pages",
)
def page_features(spark, root):
    pages = src.pages(spark, root).select("page_id", "html")
    return with_structural_features(pages, "html")


_DOC_STRUCTURAL = structural_cte("documents", "doc_id")


def _document_features(spark, root):
    return with_structural_features(src.documents(spark, root))


@query(
    "corr_structural",
    "i b, j b, feature_a s, feature_b s, r d",
    pearson_sql("structural", STRUCTURAL, absolute=True),
    [_DOC_STRUCTURAL],
)
def corr_structural(spark, root):
    return stats.correlation(_document_features(spark, root), STRUCTURAL, absolute=True)


@query(
    "corr_matrix",
    "i b, feature_a s, " + ", ".join(f"{c} d" for c in STRUCTURAL),
    "SELECT i, feature_a, "
    + ", ".join(f"max(r) FILTER (feature_b = '{c}') AS {c}" for c in STRUCTURAL)
    + " FROM ("
    + pearson_sql("structural", STRUCTURAL, absolute=True)
    + ") GROUP BY i, feature_a",
    [_DOC_STRUCTURAL],
)
def corr_matrix(spark, root):
    return stats.correlation_matrix(corr_structural(spark, root), STRUCTURAL)


@query(
    "drop_correlated",
    "position b, feature s, n_partners b",
    "SELECT j AS position, feature_b AS feature, count(*) AS n_partners FROM ("
    + pearson_sql("structural", STRUCTURAL, absolute=True)
    + ") WHERE i < j AND r > 0.95 GROUP BY j, feature_b",
    [_DOC_STRUCTURAL],
)
def correlated(spark, root):
    return stats.correlated_columns(corr_structural(spark, root))


@query(
    "scale_structural",
    "tweet_id b, split s, " + ", ".join(f"{c}_scaled d" for c in STRUCTURAL),
    "SELECT tweet_id, split, "
    + ", ".join(
        f"CASE WHEN s_{c} > 0 THEN ({c} - m_{c}) / s_{c} ELSE 0.0 END AS {c}_scaled" for c in STRUCTURAL
    )
    + " FROM structural JOIN split USING (tweet_id) CROSS JOIN (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in STRUCTURAL)
    + " FROM structural JOIN train USING (tweet_id))",
    [SPLIT, structural_cte("split", "tweet_id")],
)
def scale_structural(spark, root):
    # Fitted on the training rows only, applied to all three splits.
    features = with_structural_features(split_items(spark, root)).select(
        "tweet_id", "split", *STRUCTURAL
    )
    features = save_stage(features, scratch_table_path(spark, "structural"))
    return Scaler.fit(features.where("split = 'train'"), STRUCTURAL).transform(features)
