"""The reporting suite and the exploratory report, each as lazy DataFrames."""

from pyspark.sql import functions as F

from tagloom.functions.text import EXPLORATORY, exploratory_features, with_clean_text
from tagloom.functions.votes import agreement
from tagloom.operators import stats
from tagloom.operators.terms import top_tokens
from tagloom.schemas import SHORT_NAMES
from tagloom.sources.raw import loaded_view


def class_distribution(tables):
    """Rows per class name and their share of all texts, most frequent first."""
    counts = tables["tweets"].groupBy("class_id").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))  # reuses the shuffle of the counts
    share = F.round(100.0 * F.col("n") / F.col("total"), 2)
    # Counting before the join leaves three rows for it; the total is one row.
    return (
        counts.join(F.broadcast(tables["classes"]), "class_id")
        .crossJoin(F.broadcast(total))
        .select("class_name", "n", share.alias("pct"))
        .orderBy(F.desc("n"), "class_name")
    )


def length_by_class(tables):
    size = F.length("text")
    per_class = tables["tweets"].groupBy("class_id").agg(
        F.round(F.avg(size), 1).alias("avg_chars"), F.max(size).alias("max_chars")
    )
    return (
        per_class.join(F.broadcast(tables["classes"]), "class_id")
        .select("class_name", "avg_chars", "max_chars")
        .orderBy(F.desc("avg_chars"), "class_name")
    )


def votes_by_class(tables):
    voted = tables["annotations"].join(tables["tweets"].select("tweet_id", "class_id"), "tweet_id")
    means = [
        F.round(F.avg(f"{kind}_votes"), 2).alias(f"avg_{kind}_votes")
        for kind in ("hate", "offensive", "neither")
    ]
    per_class = voted.groupBy("class_id").agg(*means)
    return per_class.join(F.broadcast(tables["classes"]), "class_id").select(
        "class_name", "avg_hate_votes", "avg_offensive_votes", "avg_neither_votes"
    )


def panel_mix(tables):
    """Texts per panel size and their class mix."""
    mix = [F.count_if(F.col("class_id") == k).alias(name) for k, name in SHORT_NAMES.items()]
    return (
        tables["tweets"]
        .groupBy("annotator_count")
        .agg(F.count(F.lit(1)).alias("n_tweets"), *mix)
        .orderBy("annotator_count")
    )


def contested(tables):
    """Texts labelled offensive that at least one annotator called hate."""
    offensive = tables["tweets"].where("class_id = 1").select("tweet_id")
    with_hate = tables["annotations"].where("hate_votes > 0").select("tweet_id")
    return offensive.join(with_hate, "tweet_id").agg(F.count(F.lit(1)).alias("contested_offensive"))


def strongest_consensus(tables, k=10):
    hate = tables["tweets"].where("class_id = 0")
    joined = hate.join(tables["annotations"].select("tweet_id", "hate_votes"), "tweet_id")
    return (
        joined.select(
            "tweet_id", "hate_votes", "annotator_count", F.substring("text", 1, 60).alias("snippet")
        )
        .orderBy(F.desc("hate_votes"), F.desc("annotator_count"), "tweet_id")
        .limit(k)
    )


REPORTS = {
    "Q1": ("class distribution", class_distribution),
    "Q2": ("text length by class", length_by_class),
    "Q3": ("average votes by class", votes_by_class),
    "Q4": ("class mix by panel size", panel_mix),
    "Q5": ("contested offensive texts", contested),
    "Q6": ("strongest hate consensus", strongest_consensus),
}


def run_reports(tables, path=None):
    """All reports in order; with ``path`` each result is stored below its number."""
    results = {key: build(tables) for key, (_, build) in REPORTS.items()}
    if path:
        for key, df in results.items():
            df.write.mode("overwrite").parquet(f"{path}/{key}")
    return results


def exploratory_frame(tables):
    """Loaded texts with the columns the exploratory report looks at."""
    cleaned = with_clean_text(loaded_view(tables), drop_empty=False)
    features = exploratory_features("text", "clean_word_count")
    return stats.class_labels(cleaned).withColumns(
        {**{k: v for k, v in features.items()}, "agreement": agreement()}
    )


def exploratory_report(tables, only=None):
    """The tables behind the exploratory figures by name (all, or just the ``only`` ones)."""
    frame = exploratory_frame(tables)
    builders = {
        "class_share": lambda: stats.value_counts(frame, "label", digits=2),
        "word_count_mean": lambda: stats.mean_by_class(frame, "word_count", "mean_word_count", "label"),
        "word_count_box": lambda: stats.box_stats(frame, "word_count", "label"),
        "char_count": lambda: stats.describe(frame, "char_count"),
        "char_count_bins": lambda: stats.histogram(frame, "char_count", 40),
        "agreement_bins": lambda: stats.histogram(frame, "agreement", 20, "label"),
        "agreement_mean": lambda: stats.agreement_by_class(frame, "label"),
        "unanimous": lambda: stats.unanimous_share(frame),
        "top_words": lambda: top_tokens(frame),
        "correlation": lambda: stats.correlation(frame, EXPLORATORY),
    }
    return {name: builders[name]() for name in (only or builders)}


PRINTED = ("class_share", "word_count_mean", "agreement_mean", "char_count", "unanimous")


def exploratory_stats(report):
    """The printed numbers of the report as one long table."""
    return stats.stats_table(
        ("class_rows", report["class_share"], "label", "n"),
        ("class_share_pct", report["class_share"], "label", "share_pct"),
        ("mean_word_count", report["word_count_mean"], "label", "mean_word_count"),
        ("mean_agreement", report["agreement_mean"], "label", "mean_agreement"),
        ("char_count_mean", report["char_count"], None, "mean"),
        ("char_count_std", report["char_count"], None, "std"),
        ("char_count_median", report["char_count"], None, "q50"),
        ("char_count_max", report["char_count"], None, "maximum"),
        ("unanimous_pct", report["unanimous"], None, "unanimous_pct"),
    )
