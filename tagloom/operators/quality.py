"""Integrity checks. Each returns the violating rows (or keys); empty means clean."""

from functools import reduce

from pyspark.sql import functions as F

from tagloom.functions.votes import majority_class
from tagloom.schemas import CLASS_NAMES, SPLITS, VOTE_COLUMNS


def duplicate_keys(df, keys):
    """Key values held by more than one row (also serves UNIQUE constraints)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def null_counts(df, columns):
    """Number of NULLs per declared NOT NULL column, in one pass."""
    counted = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return counted.select(
        F.inline(
            F.array(
                *(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_null")) for c in columns)
            )
        )
    )


def orphans(child, parent, child_key, parent_key=None):
    """Child rows whose key has no parent row."""
    parent_key = parent_key or child_key
    return child.join(parent.select(F.col(parent_key).alias(child_key)), child_key, "left_anti")


def vote_violations(loaded, votes=VOTE_COLUMNS):
    """Rows whose votes do not sum to the panel size or whose class is not the most voted.

    A NULL vote, panel size or class is a violation of the check it enters (never a silent pass),
    so such rows are reported with that flag false.
    """
    total = reduce(lambda a, b: a + b, (F.col(v) for v in votes))
    any_null = reduce(lambda a, b: a | b, (F.col(v).isNull() for v in votes))
    return loaded.withColumns(
        {
            "sum_ok": F.coalesce(total == F.col("annotator_count"), F.lit(False)),
            "class_ok": ~any_null & F.coalesce(majority_class(votes) == F.col("class_id"), F.lit(False)),
        }
    ).where(~F.col("sum_ok") | ~F.col("class_ok"))


def duplicate_texts(df, text="text", key="tweet_id"):
    """Texts occurring more than once; grouped by digest so long texts are not shuffled."""
    digest = F.sha2(F.col(text), 256).alias("text_digest")
    return (
        df.groupBy(digest)
        .agg(F.count(F.lit(1)).alias("n_rows"), F.min(key).alias("first_id"))
        .where("n_rows > 1")
    )


def split_overlap(df, key="tweet_id"):
    """Keys found in more than one split, with the first and last split by name.

    Positions are aggregated instead of names: numbers keep it a hash aggregation.
    """
    names = F.array(*(F.lit(s) for s in sorted(SPLITS)))
    position = F.array_position(names, F.col("split"))
    return (
        df.groupBy(key)
        .agg(F.min(position).alias("first"), F.max(position).alias("last"))
        .where("first <> last")
        .select(
            key,
            F.element_at(names, F.col("first").cast("int")).alias("first_split"),
            F.element_at(names, F.col("last").cast("int")).alias("last_split"),
        )
    )


def leaked_keys(left, right, key="tweet_id"):
    """Keys present in both tables."""
    return left.select(key).intersect(right.select(key))


def assert_no_leakage(feature_names, forbidden=(*VOTE_COLUMNS, "annotator_count", "class_id")):
    """Votes decide the label, so no feature may be one of them."""
    leaked = sorted(set(feature_names) & set(forbidden))
    if leaked:
        raise ValueError(f"label information among the features: {leaked}")
    return True


def unknown_classes(df, class_id="class_id"):
    return df.where(~F.col(class_id).isin(*CLASS_NAMES))
