"""Prediction rows and their joins."""

from pyspark.sql import functions as F

from tagloom.functions.arrays import argmax, argmax_columns, softmax
from tagloom.functions.votes import name_of
from tagloom.schemas import PREDICTIONS, PROB_COLUMNS, SHORT_NAMES


def from_scores(df, scores):
    """Softmax of an array of raw scores, spread into probability columns and a class."""
    spread = df.withColumn("_p", softmax(scores))
    columns = {name: F.col("_p")[i] for i, name in enumerate(PROB_COLUMNS)}
    return spread.withColumns({**columns, "pred_class_id": argmax("_p")}).drop("_p")


def with_argmax_class(df, probs=PROB_COLUMNS):
    return df.withColumn("pred_class_id", argmax_columns(probs))


def prediction_rows(df, model_name, has_probabilities=True):
    """The eight columns of the predictions table."""
    probs = {
        p: F.col(p).cast("double") if has_probabilities else F.lit(None).cast("double")
        for p in PROB_COLUMNS
    }
    out = df.withColumns(
        {
            **probs,
            "pred_class": name_of("pred_class_id", SHORT_NAMES),
            "model_name": F.lit(model_name),
        }
    )
    return out.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in PREDICTIONS.fields))


def with_texts(predictions, tweets):
    """Predictions beside the texts they belong to."""
    return predictions.join(tweets.select("tweet_id", "text", "class_id"), "tweet_id")
