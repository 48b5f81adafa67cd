"""The stateless steps on a stream of texts: cleaning, features and scoring."""

from tagloom.functions.text import with_clean_text, with_structural_features
from tagloom.plans.scoring import score


def read_texts(spark, path, schema, files_per_batch=100):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def clean(stream):
    return with_clean_text(stream)


def featurise(stream):
    return with_structural_features(with_clean_text(stream))


def score_texts(stream, trained):
    """Class probabilities for arriving texts (``tweet_id``, ``text``)."""
    return score(trained, with_clean_text(stream))


def write_available(stream, path, checkpoint):
    """Process what has arrived and stop; a rerun continues after the last finished file."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
