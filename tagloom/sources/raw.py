"""CSV source and its split into the three relational tables."""

from pyspark.sql import functions as F

from tagloom.schemas import RAW_CSV, classes_table


def read_raw_csv(spark, path):
    """Annotated-text CSV with a declared schema (no inference pass over the data)."""
    return (
        spark.read.schema(RAW_CSV)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )


def normalise(raw):
    """Split flat rows into ``classes``, ``tweets`` and ``annotations``."""
    tweets = raw.select(
        "tweet_id",
        F.col("tweet").cast("string").alias("text"),
        F.col("count").cast("int").alias("annotator_count"),
        F.col("class").cast("int").alias("class_id"),
    )
    annotations = raw.select(
        "tweet_id",
        F.col("hate_speech").cast("int").alias("hate_votes"),
        F.col("offensive_language").cast("int").alias("offensive_votes"),
        F.col("neither").cast("int").alias("neither_votes"),
    )
    classes = classes_table(raw.sparkSession).select("class_id", "class_name")
    return {"classes": classes, "tweets": tweets, "annotations": annotations}


def register_views(tables):
    """Expose tables to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def loaded_view(tables):
    """Texts with class name and votes: the view every later stage starts from."""
    classes = F.broadcast(tables["classes"])
    return (
        tables["tweets"]
        .join(classes, "class_id")
        .join(tables["annotations"], "tweet_id")
        .select(
            "tweet_id",
            "text",
            "annotator_count",
            "class_id",
            "class_name",
            "hate_votes",
            "offensive_votes",
            "neither_votes",
        )
    )
