"""Stored tables: stage outputs, splits, predictions, reports and resumable results."""

import json

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tagloom.schemas import ANNOTATIONS, CLASS_IDS, CLASSES, PREDICTIONS, TWEETS

DECLARED = {"classes": CLASSES, "tweets": TWEETS, "annotations": ANNOTATIONS}


def path_exists(spark, path):
    """Whether a path exists on whatever file system its scheme names."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def save_stage(df, path):
    """Write a stage's table and return it re-read, so later stages start from files."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def save_tables(tables, root):
    """Drop-and-recreate the relational tables, with their declared types, below ``root``."""
    for name, df in tables.items():
        fields = DECLARED[name].fields if name in DECLARED else df.schema.fields
        typed = df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in fields))
        typed.write.mode("overwrite").parquet(f"{root}/{name}")


def load_tables(spark, root, names=("classes", "tweets", "annotations")):
    return {name: spark.read.parquet(f"{root}/{name}") for name in names}


def save_bucketed(tables, buckets, key="tweet_id", prefix=""):
    """Catalog tables bucketed on the row key: joins on it then need no shuffle."""
    for name, df in tables.items():
        if key in df.columns:
            writer = df.write.mode("overwrite").format("parquet")
            writer.bucketBy(buckets, key).sortBy(key).saveAsTable(f"{prefix}{name}")


def row_count(df):
    return df.agg(F.count(F.lit(1)).alias("n"))


# --- splits -------------------------------------------------------------------------------


def save_splits(df, path):
    """One folder per split, so reading a single split touches only its files."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def load_split(spark, path, name):
    return spark.read.parquet(path).where(F.col("split") == name).drop("split")


def split_class_counts(df, classes=CLASS_IDS):
    """Rows per split and per class, every class listed even when absent."""
    cells = [F.count_if(F.col("class_id") == c).alias(f"class_{c}") for c in classes]
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n"), *cells)


# --- predictions --------------------------------------------------------------------------


def upsert_predictions(rows, path):
    """Replace the rows of each model present in ``rows``; other models stay as they are."""
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in PREDICTIONS.fields]
    (
        rows.select(*columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("model_name")
        .parquet(path)
    )


def read_predictions(spark, path):
    return spark.read.schema(PREDICTIONS).parquet(path)


def prediction_counts(predictions):
    return predictions.groupBy("model_name").agg(F.count(F.lit(1)).alias("n"))


# --- reports ------------------------------------------------------------------------------


def save_metrics_json(metrics, report, model_name, path):
    """Metrics row and classification report of one model as nested JSON."""
    nested = report.agg(F.collect_list(F.struct(*report.columns)).alias("classification_report"))
    (
        metrics.select(F.lit(model_name).alias("model"), F.struct(*metrics.columns).alias("metrics"))
        .crossJoin(F.broadcast(nested))  # one row on either side
        .write.mode("overwrite")
        .json(path)
    )


def save_csv(df, path):
    df.write.mode("overwrite").option("header", True).csv(path)


def append_csv(df, path):
    df.write.mode("append").option("header", True).csv(path)


# --- optional and resumable sources -------------------------------------------------------


def read_if_exists(spark, path):
    """The stored table, or None: lets a caller skip work that is already done."""
    return spark.read.parquet(path) if path_exists(spark, path) else None


def pending(todo, done, key="tweet_id"):
    """Rows of ``todo`` without a finished result."""
    return todo if done is None else todo.join(done.select(key).distinct(), key, "left_anti")


def append_results(results, path, n_total):
    """Add finished rows to the part of the run that ``n_total`` names; other runs' parts stay apart."""
    marked = results.withColumns({"n_total": F.lit(n_total).cast("long"), "stored_at": F.current_timestamp()})
    marked.write.mode("append").partitionBy("n_total").parquet(path)


def replace_results(results, path, n_total):
    """Start the part of a run anew, dropping what it held, also if that was unreadable."""
    marked = results.withColumn("stored_at", F.current_timestamp())
    marked.write.mode("overwrite").parquet(f"{path}/n_total={int(n_total)}")


def load_results(spark, path, n_total, columns=("tweet_id", "label_id")):
    """Newest finished row per id of a run; a missing or malformed part gives None.

    Only the run's own part is read, so a run of another input neither blocks nor mixes in.
    """
    own = f"{path}/n_total={int(n_total)}"
    if not path_exists(spark, own):
        return None
    try:
        stored = spark.read.parquet(own)
    except (PySparkException, Py4JJavaError):  # unreadable files
        return None
    if not {*columns, "stored_at"} <= set(stored.columns):
        return None
    key, rest = columns[0], columns[1:]
    newest = stored.groupBy(key).agg(F.max_by(F.struct(*rest), "stored_at").alias("_newest"))
    return newest.select(key, *(F.col(f"_newest.{c}").alias(c) for c in rest))


# --- small documents ----------------------------------------------------------------------


def save_json_row(spark, values, path):
    """Model metadata as a one-row JSON text file."""
    payload = json.dumps(values, sort_keys=True)
    spark.createDataFrame([(payload,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def load_json_row(spark, path):
    return json.loads(spark.read.text(path, wholetext=False).first()["value"])
