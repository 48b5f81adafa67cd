"""Session defaults and the shared folder used for written intermediate tables."""

import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def get_session(app="tagloom", master=None, **conf):
    """Build (or reuse) a session; anything in ``conf`` overrides the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark):
    """Folder all executors can reach: ``spark.checkpoint.dir``, or else one below the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    below = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages"
    spark.conf.set("spark.checkpoint.dir", below)
    return below


def scratch_table_path(spark, name):
    """A fresh path below the shared folder; never reused between calls."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
