"""Positions and running totals over a whole table without a single-task sort.

A global window would pull the table (or one hot class) into one task. Here rows are first
cut into key ranges of about equal size; only the per-range totals meet in one place.
"""

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Window
from pyspark.sql import functions as F

_BEFORE = (Window.unboundedPreceding, -1)
#: Range of rows without a key; it comes before all others.
NO_KEY = -1
MAX_RANGES = 20_000


def range_splits(df, key, ranges=None):
    """Strictly increasing cut points giving key ranges of about equal row counts.

    Keys are numeric. ``ranges`` is the number of ranges; by default four for each shuffle task,
    at most MAX_RANGES, beyond which a range grows with the table, so larger clusters pass it.
    """
    if ranges is None:
        # Several ranges per shuffle task even out how they fall on the tasks.
        spark = df.sparkSession
        tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        ranges = min(4 * tasks, MAX_RANGES)
    keyed = df.select(F.col(key).cast("double").alias(key))
    points = keyed.approxQuantile(key, [i / ranges for i in range(1, ranges)], 0.25 / ranges)
    inner = sorted(set(points)) or [0.0]
    return [float("-inf"), *inner, float("inf")]


def with_key_range(df, key, splits, out="_range"):
    """Number of the range a key falls into (monotone in the key); NULL keys get NO_KEY, NaN the last."""
    ranged = df.withColumn("_range_key", F.col(key).cast("double"))
    cut = Bucketizer(splits=splits, inputCol="_range_key", outputCol=out, handleInvalid="keep")
    numbered = F.when(F.col("_range_key").isNull(), NO_KEY).otherwise(F.col(out).cast("int"))
    return cut.transform(ranged).withColumn(out, numbered).drop("_range_key")


def running_totals(df, key, totals, group=(), tie=(), ranges=None):
    """Add exclusive running sums of ``totals`` (name -> expression) in key order.

    ``group`` restarts the sums per group, ``tie`` orders rows of equal key. Rows with a NULL
    key come first, and a NULL in a group column is a group of its own.
    """
    group, tie = list(group), list(tie)
    terms = {f"_term_{name}": expr for name, expr in totals.items()}
    ranged = with_key_range(df, key, range_splits(df, key, ranges)).withColumns(terms)
    per_range = ranged.groupBy(*group, "_range").agg(
        *(F.sum(f"_term_{name}").alias(f"_sum_{name}") for name in totals)
    )
    # One row per group and range: the only place where all ranges meet.
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(*_BEFORE)
    offsets = per_range.select(
        *(F.col(g).alias(f"_group_{g}") for g in group),
        F.col("_range").alias("_at"),
        *(
            F.coalesce(F.sum(f"_sum_{name}").over(earlier), F.lit(0)).alias(f"_offset_{name}")
            for name in totals
        ),
    )
    same = F.col("_range") == F.col("_at")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_group_{g}"))
    within = Window.partitionBy(*group, "_range").orderBy(key, *tie).rowsBetween(*_BEFORE)
    inside = ranged.join(offsets, same).withColumns(
        {
            name: F.col(f"_offset_{name}")
            + F.coalesce(F.sum(f"_term_{name}").over(within), F.lit(0))
            for name in totals
        }
    )
    return inside.select(*df.columns, *totals)


def with_row_number(df, key, group=(), tie=(), out="rn", ranges=None):
    """Gap-free row numbers from 1 in key order (per group when given)."""
    numbered = running_totals(df, key, {out: F.lit(1).cast("long")}, group, tie, ranges)
    return numbered.withColumn(out, F.col(out) + 1)


def with_batches(df, key, size, tie=(), ranges=None):
    """Number consecutive rows into batches of ``size`` with positions from 0."""
    numbered = with_row_number(df, key, tie=tie, out="_rn", ranges=ranges)
    position = F.col("_rn") - 1
    return numbered.withColumns(
        {
            "batch_id": F.floor(position / F.lit(size)).cast("long"),
            "position": (position % size).cast("int"),
        }
    ).drop("_rn")


def top_per_group(df, group, order, k):
    """First ``k`` rows per group; Spark cuts each task's groups to ``k`` before the shuffle."""
    window = Window.partitionBy(*group).orderBy(*order)
    ranked = df.withColumn("rank", F.row_number().over(window))
    return ranked.where(F.col("rank") <= k)


def top_overall(df, order, k, out="rank"):
    """The ``k`` first rows, numbered. Only those ``k`` rows reach the numbering window."""
    cut = df.orderBy(*order).limit(k)
    return cut.withColumn(out, F.row_number().over(Window.orderBy(*order)))
