"""Reproducible stratified splits, folds and samples.

Rows are ordered by a hash of their key. A split is then one comparison of a row's hash
with the hash found at the cut position of its class, so the data itself is never sorted or
shuffled: one small aggregate finds the narrow hash range holding each cut, and only rows
of those ranges are ranked.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tagloom.operators.sizing import small_side
from tagloom.schemas import SPLITS

SEED = 42
PREFIX_LENGTH = 4


def hash_key(key, seed=SEED):
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))


def hash_fraction_number(key, seed=SEED):
    """First 32 bits of the row hash as a number."""
    return F.conv(F.substring(hash_key(key, seed), 1, 8), 16, 10).cast("long")


def cut_points(df, key, group, positions, seed=SEED):
    """Hash and key of the row standing at each wanted position of each group.

    ``positions`` maps a cut name to an expression over ``n`` (rows of the group). Keys and
    groups are kept between the two jobs, so whatever ``df`` computes runs once here.
    """
    hashed = df.select(F.col(group).alias("_g"), F.col(key).alias("_k")).withColumn(
        "_h", hash_key("_k", seed)
    )
    hashed = hashed.withColumn("_p", F.substring("_h", 1, PREFIX_LENGTH)).persist()
    per_prefix = hashed.groupBy("_g", "_p").agg(F.count(F.lit(1)).alias("_c"))
    by_prefix = Window.partitionBy("_g").orderBy("_p")
    totals = per_prefix.select(
        "_g",
        "_p",
        "_c",
        F.sum("_c").over(by_prefix).alias("_upto"),
        F.sum("_c").over(Window.partitionBy("_g")).alias("n"),
    )
    wanted = F.array(
        *(F.struct(F.lit(i).alias("i"), expr.cast("long").alias("pos"))
          for i, expr in enumerate(positions.values()))
    )
    holding = (
        totals.withColumn("_cut", F.explode(wanted))
        .where((F.col("_cut.pos") > F.col("_upto") - F.col("_c")) & (F.col("_cut.pos") <= F.col("_upto")))
        .select("_g", "_p", "_cut.i", (F.col("_cut.pos") - F.col("_upto") + F.col("_c")).alias("nth"))
    )
    holding = small_side(holding)
    narrow = hashed.join(holding.select("_g", "_p").distinct(), ["_g", "_p"], "left_semi")
    ranked = narrow.withColumn(
        "rn", F.row_number().over(Window.partitionBy("_g", "_p").orderBy("_h", "_k"))
    )
    points = ranked.join(holding, ["_g", "_p"]).where("rn = nth").groupBy("_g").agg(
        *(
            F.max(F.when(F.col("i") == i, F.struct("_h", "_k"))).alias(name)
            for i, name in enumerate(positions)
        )
    )
    points = small_side(points)
    hashed.unpersist()
    return points


def with_cut_number(df, key, group, positions, out, seed=SEED):
    """Number of cuts a row lies behind, 0 for rows up to the first cut."""
    points = cut_points(df, key, group, positions, seed)
    here = F.struct(hash_key(key, seed).alias("_h"), F.col(key).alias("_k"))
    # A missing cut point means position 0: every row lies behind it.
    behind = [F.when(F.col(c).isNull() | (here > F.col(c)), 1).otherwise(0) for c in positions]
    total = behind[0]
    for term in behind[1:]:
        total = total + term
    joined = df.join(points, df[group] == points["_g"], "left")
    return joined.withColumn(out, total.cast("int")).select(*df.columns, out)


def stratified_split(df, key="tweet_id", group="class_id", seed=SEED):
    """70/15/15 train, validation and test rows with the class mix kept in each."""
    positions = {"_train_end": F.floor(F.col("n") * 70 / 100), "_val_end": F.floor(F.col("n") * 85 / 100)}
    numbered = with_cut_number(df, key, group, positions, "_part", seed)
    split = F.element_at(F.array(*(F.lit(s) for s in SPLITS)), F.col("_part") + 1)
    return numbered.withColumn("split", split).drop("_part")


def stratified_folds(df, folds=3, key="tweet_id", group="class_id", seed=SEED, out="fold"):
    """Fold number per row; each class is spread over the folds in equal runs."""
    positions = {f"_fold_{i}": F.floor(F.col("n") * i / folds) for i in range(1, folds)}
    return with_cut_number(df, key, group, positions, out, seed)


def exact_sample(df, fraction, key="tweet_id", seed=SEED):
    """A reproducible sample of round(fraction * n) rows."""
    single = df.withColumn("_all", F.lit(0))
    positions = {"_end": F.rint(F.col("n") * F.lit(float(fraction)))}
    numbered = with_cut_number(single, key, "_all", positions, "_cut", seed)
    return numbered.where("_cut = 0").drop("_cut", "_all")


def class_weights(df, group="class_id"):
    """Balanced weights n / (k * n_c), one row per class present."""
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("n_class"))
    everything = Window.partitionBy(F.lit(1))  # as many rows as classes
    n, k = F.sum("n_class").over(everything), F.count(F.lit(1)).over(everything)
    return counts.withColumn("weight", n.cast("double") / (k * F.col("n_class")))


def with_class_weight(df, group="class_id"):
    return df.join(small_side(class_weights(df, group).select(group, "weight")), group)
