"""Connected components of an edge table by alternating star steps.

Each step takes one minimum for each node (combined before the shuffle) and one join; no node's
neighbours are ever gathered, so a node may have any number of them. Steps are written to the
shared folder, which cuts the lineage.
"""

from pyspark.sql import functions as F

from tagloom.llm.common import stage


def _step(pairs, small):
    """Hang neighbours on the smallest node around: those above a node, or (small) the node itself."""
    if small:
        both = pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        both = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = both.join(low, "u")
    if small:
        hung = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        hung = joined.filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return hung.filter("a <> b").distinct()


def _state(pairs):
    return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))).first())


def components(edges):
    """(node, component) of every node of ``edges`` (a, b); component is the smallest node reachable."""
    pairs = stage(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before, now = None, _state(pairs)
    while now != before:
        pairs = stage(_step(_step(pairs, small=False), small=True), "stars")
        before, now = now, _state(pairs)
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
