"""Ranked lexical search by a dual-tree traversal.

Scores are integer BM25-like sums of weight x contribution over an item's terms. Both sides get a hierarchy whose nodes
hold coordinate maxima over the query terms:

* documents: a leaf holds at most about ``LEAF_DOCS`` documents that share their strongest query
  term; the node above a leaf holds all leaves of that term. A node keeps, for every query term,
  the largest contribution of any of its documents;
* items: groups of ``GROUP_ITEMS`` items of consecutive ids; a group keeps, for every term, the largest count
  of any of its items.

Every item first gets a lower bound of its kth score by scoring the documents of its
``SEED_LEAVES`` most promising leaves. The traversal then descends (item group, upper node) ->
(item group, leaf) -> (item, leaf) and drops a pair as soon as its bound, the sum over terms
of count maximum x weight x contribution maximum, is below the weakest kth score of the items
it covers: no document below it can then reach any of those items' top k, so pruning is exact.
Surviving (item, leaf) pairs are scored document by document.

A document is one row holding the numbers of its query terms and their contributions as two arrays, so
its terms are counted without a shuffle and its scores are summed inside the task that holds it; what
moves is these rows (by leaf) and sums keyed by node pair. Item terms are joined by (item group, term).

Defined cases: a null text has no terms (a document with no terms counts in neither N nor L and
never scores); every row of ``documents`` is one document, so repeated rows are ranked apart
and, having equal doc_id and score, fill consecutive ranks; a null doc_id is ranked after all
ids at an equal score; rows of ``benchmark`` that repeat (item_id, text) count once, different
texts of one item_id form one item holding all their terms; an item without terms, or without a
document scoring above 0, has no rows; empty tables give no rows; other columns are ignored.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Window
from pyspark.sql import functions as F

from tagloom.llm.common import BATCH_ROWS, stage
from tagloom.operators.ranking import with_row_number
from tagloom.operators.sizing import small_side

# Fixed values of the scoring rule.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
TOP = 20

#: Documents of a leaf node (the unit of pruning and of exact scoring).
LEAF_DOCS = 256
#: Items of an item node; below 31, as a pair of nodes marks its items in the bits of an integer.
GROUP_ITEMS = 16
#: Leaves scored for each item to start its kth-score bound; a bound only, results do not depend on it.
SEED_LEAVES = 2
#: Query terms up to this many are looked up inside the tasks; more are joined by a shuffle.
LOOKED_UP = 100_000
#: Above every term number, so that weighted contribution and number fit into one long.
NUMBERS = 1 << 28


def terms(text):
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), 0)


def item_terms(benchmark):
    """(item_id, term, qc): query terms with their counts, repeats included."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    return items.select("item_id", F.explode(terms(F.col("text"))).alias("term")).groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("qc"))


def numbered_terms(queries):
    """(term, t): the distinct query terms with numbers from 0."""
    hashed = queries.select("term").distinct().withColumn("h", F.xxhash64("term"))
    numbered = with_row_number(hashed, "h", tie=["term"], out="t")
    return stage(numbered.select("term", (F.col("t") - 1).cast("int").alias("t")), "lexical-terms")


def numbered_items(queries):
    """(item_id, g, bit): items with a term, in groups of GROUP_ITEMS, and their places there."""
    number = F.col("i") - 1
    items = with_row_number(queries.select("item_id").distinct().where(F.col("item_id").isNotNull()), "item_id", out="i")
    return items.select(
        "item_id", F.floor(number / GROUP_ITEMS).cast("int").alias("g"), (number % GROUP_ITEMS).cast("int").alias("bit")
    )


def counted(documents, numbered, looked_up=LOOKED_UP):
    """Each document row: key, doc_id, its length n, numbers t of the query terms it holds, their counts tf."""
    docs = documents.select(
        F.monotonically_increasing_id().alias("rk"), F.col("doc_id").cast("long").alias("doc_id"), terms(F.col("text")).alias("all")
    )
    known = numbered.limit(looked_up + 1).collect()
    if len(known) > looked_up:
        return stage(_counted_by_shuffle(docs, numbered), "lexical-counts")
    words = pa.array([r["term"] for r in sorted(known, key=lambda r: r["t"])], pa.string())
    width = max(1, len(words))

    def count(batches):
        for batch in batches:
            lists = batch.column("all")
            n = pc.list_value_length(lists).to_numpy()
            codes = pc.fill_null(pc.index_in(lists.flatten(), value_set=words), -1).to_numpy()
            rows = np.repeat(np.arange(len(batch), dtype=np.int64), n)[codes >= 0]
            cells, tf = np.unique(rows * width + codes[codes >= 0], return_counts=True)
            held = np.bincount(cells // width, minlength=len(batch))
            ends = pa.array(np.concatenate([[0], np.cumsum(held)]).astype(np.int32))
            t, tf = pa.array((cells % width).astype(np.int32)), pa.array(tf.astype(np.int32))
            arrays = [batch.column("rk"), batch.column("doc_id"), pa.array(n.astype(np.int64))]
            arrays += [pa.ListArray.from_arrays(ends, t), pa.ListArray.from_arrays(ends, tf)]
            yield pa.RecordBatch.from_arrays(arrays, names=["rk", "doc_id", "n", "t", "tf"])

    documents.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return stage(docs.mapInArrow(count, "rk long, doc_id long, n long, t array<int>, tf array<int>"), "lexical-counts")


def _counted_by_shuffle(docs, numbered):
    """The same rows, counted in a shuffle; a marker without term keeps documents that hold none."""
    marked = F.explode(F.concat("all", F.array(F.lit(None).cast("string")))).alias("term")
    exploded = docs.select("rk", "doc_id", F.size("all").cast("long").alias("n"), marked)
    found = exploded.join(numbered, "term", "left").where(F.col("t").isNotNull() | F.col("term").isNull())
    tf = found.groupBy("rk", "doc_id", "n", "t").agg(F.count(F.lit(1)).cast("int").alias("tf"))
    own = F.when(F.col("t").isNotNull(), F.struct("t", "tf"))
    held = tf.groupBy("rk", "doc_id", "n").agg(F.sort_array(F.collect_list(own)).alias("held"))
    return held.select("rk", "doc_id", "n", F.col("held.t").alias("t"), F.col("held.tf").alias("tf"))


def entries(rows, *keys):
    """A row for each query term of a document: the keys, t and c."""
    return rows.select(*keys, F.inline(F.arrays_zip("t", "c")))


def weights(docs, big_n):
    """w for every query term present: floor(1000 * ln((2N + 2) / (2 df + 1))) in doubles."""
    df = docs.select(F.explode("t").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    ratio = F.lit(float(2 * big_n + 2)) / (F.col("df").cast("double") * 2 + 1)
    return df.select("t", F.floor(F.log(ratio) * 1000).cast("long").alias("w"))


def leaves(docs, w):
    """Leaf of every document row: its strongest query term, then a hash bucket of at most about LEAF_DOCS rows."""
    strength = F.max(F.col("w") * F.col("c") * NUMBERS + F.col("t"))
    top = entries(docs, "rk").join(w, "t").groupBy("rk").agg(strength.alias("s"))
    top = stage(top.select("rk", (F.col("s") % NUMBERS).cast("int").alias("top")), "lexical-tops")
    sizes = small_side(top.groupBy("top").agg(F.count(F.lit(1)).alias("k")))
    return top.join(sizes, "top").select(
        "rk", "top", F.pmod(F.xxhash64("rk"), F.ceil(F.col("k") / LEAF_DOCS)).alias("sub")
    )


def search(documents, benchmark, k=TOP):
    """For each item its k highest-scoring documents with score above 0: item_id, rank, doc_id, score."""
    queries = stage(item_terms(benchmark), "lexical-items")
    numbered = numbered_terms(queries)
    rows = counted(documents, numbered)
    figures = rows.agg(F.count(F.when(F.col("n") > 0, 1)).alias("N"), F.coalesce(F.sum("n"), F.lit(0)).alias("L")).first()
    big_n, big_l = int(figures["N"]), int(figures["L"])
    if big_l == 0:
        return documents.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    m = F.lit(75) + F.expr(f"(25L * n * {big_n}L) div {big_l}L")
    c = F.expr("transform(tf, x -> int((1000000000L * x) div (1000L * x + 12L * m)))")
    docs = rows.where(F.size("t") > 0).withColumn("m", m).select("rk", "doc_id", "t", c.alias("c"))
    w = stage(weights(docs, big_n), "lexical-weights")
    placed = stage(docs.join(leaves(docs, w), "rk").repartition("top", "sub"), "lexical-leaves")
    # columns: rk, doc_id, t, c, top, sub  -- leaf = (top, sub), upper node = top

    leaf_max = stage(entries(placed, "top", "sub").groupBy("top", "sub", "t").agg(F.max("c").alias("cm")).repartition("top", "sub"), "lexical-maxima")
    upper_max = leaf_max.groupBy("top", "t").agg(F.max("cm").alias("cm"))
    items = stage(numbered_items(queries), "lexical-groups")
    asked = stage(
        queries.join(numbered, "term").join(items, "item_id").join(w, "t").select("item_id", "g", "bit", "t", (F.col("qc") * F.col("w")).alias("qw")),
        "lexical-asked",
    )

    def bounds(pairs, *keys):
        return pairs.groupBy(*keys).agg(F.sum(F.col("qw") * F.col("cm")).alias("ub"))

    # kth-score bound of each item from its most promising leaves
    item_leaf = bounds(leaf_max.join(asked, "t"), "item_id", "g", "bit", "top", "sub")
    best = Window.partitionBy("item_id").orderBy(F.desc("ub"), "top", "sub")
    seeds = stage(item_leaf.withColumn("r", F.row_number().over(best)).where(F.col("r") <= SEED_LEAVES).select("g", "bit", "top", "sub"), "lexical-seeds")
    kth = Window.partitionBy("item_id").orderBy(F.desc("score"))
    bound = _scores(placed, asked, seeds).withColumn("r", F.row_number().over(kth)).where(F.col("r") == k).select("item_id", F.col("score").alias("kth"))
    tau = stage(items.join(bound, "item_id", "left").select("item_id", "g", "bit", F.greatest(F.coalesce("kth", F.lit(1)), F.lit(1)).alias("tau")), "lexical-bounds")
    group_tau = tau.groupBy("g").agg(F.min("tau").alias("tau"))
    group_terms = asked.groupBy("g", "t").agg(F.max("qw").alias("qw"))

    # (group, upper node) pairs, then (group, leaf), then (item, leaf)
    enough = F.col("ub") >= F.col("tau")
    upper_pairs = bounds(upper_max.join(group_terms, "t"), "g", "top").join(group_tau, "g").where(enough).select("g", "top")
    leaf_pairs = bounds(leaf_max.join(group_terms, "t").join(upper_pairs, ["g", "top"]), "g", "top", "sub")
    leaf_pairs = stage(leaf_pairs.join(group_tau, "g").where(enough).select("g", "top", "sub"), "lexical-leaf-pairs")
    item_pairs = bounds(leaf_max.join(leaf_pairs, ["top", "sub"]).join(asked, ["g", "t"]), "g", "bit", "top", "sub")
    item_pairs = stage(item_pairs.join(tau, ["g", "bit"]).where(enough).select("g", "bit", "top", "sub"), "lexical-pairs")

    scored = _scores(placed.repartition("top", "sub"), asked, item_pairs).where(F.col("score") > 0)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "rk")
    return (
        scored.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", F.col("score").cast("long").alias("score"))
    )


def _scores(placed, asked, pairs):
    """Exact scores of the documents of the given (item, leaf) pairs: item_id, rk, doc_id, score.

    A leaf meets each item group once, with its items marked in ``marks``. Grouping by leaf too keeps the
    sums where the rows are, if ``placed`` is dealt out by leaf.
    """
    wanted = pairs.groupBy("top", "sub", "g").agg(F.expr("bit_or(shiftleft(1, bit))").alias("marks"))
    held = entries(placed.join(wanted, ["top", "sub"]), "top", "sub", "rk", "doc_id", "g", "marks")
    found = held.join(asked, ["g", "t"]).where(F.expr("(marks & shiftleft(1, bit)) != 0"))
    return found.groupBy("item_id", "top", "sub", "rk", "doc_id").agg(F.sum(F.col("qw") * F.col("c")).alias("score"))
