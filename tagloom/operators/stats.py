"""Descriptive statistics: distributions, quantiles, histograms and correlation.

Quantiles and bins work on (value, rows) counts: one map-side combined aggregation shrinks
the data first, and everything after it is proportional to the number of distinct values.
"""

import math

from pyspark.sql import functions as F

from tagloom.functions.votes import agreement, name_of
from tagloom.schemas import SHORT_NAMES
from tagloom.session import scratch_table_path
from tagloom.sources.tables import save_stage


def value_counts(df, column, digits=None):
    """Rows and percentage share per value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))  # reuses the shuffle of the counts
    share = 100.0 * F.col("n") / F.col("total")
    share = F.round(share, digits) if digits is not None else share
    joined = counts.crossJoin(F.broadcast(total))  # one-row side
    return joined.select(column, "n", share.alias("share_pct"))


def ordered_class_counts(df, classes, class_id="class_id"):
    """Rows per class in the fixed order of the dimension, zero when absent."""
    counts = df.groupBy(class_id).agg(F.count(F.lit(1)).alias("n"))
    return F.broadcast(classes).join(counts, class_id, "left").select(
        class_id, "class_name", F.coalesce("n", F.lit(0)).alias("n")
    )


def _value_rows(df, value, group=()):
    return df.groupBy(*group, F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def describe(df, value):
    """count, mean, sample deviation, min, quartiles and max of a numeric column.

    The quartiles are exact order statistics found by narrowing counted ranges
    (``exact_quantiles``), so a continuous column costs a few passes, not an entry per value.
    """
    counts = _value_rows(df, value)
    v = F.col("value").cast("double")
    n, total = F.sum("rows"), F.sum(v * F.col("rows"))
    basics = counts.agg(
        n.alias("n"),
        (total / n).alias("mean"),
        F.min("value").cast("double").alias("minimum"),
        F.max("value").cast("double").alias("maximum"),
        F.sum(v * v * F.col("rows")).alias("sq"),
        total.alias("total"),
    )
    q = exact_quantiles(df, value, [0.25, 0.5, 0.75]).first()
    q = [q[f"q{i}"] for i in range(3)] if q else [None] * 3
    spread = F.col("sq") - F.col("total") * F.col("total") / F.col("n")
    return basics.select(
        "n",
        "mean",
        F.sqrt(F.try_divide(F.greatest(spread, F.lit(0.0)), F.col("n") - 1)).alias("std"),
        "minimum",
        *(F.lit(x).cast("double").alias(name) for x, name in zip(q, ("q25", "q50", "q75"))),
        "maximum",
    )


#: Buckets a counted range is cut into at each pass of ``exact_quantiles``.
RANGE_BUCKETS = 1024
#: Rows of a range small enough to be read whole.
RANGE_ROWS = 1024


def order_statistics(df, value, ranks, group=None):
    """Exact k-th smallest values (0-based ``ranks`` per group key) by narrowing counted ranges.

    Each pass cuts every open range into RANGE_BUCKETS equal parts and counts, in one aggregate,
    the rows, least and largest value of each part; the part holding a rank, from its least to
    its largest value, becomes the range (parts are contiguous in value order, so this range
    holds exactly that part's rows). A range of one value is the answer; one of at most
    RANGE_ROWS rows is read whole, all such ranges in one job. Nothing holds one entry per
    distinct value. NULL values are not counted. Returns {(group key, rank): value}.
    """
    rows = df.select((F.col(group) if group else F.lit(None)).alias("g"), F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull())
    bounds = {r["g"]: (r["lo"], r["hi"]) for r in rows.groupBy("g").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).collect()}
    state, found = {}, {}
    for g, ks in ranks.items():
        for k in ks:
            if g in bounds:
                lo, hi = bounds[g]
                if lo == hi:
                    found[g, k] = lo
                else:
                    state[g, k] = (lo, hi, 0)

    def within(g, lo, hi):
        return F.col("g").eqNullSafe(F.lit(g)) & (F.col("v") >= F.lit(lo)) & (F.col("v") <= F.lit(hi))

    while state:
        targets = list(state.items())
        cases = []
        for i, ((g, _), (lo, hi, _)) in enumerate(targets):
            bucket = F.least(F.floor((F.col("v") - F.lit(lo)) / F.lit((hi - lo) / RANGE_BUCKETS)), F.lit(RANGE_BUCKETS - 1))
            cases.append(F.when(within(g, lo, hi), F.struct(F.lit(i).alias("t"), bucket.cast("int").alias("b"), F.col("v").alias("v"))))
        hits = rows.select(F.explode(F.filter(F.array(*cases), lambda c: c.isNotNull())).alias("c"))
        cells = {}
        for r in hits.groupBy("c.t", "c.b").agg(F.count(F.lit(1)).alias("n"), F.min("c.v").alias("lo"), F.max("c.v").alias("hi")).collect():
            cells.setdefault(r["t"], []).append((r["b"], r["n"], r["lo"], r["hi"]))  # at most RANGE_BUCKETS per target
        state, reads = {}, []
        for i, ((g, k), (_, _, below)) in enumerate(targets):
            seen = below
            for _, n, lo, hi in sorted(cells.get(i, [])):
                if seen + n > k:
                    if lo == hi:
                        found[g, k] = lo
                    elif n <= RANGE_ROWS:
                        reads.append(((g, k), lo, hi, seen))
                    else:
                        state[g, k] = (lo, hi, seen)
                    break
                seen += n
        if reads:
            tags = [F.when(within(g, lo, hi), F.lit(i)) for i, ((g, _), lo, hi, _) in enumerate(reads)]
            picked = rows.select(F.explode(F.filter(F.array(*tags), lambda t: t.isNotNull())).alias("t"), "v")
            values = {}
            for r in picked.collect():  # at most RANGE_ROWS rows for each read range
                values.setdefault(r["t"], []).append(r["v"])
            for i, (key, _, _, seen) in enumerate(reads):
                found[key] = sorted(values[i])[key[1] - seen]
    return found


def exact_quantiles(df, value, probs, group=None):
    """Quantiles with linear interpolation between order statistics, as ``percentile`` gives them;
    a table of (group,) q0, q1, ... with one row per group."""
    keys = [group] if group else []
    gk = F.col(group) if group else F.lit(None)
    sizes = {r["g"]: r["n"] for r in df.where(F.col(value).isNotNull()).groupBy(gk.alias("g")).agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted = {g: sorted({int(math.floor((n - 1) * p)) for p in probs} | {min(n - 1, int(math.floor((n - 1) * p)) + 1) for p in probs}) for g, n in sizes.items()}
    stats = order_statistics(df, value, wanted, group)
    out = []
    for g, n in sizes.items():
        row = [g] if group else []
        for p in probs:
            position = (n - 1) * p
            lower = int(math.floor(position))
            higher = min(n - 1, lower + 1)
            a, b = stats[g, lower], stats[g, higher]
            # the same arithmetic as Spark's percentile
            row.append((higher - position) * a + (position - lower) * b if higher != lower else a)
        out.append(tuple(row))
    schema = ", ".join([*(f"{k} {dict(df.dtypes)[k]}" for k in keys), *(f"q{i} double" for i in range(len(probs)))])
    return df.sparkSession.createDataFrame(out, schema)


def histogram(df, value, bins, group=None):
    """Equal-width bins between the column's minimum and maximum; the last bin is closed.

    With ``group`` the bins are shared and counted per group; empty bins are listed.
    """
    group = [group] if group else []
    # Written once: bounds, grid and bins would each count the source again otherwise.
    counts = save_stage(_value_rows(df, value, group), scratch_table_path(df.sparkSession, "counts"))
    bounds = counts.agg(F.min("value").alias("low"), F.max("value").alias("high"))
    placed = counts.crossJoin(F.broadcast(bounds))  # one-row side
    width = (F.col("high") - F.col("low")).cast("double")
    raw = F.try_divide((F.col("value") - F.col("low")).cast("double") * bins, width)
    bin_no = F.least(F.floor(F.coalesce(raw, F.lit(0.0))), F.lit(bins - 1)).cast("int")
    filled = placed.groupBy(*group, bin_no.alias("bin")).agg(F.sum("rows").alias("n"))
    grid = bounds.select("low", "high", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    if group:
        grid = grid.crossJoin(F.broadcast(counts.select(*group).distinct()))  # bins x groups

    def edge(i):
        return F.col("low") + (F.col("high") - F.col("low")) * i / F.lit(float(bins))

    return grid.join(filled, [*group, "bin"], "left").select(
        *group,
        "bin",
        edge(F.col("bin")).alias("low_edge"),
        edge(F.col("bin") + 1).alias("high_edge"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_stats(df, value, group):
    """Quartiles, 1.5 IQR whiskers and number of outliers per group."""
    counts = _value_rows(df, value, [group])
    # one row per group, from exact order statistics
    quartiles = F.broadcast(exact_quantiles(df, value, [0.25, 0.5, 0.75], group).select(group, F.array("q0", "q1", "q2").alias("q")))
    q1, median, q3 = F.col("q")[0], F.col("q")[1], F.col("q")[2]
    low_fence, high_fence = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = (F.col("value") >= low_fence) & (F.col("value") <= high_fence)
    joined = counts.join(quartiles, group)
    return joined.groupBy(group).agg(
        F.first(q1).alias("q1"),
        F.first(median).alias("median"),
        F.first(q3).alias("q3"),
        F.least(F.min(F.when(inside, F.col("value"))), F.first(q1)).alias("whisker_low"),
        F.greatest(F.max(F.when(inside, F.col("value"))), F.first(q3)).alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("rows"))), F.lit(0)).alias("n_outliers"),
    )


def agreement_by_class(loaded, group="class_name"):
    return loaded.groupBy(group).agg(F.avg(agreement()).alias("mean_agreement"))


def unanimous_share(loaded):
    """Percentage of rows on which the whole panel agreed."""
    unanimous = F.count_if(agreement() == 1.0)
    return loaded.agg((100.0 * unanimous / F.count(F.lit(1))).alias("unanimous_pct"))


def mean_by_class(df, value, out, group="class_name"):
    return df.groupBy(group).agg(F.avg(value).alias(out))


def correlation(df, columns, absolute=False):
    """Pearson matrix in long form: one row per ordered pair of columns.

    One aggregate gives all pairs and the columns' ends; it has ``len(columns)`` squared cells.
    A constant column has no correlation (NULL).
    """
    columns = list(columns)
    numbers = df.select(*(F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)))
    spans = [F.max(f"c{i}") == F.min(f"c{i}") for i in range(len(columns))]
    pairs = [(i, j) for i in range(len(columns)) for j in range(i + 1, len(columns))]
    found = numbers.agg(
        *(s.alias(f"constant{i}") for i, s in enumerate(spans)),
        *(F.var_pop(f"c{i}").alias(f"v{i}") for i in range(len(columns))),
        *(F.covar_pop(f"c{i}", f"c{j}").alias(f"r{i}_{j}") for i, j in pairs),
    ).first()
    cells = []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            if found[f"constant{i}"] is not False or found[f"constant{j}"] is not False:
                r = None
            elif i == j:
                r = 1.0
            else:
                r = found[f"r{min(i, j)}_{max(i, j)}"] / math.sqrt(found[f"v{i}"] * found[f"v{j}"])
            cells.append((i, j, a, b, abs(r) if r is not None and absolute else r))
    return df.sparkSession.createDataFrame(
        cells, "i int, j int, feature_a string, feature_b string, r double"
    )


def correlation_matrix(long_form, columns):
    """Long form to one row per feature, columns in the given order."""
    return long_form.groupBy("i", "feature_a").pivot("feature_b", list(columns)).agg(F.first("r"))


def correlated_columns(long_form, threshold=0.95):
    """Columns correlated above the threshold with any column before them."""
    return (
        long_form.where((F.col("i") < F.col("j")) & (F.abs("r") > threshold))
        .groupBy(F.col("j").alias("position"), F.col("feature_b").alias("feature"))
        .agg(F.count(F.lit(1)).alias("n_partners"))
    )


def drop_correlated(df, columns, threshold=0.95):
    """Names of the columns to keep; NULL correlations never drop anything."""
    dropped = {r["feature"] for r in correlated_columns(correlation(df, columns), threshold).collect()}
    return [c for c in columns if c not in dropped]


def class_labels(df, class_id="class_id", names=SHORT_NAMES):
    return df.withColumn("label", name_of(class_id, names))


def stats_table(*parts):
    """Report numbers of several one-key frames as one long table (metric, key, value)."""
    frames = [
        df.select(
            F.lit(metric).alias("metric"),
            F.col(key).cast("string").alias("key") if key else F.lit("").alias("key"),
            F.col(value).cast("double").alias("value"),
        )
        for metric, df, key, value in parts
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out
