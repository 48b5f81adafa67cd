"""Multi-class metrics as SQL aggregates.

Predictions are reduced to the cells of a confusion table in one aggregation; every
count-based metric is then arithmetic on one row per model.
"""

from functools import reduce

from pyspark.sql import functions as F

from tagloom.functions.arrays import argmax_columns
from tagloom.operators.ranking import running_totals
from tagloom.schemas import CLASS_IDS, PROB_COLUMNS, SHORT_NAMES
from tagloom.session import scratch_table_path
from tagloom.sources.tables import save_stage

METRICS = (
    "accuracy",
    "balanced_accuracy",
    "f1_macro",
    "f1_weighted",
    "precision_macro",
    "recall_macro",
    "mcc",
    "cohen_kappa",
)
EPS = 2.220446049250313e-16


def _sum(columns):
    return reduce(lambda a, b: a + b, columns)


def _ratio(num, den):
    """num / den as double, 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def confusion(df, true="true_class_id", pred="pred_class_id", classes=CLASS_IDS):
    """All cells of the confusion matrix, zeros included."""
    ids = F.array(*map(F.lit, classes))
    grid = df.sparkSession.range(1).select(F.explode(ids).alias(true)).select(
        true, F.explode(ids).alias(pred)
    )
    counts = df.groupBy(F.col(true).cast("int").alias(true), F.col(pred).cast("int").alias(pred)).agg(
        F.count(F.lit(1)).alias("n")
    )
    return F.broadcast(grid).join(counts, [true, pred], "left").select(
        true, pred, F.coalesce("n", F.lit(0)).alias("n")
    )


def confusion_row(df, true="true_class_id", pred="pred_class_id", by=(), classes=CLASS_IDS, rows=None):
    """Confusion cells side by side (``c_true_pred``), one row per ``by`` group.

    ``rows`` names a column holding how many rows an input row stands for.
    """
    weight = F.col(rows) if rows else F.lit(1)
    cells = [
        F.coalesce(
            F.sum(F.when((F.col(true) == t) & (F.col(pred) == p), weight)), F.lit(0)
        ).cast("long").alias(f"c_{t}_{p}")
        for t in classes
        for p in classes
    ]
    return df.groupBy(*by).agg(*cells)


class _Cells:
    """Margins and per-class ratios over the columns of a confusion row."""

    def __init__(self, classes=CLASS_IDS):
        def cell(t, p):
            return F.col(f"c_{t}_{p}")

        self.classes = classes
        self.true = {k: _sum(cell(k, p) for p in classes) for k in classes}
        self.pred = {k: _sum(cell(t, k) for t in classes) for k in classes}
        self.hit = {k: cell(k, k) for k in classes}
        self.n = _sum(self.true.values())
        self.correct = _sum(self.hit.values())
        self.precision = {k: _ratio(self.hit[k], self.pred[k]) for k in classes}
        self.recall = {k: _ratio(self.hit[k], self.true[k]) for k in classes}
        self.f1 = {k: _ratio(2 * self.hit[k], self.true[k] + self.pred[k]) for k in classes}
        # A class counts in macro averages when it was seen on either side.
        self.seen = {
            k: F.when(self.true[k] + self.pred[k] > 0, 1).otherwise(0) for k in classes
        }

    def macro(self, values):
        return _ratio(_sum(values[k] * self.seen[k] for k in self.classes), _sum(self.seen.values()))

    def weighted(self, values):
        return _ratio(_sum(values[k] * self.true[k] for k in self.classes), self.n)


def metrics(cells, by=(), classes=CLASS_IDS):
    """The eight count-based metrics per confusion row."""
    c = _Cells(classes)
    n, correct = c.n.cast("double"), c.correct.cast("double")
    in_true = [F.when(c.true[k] > 0, 1).otherwise(0) for k in classes]
    chance = _sum(c.pred[k].cast("double") * c.true[k] for k in classes)
    pred_sq = _sum(c.pred[k].cast("double") * c.pred[k] for k in classes)
    true_sq = _sum(c.true[k].cast("double") * c.true[k] for k in classes)
    observed, expected = _ratio(correct, n), _ratio(chance, n * n)
    values = {
        "accuracy": observed,
        "balanced_accuracy": _ratio(_sum(c.recall[k] for k in classes), _sum(in_true)),
        "f1_macro": c.macro(c.f1),
        "f1_weighted": c.weighted(c.f1),
        "precision_macro": c.macro(c.precision),
        "recall_macro": c.macro(c.recall),
        "mcc": _ratio(correct * n - chance, F.sqrt((n * n - pred_sq) * (n * n - true_sq))),
        "cohen_kappa": _ratio(observed - expected, 1.0 - expected),
    }
    return cells.select(*by, *(values[m].alias(m) for m in METRICS))


def classification_report(cells, names=SHORT_NAMES, classes=CLASS_IDS):
    """Per-class precision, recall, F1 and support, then accuracy and both averages."""
    c = _Cells(classes)

    def line(order, label, precision, recall, f1, support):
        return F.struct(
            F.lit(order).alias("line"),
            F.lit(label).alias("label"),
            precision.cast("double").alias("precision"),
            recall.cast("double").alias("recall"),
            f1.alias("f1_score"),
            support.cast("long").alias("support"),
        )

    missing, k = F.lit(None), len(classes)
    lines = [
        line(i, names[cls], c.precision[cls], c.recall[cls], c.f1[cls], c.true[cls])
        for i, cls in enumerate(classes)
    ]
    lines += [
        line(k, "accuracy", missing, missing, _ratio(c.correct, c.n), c.n),
        line(k + 1, "macro avg", c.macro(c.precision), c.macro(c.recall), c.macro(c.f1), c.n),
        line(
            k + 2, "weighted avg", c.weighted(c.precision), c.weighted(c.recall), c.weighted(c.f1), c.n
        ),
    ]
    return cells.select(F.inline(F.array(*lines)))


def auc_ovr(df, true="true_class_id", probs=PROB_COLUMNS, classes=CLASS_IDS):
    """One-vs-rest area under the ROC curve per class, tied scores counting half.

    Rows are first merged per distinct score, so a score shared by a third of the table is
    one row by the time scores are put in order. A class with a NULL score has no AUC (NULL).
    """
    long_form = df.select(
        F.col(true).alias("_true"),
        F.inline(
            F.array(
                *(F.struct(F.lit(k).alias("class_id"), F.col(p).alias("score"))
                  for k, p in zip(classes, probs))
            )
        ),
    )
    per_score = long_form.groupBy("class_id", "score").agg(
        F.count_if(F.col("_true") == F.col("class_id")).alias("pos"),
        F.count_if(F.col("_true") != F.col("class_id")).alias("neg"),
    )
    # Put in order in several passes, so it is written once.
    per_score = save_stage(per_score, scratch_table_path(df.sparkSession, "scores"))
    ordered = running_totals(per_score, "score", {"neg_below": F.col("neg")}, group=["class_id"])
    wins = F.col("pos").cast("double") * (F.col("neg_below") + F.col("neg") / 2.0)
    area = F.try_divide(F.sum(wins), F.sum("pos").cast("double") * F.sum("neg"))
    return ordered.groupBy("class_id").agg(F.when(~F.bool_or(F.col("score").isNull()), area).alias("auc"))


def macro_auc(df, **kwargs):
    """Average one-vs-rest AUC; NULL as soon as one class has no positives or negatives."""
    per_class = auc_ovr(df, **kwargs)
    complete = F.count("auc") == F.count(F.lit(1))
    return per_class.agg(F.when(complete, F.avg("auc")).alias("auc_roc_ovr"))


def log_loss(df, true="true_class_id", probs=PROB_COLUMNS, classes=CLASS_IDS):
    chosen = F.lit(None).cast("double")
    for k, p in zip(classes, probs):
        chosen = F.when(F.col(true) == k, F.col(p)).otherwise(chosen)
    clipped = F.least(F.greatest(chosen, F.lit(EPS)), F.lit(1.0 - EPS))
    return df.agg(F.avg(-F.log(clipped)).alias("log_loss"))


# --- decision threshold for the rare class ------------------------------------------------

FIRST_THRESHOLD, THRESHOLD_STEP, N_THRESHOLDS = 0.05, 0.01, 90


def _threshold(i):
    return F.lit(FIRST_THRESHOLD) + i.cast("double") * F.lit(THRESHOLD_STEP)


def apply_threshold(df, threshold, probs=PROB_COLUMNS, out="pred_class_id"):
    """Class 0 when its probability reaches the threshold, else the better of the others."""
    other = argmax_columns(probs[1:], list(range(1, len(probs))))
    rule = F.when(F.col(probs[0]) >= F.lit(float(threshold)), 0).otherwise(other)
    return df.withColumn(out, rule.cast("int"))


def threshold_scores(df, true="true_class_id", probs=PROB_COLUMNS):
    """Macro F1 of every candidate threshold.

    A row is called class 0 by exactly the thresholds up to its probability, so rows reduce
    to (thresholds passed, true class, other class) counts; the candidates are expanded on
    those few hundred cells, never on the rows.
    """
    p = F.col(probs[0])
    guess = F.floor((p - FIRST_THRESHOLD) / THRESHOLD_STEP)
    # The estimate can be off by one in floating point; compare with the real thresholds.
    last = (
        F.when(p >= _threshold(guess + 1), guess + 1)
        .when(p < _threshold(guess), guess - 1)
        .otherwise(guess)
    )
    passed = F.least(F.greatest(last + 1, F.lit(0)), F.lit(N_THRESHOLDS)).cast("int")
    other = argmax_columns(probs[1:], list(range(1, len(probs))))
    cells = df.groupBy(
        passed.alias("passed"), F.col(true).alias("true_class_id"), other.alias("other")
    ).agg(F.count(F.lit(1)).alias("rows"))
    candidates = F.sequence(F.lit(0), F.lit(N_THRESHOLDS - 1))
    expanded = cells.select("*", F.explode(candidates).alias("i")).withColumn(
        "pred_class_id", F.when(F.col("i") < F.col("passed"), 0).otherwise(F.col("other"))
    )
    per_threshold = confusion_row(expanded, by=["i"], rows="rows")
    return metrics(per_threshold, by=["i"]).select(
        "i", _threshold(F.col("i")).alias("threshold"), "f1_macro"
    )


def tune_threshold(df, true="true_class_id", probs=PROB_COLUMNS):
    """First threshold with the best macro F1."""
    return threshold_scores(df, true, probs).orderBy(F.desc("f1_macro"), "i").limit(1)


def review_queue(df, k, prob="prob_hate", key="tweet_id"):
    """Rows most likely to need a human look."""
    return df.orderBy(F.desc(prob), key).limit(k)
