"""Small array and score expressions."""

from pyspark.sql import functions as F


def softmax(scores):
    """Numerically safe softmax of an array<double> column."""
    scores = F.col(scores) if isinstance(scores, str) else scores
    exps = F.transform(scores, lambda s: F.exp(s - F.array_max(scores)))
    total = F.aggregate(exps, F.lit(0.0), lambda acc, e: acc + e)
    return F.transform(exps, lambda e: e / total)


def argmax(values):
    """Zero-based position of the first largest element."""
    values = F.col(values) if isinstance(values, str) else values
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def argmax_columns(columns, ids=None):
    """Id of the first largest of several columns (no array is built)."""
    ids = list(range(len(columns))) if ids is None else list(ids)
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    if len(cols) == 1:
        return F.lit(ids[0])
    top = F.greatest(*cols)
    chosen = F.lit(ids[-1])
    for class_id, column in reversed(list(zip(ids[:-1], cols[:-1]))):
        chosen = F.when(column == top, class_id).otherwise(chosen)
    return chosen.cast("int")


def pad_or_cut(ids, length, pad=0):
    """Cut an int array at ``length`` and fill it up with ``pad`` on the right."""
    ids = F.col(ids) if isinstance(ids, str) else ids
    cut = F.slice(ids, 1, length)
    return F.concat(cut, F.array_repeat(F.lit(pad).cast("int"), F.lit(length) - F.size(cut)))


def truncate_tokens(tokens, length=128):
    """Whitespace tokens cut to a model's maximum input length."""
    return F.slice(F.col(tokens) if isinstance(tokens, str) else tokens, 1, length)
