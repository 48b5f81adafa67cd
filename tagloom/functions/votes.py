"""Row-wise expressions over annotator votes and class ids."""

from pyspark.sql import functions as F

from tagloom.schemas import CLASS_NAMES, VOTE_COLUMNS


def max_vote(votes=VOTE_COLUMNS):
    return F.greatest(*votes)


def agreement(votes=VOTE_COLUMNS, panel="annotator_count"):
    """Share of the panel that voted for the winning class; NULL for an empty panel."""
    return F.try_divide(max_vote(votes).cast("double"), F.col(panel))


def majority_class(votes=VOTE_COLUMNS):
    """Class with most votes; the lowest id wins ties."""
    top = max_vote(votes)
    chosen = F.lit(len(votes) - 1)
    for class_id in reversed(range(len(votes) - 1)):
        chosen = F.when(F.col(votes[class_id]) == top, class_id).otherwise(chosen)
    return chosen.cast("int")


def name_of(class_id, names=CLASS_NAMES):
    """Class id to name without a join; unknown ids give NULL."""
    class_id = F.col(class_id) if isinstance(class_id, str) else class_id
    expr = F.lit(None).cast("string")
    for key, name in names.items():
        expr = F.when(class_id == key, name).otherwise(expr)
    return expr
