"""Declared schemas of the stored tables, and the class dimension."""

from pyspark.sql import types as T

# The class ids and the three naming schemes used for them.
CLASS_NAMES = {0: "hate_speech", 1: "offensive_language", 2: "neither"}
SHORT_NAMES = {0: "hate", 1: "offensive", 2: "neither"}
DISPLAY_NAMES = {0: "Hate Speech", 1: "Offensive Language", 2: "Neither"}
CLASS_IDS = (0, 1, 2)
VOTE_COLUMNS = ("hate_votes", "offensive_votes", "neither_votes")
PROB_COLUMNS = ("prob_hate", "prob_offensive", "prob_neither")
SPLITS = ("train", "validation", "test")


def _struct(*fields):
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


_long, _int, _str, _dbl = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()

# CSV columns bind by position, so the unnamed first column simply gets its final name.
RAW_CSV = _struct(
    ("tweet_id", _long, True),
    ("count", _int, True),
    ("hate_speech", _int, True),
    ("offensive_language", _int, True),
    ("neither", _int, True),
    ("class", _int, True),
    ("tweet", _str, True),
)

CLASSES = _struct(("class_id", _int, False), ("class_name", _str, False))

TWEETS = _struct(
    ("tweet_id", _long, False),
    ("text", _str, False),
    ("annotator_count", _int, False),
    ("class_id", _int, False),
)

ANNOTATIONS = _struct(
    ("tweet_id", _long, False),
    ("hate_votes", _int, False),
    ("offensive_votes", _int, False),
    ("neither_votes", _int, False),
)

PREDICTIONS = _struct(
    ("tweet_id", _long, True),
    ("true_class_id", _int, True),
    ("pred_class_id", _int, False),
    ("pred_class", _str, False),
    ("prob_hate", _dbl, True),
    ("prob_offensive", _dbl, True),
    ("prob_neither", _dbl, True),
    ("model_name", _str, False),
)

# One answer of an outside labelling service for a group of numbered texts.
LABEL_RESPONSE = T.ArrayType(
    _struct(("index", _int, True), ("label_id", _int, True), ("label_name", _str, True))
)

# One answer of an outside augmentation service for one text.
AUGMENT_RESPONSE = _struct(
    ("original_text", _str, True),
    ("counterfactuals", T.ArrayType(_str), True),
    ("misspelling", _str, True),
    ("paraphrase", _str, True),
    ("quote_context", _str, True),
)


def classes_table(spark):
    """The class dimension as an inline relation (three rows, so joins to it broadcast)."""
    rows = ", ".join(
        f"({i}, '{CLASS_NAMES[i]}', '{SHORT_NAMES[i]}', '{DISPLAY_NAMES[i]}')" for i in CLASS_IDS
    )
    return spark.sql(
        f"SELECT * FROM VALUES {rows} AS c(class_id, class_name, short_name, display_name)"
    )
