"""Text cleaning and structural features as Column expressions.

The regular expressions spell out what Python's ``re`` means by white space and word
characters, because Java's ``\\s``, ``\\w`` and ``\\b`` are ASCII-only by default.
"""

import html
import sys
from functools import cache

import pandas as pd
from pyspark.sql import functions as F

SPACE_CHARS = r"\x09-\x0d\x1c-\x20\x85\p{Z}"
NON_SPACE = f"[^{SPACE_CHARS}]"
WORD_CHAR = r"[\p{L}\p{N}_]"
NON_WORD_CHAR = r"[^\p{L}\p{N}_]"
URL = rf"https?://{NON_SPACE}+|www\.{NON_SPACE}+"

STRUCTURAL = (
    "char_count",
    "word_count",
    "avg_word_len",
    "unique_word_ratio",
    "exclaim_count",
    "question_count",
    "hashtag_count",
    "mention_count",
    "url_count",
    "digit_count",
    "allcaps_word_count",
    "uppercase_ratio",
    "elongated_count",
)

# The seven columns of the exploratory correlation report.
EXPLORATORY = (
    "char_count",
    "word_count",
    "exclaim",
    "question",
    "mention",
    "hashtag",
    "uppercase",
)


def _col(c):
    return F.col(c) if isinstance(c, str) else c


@cache
def _unescape_udf():
    @F.pandas_udf("string")
    def unescape(texts: pd.Series) -> pd.Series:
        return texts.map(html.unescape, na_action="ignore")

    return unescape


def unescape_html(text):
    """Resolve HTML entities. Only texts holding ``&`` are sent to Python."""
    text = _col(text)
    return F.coalesce(_unescape_udf()(F.when(text.contains("&"), text)), text)


def normalise_text(text):
    """Cleaning steps after entity resolution; stays inside generated code."""
    text = F.lower(_col(text))
    text = F.regexp_replace(text, URL, " ")
    text = F.regexp_replace(text, f"@{WORD_CHAR}+", " ")
    text = F.regexp_replace(text, f"#({WORD_CHAR}+)", "$1")
    # Looking back after the literal lets the engine search for the literal first.
    text = F.regexp_replace(text, f"rt(?<!{WORD_CHAR}rt)(?!{WORD_CHAR})", " ")
    # Everything but a-z turns into a blank and blanks collapse: one pass does both.
    return F.trim(F.regexp_replace(text, "[^a-z]+", " "))


def clean_text(text):
    return normalise_text(unescape_html(text))


def clean_word_count(clean):
    """Number of words of an already cleaned text."""
    clean = _col(clean)
    blanks = F.length(clean) - F.length(F.replace(clean, F.lit(" "), F.lit("")))
    return F.when(clean == "", 0).otherwise(blanks + 1).cast("int")


def clean_tokens(clean):
    """Words of a cleaned text; empty array for the empty text."""
    clean = _col(clean)
    return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(clean, " "))


def count_char(text, char):
    text = _col(text)
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


@cache
def digit_class():
    """Regex class of every code point that ``str.isdigit`` accepts, derived from it."""
    ranges, start = [], None
    for cp in range(sys.maxunicode + 2):
        is_digit = cp <= sys.maxunicode and chr(cp).isdigit()
        if is_digit and start is None:
            start = cp
        elif not is_digit and start is not None:
            ranges.append((start, cp - 1))
            start = None
    return "[" + "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in ranges) + "]"


def single_spaced(text):
    """Words of a text with one blank between them."""
    return F.trim(F.regexp_replace(_col(text), f"[{SPACE_CHARS}]+", " "))


def structural_features(text, spaced=None):
    """The thirteen numbers describing a raw text, keyed by feature name.

    ``spaced`` names a column that already holds ``single_spaced(text)``.
    """
    text = _col(text)
    spaced = single_spaced(text) if spaced is None else _col(spaced)

    def count(pattern):
        return F.regexp_count(text, F.lit(pattern))

    def ratio(num, den):
        return F.coalesce(F.try_divide(num.cast("double"), den), F.lit(0.0))

    blanks = count_char(spaced, " ")
    words = F.when(spaced == "", 0).otherwise(blanks + 1)
    n_distinct = F.size(F.array_distinct(F.split(F.lower(spaced), " ")))
    n_distinct = F.when(spaced == "", 0).otherwise(n_distinct)
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    # Digits are rare: drop the other ASCII characters first, then test what is left.
    digits = F.regexp_replace(text, r"[\x00-\x2f\x3a-\x7f]+", "")
    capital_words = rf"(?:^|{NON_WORD_CHAR})[A-Z]{{2,}}+(?!{WORD_CHAR})"
    columns = (
        F.length(text),
        words,
        ratio(F.length(spaced) - blanks, words),
        ratio(n_distinct, words),
        count_char(text, "!"),
        count_char(text, "?"),
        count(f"#{WORD_CHAR}+"),
        count(f"@{WORD_CHAR}+"),
        count(URL),
        F.regexp_count(digits, F.lit(digit_class())),
        count(capital_words),
        ratio(count(r"\p{Lu}"), letters),
        # (?d): only \n ends a line, as for Python's dot.
        count(r"(?d)(.)\1{2,}"),
    )
    return {name: column.alias(name) for name, column in zip(STRUCTURAL, columns)}


def exploratory_features(text, word_count):
    """Feature columns of the exploratory report; ``word_count`` counts cleaned words."""
    text = _col(text)
    columns = (
        F.length(text),
        _col(word_count),
        count_char(text, "!"),
        count_char(text, "?"),
        count_char(text, "@"),
        count_char(text, "#"),
        F.length(F.regexp_replace(text, "[^A-Z]+", "")),
    )
    return {name: column.alias(name) for name, column in zip(EXPLORATORY, columns)}


def with_clean_text(df, text="text", drop_empty=True):
    """Add ``clean_text`` and ``clean_word_count``; rows cleaned to nothing are dropped.

    Dropping works by exploding a one-or-none element array: a filter on the cleaned text
    would be pushed below the projection and clean every text a second time.
    """
    kept = [c for c in df.columns if c not in ("clean_text", "clean_word_count")]
    cleaned = F.coalesce(clean_text(text), F.lit(""))
    if drop_empty:
        cleaned = F.explode(F.array_remove(F.array(cleaned), ""))
    out = df.select(*kept, cleaned.alias("clean_text"))
    return out.withColumn("clean_word_count", clean_word_count("clean_text"))


def with_structural_features(df, text="text"):
    spaced = df.withColumn("_spaced", single_spaced(text))
    return spaced.withColumns(structural_features(text, "_spaced")).drop("_spaced")
