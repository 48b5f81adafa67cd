"""Quality rules whose limits follow each language and source.

Counts are taken from the whole texts. Each share is put into a quantile sketch: counts by
logarithmic bin, so that any quantile is known within a fixed relative error and sketches merge
by adding counts. Limits come from the sketch of a row's language and source; a small group
uses the merged sketch of its language, then the one of all rows. Rows meet their limits by a
join.
"""

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.llm.common import id_and_text, stage, text_slices

#: Width of a bin of the sketch: quantiles are exact to 2 %.
GAMMA = 1.02
#: A group with fewer rows takes the limits of its language.
GROUP_ROWS = 50
#: A limit lies this many spreads (distance of quartile and median) beyond the quartile.
REACH = 6
#: Measures, as whole numbers, with the least spread that counts: per thousand, mean length in hundredths.
MEASURES = {"symbol_share": 20, "dup_line_share": 60, "repeat_share": 60, "mean_length": 100}

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\f\r"
FEATURES = "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long"
ARROW_FEATURES = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("source", pa.string())] + [(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")])


def counts_of(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines) of a text."""
    raw = text.encode()
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    seen = Counter(windows)
    repeated = 0
    if len(seen) < len(windows):
        until = 0  # first word not counted yet
        for at, window in enumerate(windows):
            if seen[window] > 1:
                repeated += at + 3 - max(at, until)
                until = at + 3
    return (
        len(words), len(text) - sum(text.count(c) for c in BLANKS), sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeated, len(lines),
    )


def features(docs):
    """Counts of each row's whole text; a null text counts as empty. Other columns are not read."""

    def run(batches):
        for batch in text_slices(batches):
            cells = zip(*map(counts_of, batch.column("text").to_pylist()))
            keys = [batch.column(c) for c in ("doc_id", "lang", "source")]
            yield pa.RecordBatch.from_arrays([*keys, *(pa.array(c, pa.int64()) for c in cells)], schema=ARROW_FEATURES)

    return id_and_text(docs, "lang", "source").mapInArrow(run, FEATURES)


def _share(part, whole, scale=1000):
    return F.when(F.col(whole) > 0, F.floor(F.col(part) * scale / F.col(whole))).otherwise(F.lit(0))


def measured(rows):
    """Feature rows with the base rule, the measures, and keys that hold a null apart from any text."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.select(
        "*",
        failed.alias("base_failed"),
        _share("n_symbols", "word_chars").alias("symbol_share"),
        _share("n_dup_lines", "n_lines").alias("dup_line_share"),
        _share("n_repeat_words", "n_words").alias("repeat_share"),
        _share("word_chars", "n_words", 100).alias("mean_length"),
        *(F.coalesce(F.concat(F.lit("="), c), F.lit("")).alias(f"{c}_key") for c in ("lang", "source")),
    )


def sketch(rows, *keys):
    """Counts by key, measure and bin: the mergeable sketch of each group."""
    cells = F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).alias("value")) for m in MEASURES))).alias("cell")
    value = F.col("cell.value")
    bin_ = F.when(value <= 0, F.lit(-1)).otherwise(F.ceil(F.log(value) / F.lit(math.log(GAMMA))))
    return rows.select(*keys, cells).select(*keys, "cell.measure", bin_.alias("bin")).groupBy(*keys, "measure", "bin").agg(F.count(F.lit(1)).alias("n"))


def merge(sketches, *keys):
    return sketches.groupBy(*keys, "measure", "bin").agg(F.sum("n").alias("n"))


def limits(sketches, *keys):
    """(keys, group_rows, limits) from sketches: a struct of an upper and a lower bound for each measure."""
    group = [*keys, "measure"]
    up_to = F.sum("n").over(W.partitionBy(*group).orderBy("bin").rowsBetween(W.unboundedPreceding, 0))
    ranked = sketches.withColumn("up_to", up_to).withColumn("rows", F.sum("n").over(W.partitionBy(*group)))
    value = F.when(F.col("bin") < 0, F.lit(0.0)).otherwise(F.pow(F.lit(GAMMA), F.col("bin")))
    at = {q: F.min(F.when(F.col("up_to") >= F.col("rows") * q, value)) for q in (0.25, 0.5, 0.75)}
    quartiles = ranked.groupBy(*group).agg(F.max("rows").alias("rows"), *(v.alias(f"q{int(100 * q)}") for q, v in at.items()))
    least = F.coalesce(*(F.when(F.col("measure") == m, F.lit(float(s))) for m, s in MEASURES.items()))
    upper = F.col("q75") + REACH * F.greatest(F.col("q75") - F.col("q50"), least)
    lower = F.col("q25") - REACH * F.greatest(F.col("q50") - F.col("q25"), least)
    bounds = quartiles.select(*keys, "measure", "rows", upper.alias("upper"), lower.alias("lower"))
    cells = [F.max(F.when(F.col("measure") == m, F.col(side))).alias(f"{m}_{side}") for m in MEASURES for side in ("upper", "lower")]
    names = [f"{m}_{side}" for m in MEASURES for side in ("upper", "lower")]
    return bounds.groupBy(*keys).agg(F.max("rows").alias("group_rows"), *cells).select(*keys, "group_rows", F.struct(*names).alias("limits"))


def judge_quality(docs, group_rows=GROUP_ROWS):
    """Counts, base_failed and kept for each row of ``docs``.

    Texts that fail the base rule go and do not shape the limits. The others stay while every
    measure lies within the limits of their group. Null language or source is a group of its
    own; repeated rows count each; no rows give no rows.
    """
    rows = measured(stage(features(docs), "quality-features"))
    fine = sketch(rows.filter(~F.col("base_failed")), "lang_key", "source_key")
    fine = stage(fine, "quality-sketch")
    by_source = limits(fine, "lang_key", "source_key").filter(F.col("group_rows") >= group_rows).select("lang_key", "source_key", F.col("limits").alias("source_limits"))
    by_lang = limits(merge(fine, "lang_key"), "lang_key").filter(F.col("group_rows") >= group_rows).select("lang_key", F.col("limits").alias("lang_limits"))
    overall = limits(merge(fine)).select("limits")
    joined = rows.join(by_source, ["lang_key", "source_key"], "left").join(by_lang, "lang_key", "left")
    bound = joined.withColumn("bound", F.coalesce("source_limits", "lang_limits", overall.scalar()))
    within = F.lit(True)
    for m in MEASURES:
        within = within & (F.col(m) <= F.col(f"bound.{m}_upper")) & (F.col(m) >= F.col(f"bound.{m}_lower"))
    kept = ~F.col("base_failed") & F.coalesce(within, F.lit(True))
    return bound.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))
