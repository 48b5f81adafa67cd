"""Cleaning and structural features against plain Python definitions."""

import html
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tagloom.functions.text import (
    STRUCTURAL,
    clean_text,
    clean_word_count,
    with_clean_text,
    with_structural_features,
)

TRICKY = [
    "",
    "   ",
    "RT @bob: HELLO!!! soooo #tag1 #2 http://x.y/z?q=1 www.a.b &amp; &#128514;",
    "KK İstanbul ı",
    "ABCÉ ABC_ ABC1 AB CD EF, GH",
    "x² ①② Ⅳ ⁰ ٣٤",
    "a b c\u001cd\u0085e f",
    "line\none\r\nline\rtwo\n\n\n\n end",
    "#日本語 #a_b @жз @ # ##x @@y",
    "µrt ért rt rt rt art rtx RT rt_ _rt rt!",
    "éé café ́́́",
    "\U0001f602\U0001f602\U0001f602 ok \U0001f602",
    "\U00010400AB AB\U00010400 \U0001d400CD",
    "&lt;b&gt; &notit; &eacute; &amp;lt; &#x41; &bogus; & &",
    "trailing   ",
    "http://a.b c https://x www. www.q",
    "AAaa aaa!!! ??? ---- \t\t\t",
    "ǅ ΣΑΣ ß ﬁ",
]


def python_clean(text):
    text = html.unescape(text).lower()
    for pattern, to in (
        (r"https?://\S+|www\.\S+", " "),
        (r"@\w+", " "),
        (r"#(\w+)", r"\g<1>"),
        (r"\brt\b", " "),
    ):
        text = re.sub(pattern, to, text)
    return " ".join("".join(c if "a" <= c <= "z" else " " for c in text).split())


def python_features(text):
    words, letters = text.split(), [c for c in text if c.isalpha()]
    share = lambda a, b: a / b if b else 0.0
    runs = re.findall(r"((.)\2{2,})", text)
    return (
        len(text),
        len(words),
        share(sum(map(len, words)), len(words)),
        share(len({w.lower() for w in words}), len(words)),
        text.count("!"),
        text.count("?"),
        len(re.findall(r"#\w+", text)),
        len(re.findall(r"@\w+", text)),
        len(re.findall(r"https?://\S+|www\.\S+", text)),
        sum(map(str.isdigit, text)),
        len(re.findall(r"\b[A-Z]{2,}\b", text)),
        share(sum(map(str.isupper, letters)), len(letters)),
        len(runs),
    )


@pytest.fixture(scope="module")
def texts(root):
    con = duckdb.connect()
    out = list(TRICKY)
    for table, column in (("documents", "text"), ("conversations", "text"), ("pages", "html")):
        out += [r[0] for r in con.execute(f"SELECT {column} FROM '{root}/{table}.parquet'").fetchall()]
    return out


@pytest.fixture(scope="module")
def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(8).persist()


def test_clean_text(frame, texts):
    rows = frame.select("id", clean_text("text").alias("c")).collect()
    wrong = [(texts[r["id"]][:80], r["c"][:80]) for r in rows if r["c"] != python_clean(texts[r["id"]])]
    assert wrong == []


def test_structural_features(frame, texts):
    rows = with_structural_features(frame).select("id", *STRUCTURAL).collect()
    wrong = []
    for r in rows:
        for name, got, want in zip(STRUCTURAL, r[1:], python_features(texts[r["id"]])):
            if got != pytest.approx(want, abs=1e-12):
                wrong.append((name, texts[r["id"]][:60], got, want))
    assert wrong == []


def test_every_unicode_block(spark):
    """One text per 64 code points, so every character class is met."""
    chunks = [
        "".join(chr(c) + " " for c in range(start, start + 64) if not 0xD800 <= c <= 0xDFFF)
        for start in range(0, 0x3000, 64)
    ]
    df = spark.createDataFrame(list(enumerate(chunks)), "id long, text string")
    names = ["char_count", "word_count", "exclaim_count", "digit_count"]
    for r in with_structural_features(df).select("id", *names).collect():
        want = dict(zip(STRUCTURAL, python_features(chunks[r["id"]])))
        assert [r[n] for n in names] == [want[n] for n in names]


def test_empty_texts_are_dropped(spark):
    df = spark.createDataFrame([(1, "!!!"), (2, "ok then"), (3, "rt @x"), (4, None)], "id int, text string")
    rows = with_clean_text(df).collect()
    assert [(r["id"], r["clean_text"], r["clean_word_count"]) for r in rows] == [(2, "ok then", 2)]
    kept = with_clean_text(df, drop_empty=False)
    assert kept.count() == 4
    assert kept.agg(F.sum(clean_word_count("clean_text"))).first()[0] == 2


def test_text_is_cleaned_once(spark, root):
    """The drop of empty texts must not run the cleaning expressions a second time."""
    from plans import plan_of
    from tagloom.sources import driver_tables as src

    plan = plan_of(with_clean_text(src.documents(spark, root)))
    assert plan.count("ArrowEvalPython") == 1
    assert plan.count("rt(?<!") == 1
