"""Vocabularies, encoding and TF-IDF against plain Python."""

import math
import random
from collections import Counter

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tagloom.operators import terms

STOPS = ["the", "of"]


@pytest.fixture(scope="module")
def corpus(spark):
    """Texts over a small alphabet of words; one word makes up a third of everything."""
    rng = random.Random(5)
    words = ["aa", "bb", "cc", "dd", "ee", "x", "the", "of", "zeta"]
    texts = [
        " ".join("hot" if rng.random() < 0.33 else rng.choice(words) for _ in range(rng.randrange(1, 60)))
        for _ in range(300)
    ] + [""]
    df = spark.createDataFrame(
        [(i, i % 3, t) for i, t in enumerate(texts)], "tweet_id long, class_id int, clean_text string"
    )
    return texts, df.repartition(6).persist()


def python_terms(text):
    words = [w for w in text.split() if len(w) > 1 and w not in STOPS]
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def test_term_statistics(corpus):
    texts, df = corpus
    tf, seen = Counter(), Counter()
    for t in texts:
        tf.update(python_terms(t))
        seen.update(set(python_terms(t)))
    rows = terms.term_statistics(terms.with_terms(df, stop_words=STOPS)).collect()
    assert {r["term"]: (r["tf"], r["df"]) for r in rows} == {t: (tf[t], seen[t]) for t in tf}
    kept = terms.select_terms(terms.term_statistics(terms.with_terms(df, stop_words=STOPS)), 5, 12).collect()
    want = sorted(sorted((t for t in tf if seen[t] >= 5), key=lambda t: (-tf[t], t))[:12])
    assert [r["term"] for r in sorted(kept, key=lambda r: r["term_no"])] == want


def test_tfidf_weights(corpus):
    texts, df = corpus
    model = terms.TfIdf.fit(df, min_df=5, max_features=12, stop_words=STOPS)
    seen = Counter(t for text in texts for t in set(python_terms(text)))
    idf = {t: math.log((1 + len(texts)) / (1 + seen[t])) + 1 for t in model.terms}
    assert model.idf == pytest.approx([idf[t] for t in model.terms])
    want = {}
    for i, text in enumerate(texts):
        counts = Counter(t for t in python_terms(text) if t in idf)
        raw = {t: (1 + math.log(n)) * idf[t] for t, n in counts.items()}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        want.update({(i, t): w / norm for t, w in raw.items()})
    got = {(r["tweet_id"], r["term"]): r["weight"] for r in model.weights(df).collect()}
    assert got == pytest.approx(want)
    norms = model.transform(df).select(
        F.aggregate(vector_to_array("tfidf"), F.lit(0.0), lambda a, x: a + x * x).alias("n")
    )
    assert all(r["n"] == pytest.approx(1.0) or r["n"] == 0.0 for r in norms.collect())


def test_vocabulary_and_encoding(corpus):
    texts, df = corpus
    counts = Counter(w for t in texts for w in t.split())
    order = sorted(counts, key=lambda w: (-counts[w], w))[:6]
    vocabulary = terms.build_vocabulary(df, max_size=6)
    ids = {r["token"]: r["token_id"] for r in vocabulary.collect()}
    assert ids == {w: i + 2 for i, w in enumerate(order)}
    got = {r["tweet_id"]: r["ids"] for r in terms.encode(df, vocabulary, 20).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        want = [ids.get(w, 1) for w in text.split()][:20]
        assert got[i] == want + [0] * (20 - len(want))
    longest = terms.max_token_length(df).first()["max_len"]
    assert longest == max(len(t.split()) for t in texts)


def test_top_tokens(corpus):
    texts, df = corpus
    got = terms.top_tokens(df, k=3).collect()
    for c in range(3):
        counts = Counter(w for i, t in enumerate(texts) if i % 3 == c for w in t.split()
                         if len(w) > 2 and w not in terms.REPORT_STOP_WORDS)
        want = sorted(counts, key=lambda w: (-counts[w], w))[:3]
        assert [r["token"] for r in sorted(got, key=lambda r: r["rank"]) if r["class_id"] == c] == want


def test_statistics_use_one_shuffle(corpus):
    from plans import plan_of

    plan = plan_of(terms.term_statistics(terms.with_terms(corpus[1])))
    above_cache = plan.split("InMemoryTableScan")[0]
    assert above_cache.count("Exchange hashpartitioning(term") == 1
    assert above_cache.count("Exchange") == 1


def test_statistics_meet_as_distinct_terms_of_batches(spark):
    """No row for each occurrence; null arrays, empty arrays and null terms count as in an explode."""
    from plans import plan_of

    rows = [(["a", "b", "a"],), (None,), ([],), (["b", None, None],)]
    got = terms.term_statistics(spark.createDataFrame(rows, "terms array<string>").coalesce(1))
    assert {r["term"]: (r["tf"], r["df"]) for r in got.collect()} == {"a": (2, 1), "b": (2, 2), None: (2, 1)}
    plan = plan_of(got)
    assert "MapInArrow" in plan and "Generate" not in plan


def test_stop_words_are_sparks(spark):
    from pyspark.ml.feature import StopWordsRemover

    words = StopWordsRemover.loadDefaultStopWords("english")
    pieces = {p for w in words for p in w.lower().replace("'", " ").split()}
    assert pieces == set(terms.ENGLISH_STOP_WORDS)


def test_embedding_matrix(spark, corpus):
    from pyspark.ml.linalg import Vectors

    vocabulary = spark.createDataFrame([("aa", 2), ("qq", 3)], "token string, token_id int")
    vectors = spark.createDataFrame([("aa", Vectors.dense([1.0, 2.0]))], ["word", "vector"])
    got = {r["token"]: (r["hit"], r["vector"]) for r in terms.embedding_matrix(vocabulary, vectors, 2).collect()}
    assert got == {"aa": (True, [1.0, 2.0]), "qq": (False, [0.0, 0.0])}
