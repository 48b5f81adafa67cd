import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tagloom.llm import bpe, pii, quality_classifier, quality_rules, secret_scan

BYTE = public_tokenizers.path("byte_bpe_50k.json")
SOURCES = ["documents", "odd_docs", "no_docs"]


@pytest.fixture(params=SOURCES)
def docs(request):
    return request.getfixturevalue(request.param)


def rows_of(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def key(row):
    return tuple((v is not None, str(v)) for v in row)


def test_bpe_round_trip(docs):
    tokenizer = Tokenizer.from_file(BYTE)
    want = []
    for doc_id, text in rows_of(docs):
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    got = [tuple(r) for r in bpe.round_trip(docs, BYTE).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_decode_of_broken_ids(spark):
    tokenizer = Tokenizer.from_file(BYTE)
    half = tokenizer.encode("é語", add_special_tokens=False).ids[:1] + [250, 260, 50256]
    frame = spark.createDataFrame([(1, half), (2, []), (3, None), (4, [999_999, -1])], "k int, ids array<int>")
    got = {r.k: r.text for r in bpe.decode(frame, BYTE).collect()}
    assert got == {1: tokenizer.decode(half, skip_special_tokens=False), 2: "", 3: "", 4: ""}


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            odd = sum(map(int, digits[-1::-2])) + sum(sum(map(int, str(2 * int(d)))) for d in digits[-2::-2])
            fine = {
                "email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 13 <= len(digits) <= 19 and odd % 10 == 0, "phone": 9 <= len(digits) <= 15,
            }[kind]
            if fine:
                out.append((kind, *m.span()))
    return out


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="01259.@+-() aB_%\n", max_size=60))
def test_base_spans_equal_the_patterns(text):
    assert pii.base_spans(text) == plain_spans(text)


def test_personal_data(docs):
    rows = pii.personal_data(docs).collect()
    want = []
    for doc_id, text in rows_of(docs):
        spans = plain_spans(text)
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        want.append((doc_id, *(sum(s[0] == k for s in spans) for k in PATTERNS), digest))
        assert all(f"{k}:{a}:{b}" in ",".join(r.spans for r in rows) for k, a, b in spans)
    assert sorted((tuple(r)[:6] for r in rows), key=key) == sorted(want, key=key)


def test_model_adds_spans_that_patterns_miss(spark):
    texts = ["nothing 123 here", "call +49 (030) 123-4567 now", "pay 4111 1111 1111 1111 now", "at 10.1.2.3 now", "write a@b.org now", "pay 4012888888881881 now"] * 30
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    weights = pii.fit(docs)
    two_cards = "see 4111111111111111 5500005555555559 there"
    assert pii.base_spans(two_cards) == []
    assert pii.all_spans(two_cards, weights)[1] == [("card", 4, 20), ("card", 21, 37)]
    for clean in ("born 2024-03-12 at 10:30", "pages 12 13 14 15", "version 1.2.3 of 2019"):
        assert pii.all_spans(clean, weights)[1] == []
    masked = {r.doc_id: r.text for r in pii.mask(docs).collect()}
    assert masked[1] == "call [phone] now" and masked[0] == texts[0]


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    places = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:i] for i, x in enumerate(lines)), len(places)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab \n\t#é\x85\x0b", max_size=80))
def test_counts_of_texts(text):
    assert quality_rules.counts_of(text)[:5] == plain_counts(text)


def test_quality_rules(docs):
    got = sorted((tuple(r)[:7] for r in quality_rules.judge_quality(docs).collect()), key=key)
    want = []
    for doc_id, text in rows_of(docs):
        c = plain_counts(text)
        want.append((doc_id, *c, c[0] < 50 or 100 * c[4] > 50 * c[0]))
    assert got == sorted(want, key=key)


def test_limits_follow_their_group(spark):
    """Symbols are usual in one source and odd in the other; a small group uses its language."""
    plain = " ".join(f"w{i}" for i in range(60))
    marked = " ".join(f"w{i}*" for i in range(60))
    rows = [(i, plain, "en", "prose") for i in range(60)] + [(100 + i, marked, "en", "code") for i in range(60)]
    rows += [(200, marked, "en", "prose"), (201, plain, "en", "rare")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality_rules.judge_quality(docs).collect()}
    assert not kept[200] and kept[201] and all(kept[i] for i in range(60)) and all(kept[100 + i] for i in range(60))


def test_sketches_merge(documents):
    rows = quality_rules.measured(quality_rules.features(documents))
    whole = quality_rules.sketch(rows, "lang_key")
    merged = quality_rules.merge(quality_rules.sketch(rows, "lang_key", "source_key"), "lang_key")
    assert sorted(map(tuple, whole.select("lang_key", "measure", "bin", "n").collect())) == sorted(map(tuple, merged.select("lang_key", "measure", "bin", "n").collect()))


def test_quality_scores(spark, root, docs):
    labels = spark.read.parquet(f"{root}/labels.parquet")
    got = quality_classifier.classify(docs, labels).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in got) == sorted((d is not None, d or 0) for d, _ in rows_of(docs))
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)


def test_quality_accuracy_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_classifier.classify(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 80 and sum(r.predicted == r.quality for r in rows) >= 0.97 * len(rows)


def test_without_labels(spark, documents, root):
    none = spark.read.parquet(f"{root}/labels.parquet").limit(0)
    assert {r.score for r in quality_classifier.classify(documents, none).collect()} == {0.5}


def test_subword_buckets_are_the_words_own():
    words = ["a", "token", "tokens", "é" * 5]
    buckets, offsets = quality_classifier.subwords(words)
    for i, w in enumerate(words):
        alone, _ = quality_classifier.subwords([w])
        assert sorted(buckets[offsets[i] : offsets[i + 1]]) == sorted(alone)
        size = len(w.encode()) + 2
        assert len(alone) == 1 + sum(max(0, size - n + 1) for n in quality_classifier.NGRAMS)


def test_secrets(docs):
    rows = secret_scan.scan(docs).collect()
    want = [(d, len(re.findall(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{16,}", t))) for d, t in rows_of(docs)]
    assert sorted(((r.doc_id, r.n_candidates) for r in rows), key=key) == sorted(want, key=key)
    assert all(set(r.secrets.split(",")) <= set(r.candidates.split(",")) | {""} for r in rows)


def test_forest_on_rows_it_has_not_seen(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    table = secret_scan.dictionary(docs)
    forest = secret_scan.fit(docs.filter("doc_id % 2 = 0"), table)
    right = total = 0
    for r in docs.filter("doc_id % 2 = 1").collect():
        for a, b in secret_scan.findings(r.text):
            total += 1
            right += (secret_scan.vote(forest, secret_scan.features(r.text, a, b, r.source, table)) >= 0.5) == bool(secret_scan.rule_label(r.text, a, b))
    assert total > 50 and right >= 0.97 * total


def test_forest_from_reviewed_findings(spark):
    texts = [f"token = \"{i:040x}\" and thisisanordinarylongword" for i in range(1000, 1040)]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    marks = [(i, a, b, int(n == 0)) for i, t in enumerate(texts) for n, (a, b) in enumerate(secret_scan.findings(t))]
    labelled = spark.createDataFrame(marks, "doc_id long, start long, end long, label int")
    table = secret_scan.dictionary(docs)
    forest = secret_scan.fit(docs, table, labelled=labelled)
    votes = [[secret_scan.vote(forest, secret_scan.features(t, a, b, "s", table)) >= 0.5 for a, b in secret_scan.findings(t)] for t in texts]
    assert all(v == [True, False] for v in votes)


def test_letter_counts_cover_all_texts(documents):
    text = " ".join(t for _, t in rows_of(documents)).lower()
    want = Counter(text[i : i + 3] for i in range(len(text) - 2) if re.fullmatch("[a-z]{3}", text[i : i + 3]))
    got = {r.code: r.n for r in secret_scan.letter_counts(documents).groupBy("code").agg(F.sum("n").alias("n")).collect()}
    code = lambda w: ((ord(w[0]) - 97) * 26 + ord(w[1]) - 97) * 26 + ord(w[2]) - 97
    assert {code(w): n for w, n in want.items()} == got and np.isfinite(secret_scan.dictionary(documents)).all()


def test_assigned_values_are_candidates_and_secrets(spark):
    """key=value, env line, query string, padding and short quoted values: the value alone, labelled and voted a secret."""
    values = [hashlib.sha256(str(i).encode()).hexdigest()[:32] for i in range(30)]
    forms = [lambda v: (f"set API_KEY={v} now", v), lambda v: (f"export token={v}\n", v), lambda v: (f"GET https://h.org/p?access_token={v}&x=1", v)]
    forms += [lambda v: (f"secret = {v}==", v + "=="), lambda v: (f'password = "{v[:5]}!{v[5:9]}"', f"{v[:5]}!{v[5:9]}")]
    cases = [(f(v), 1) for v in values for f in forms] + [((f"the {'abcdefghij'[i % 10] * 3}ordinarylongcompoundword here", None), 0) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "s") for i, ((t, _), _) in enumerate(cases)], "doc_id long, text string, source string")
    got = {r.doc_id: r.secrets for r in secret_scan.scan(docs).collect()}
    for i, ((text, value), label) in enumerate(cases):
        spans = secret_scan.findings(text)
        assert len(spans) == 1 and secret_scan.rule_label(text, *spans[0]) == label
        assert not value or text[slice(*spans[0])] == value
        assert got[i] == (f"{spans[0][0]}:{spans[0][1]}" if label else "")


def secrets_of(spark, texts):
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    return docs, {r.doc_id: r.n_secrets for r in secret_scan.scan(docs).collect()}


def test_rare_secrets_among_copies_are_learned(spark):
    """A few secrets between many copies of one text and more other findings than the sample holds."""
    digest = lambda i: hashlib.sha256(str(i).encode()).hexdigest()[:40]
    secrets = [f'token = "{digest(i)}"' for i in range(4)]
    texts = ["one ordinarylongcompoundword again"] * 6000 + [f"see {digest(i)}{'ghi'[i % 3] * (i % 50)} there" for i in range(6000)] + secrets
    docs, got = secrets_of(spark, texts)
    assert [got[len(texts) - 4 + i] for i in range(4)] == [1] * 4
    assert sum(got.values()) <= 4 + 60
    found = secret_scan.distinct_findings(docs, secret_scan.dictionary(docs))
    kept = [r.label for r in secret_scan.sampled_findings(found).collect()]
    assert found.count() == found.distinct().count() and sum(kept) == 4 and len(kept) <= secret_scan.SAMPLE_FINDINGS // 2 + 4


def test_findings_of_one_label(spark):
    digests = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(9)]
    assert set(secrets_of(spark, [f"see {d} there" for d in digests])[1].values()) == {0}
    assert set(secrets_of(spark, [f"token = {d}" for d in digests])[1].values()) == {1}
    assert set(secrets_of(spark, ["no finding", None])[1].values()) == {0}


def test_personal_data_behind_many_numbers_is_learned(spark):
    """Low ids hold only numbers, and copies of one text; cards come last."""
    gap = " " + "some words without any of them " * 4
    texts = [gap.join(f"row {100 * i + k} of it" for k in range(10)) for i in range(80)] + ["write a@b.org now"] * 300
    texts += [f"pay {card} now {'abc'[i % 3] * i}" for i, card in enumerate(["4111 1111 1111 1111", "4012888888881881", "5500-0055-5555-5559"] * 10)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert pii.all_spans("see 4111111111111111 5500005555555559 there", pii.fit(docs))[1] == [("card", 4, 20), ("card", 21, 37)]
    drawn = [tuple(r) for r in pii.sampled_stretches(docs, 20).collect()]
    assert len(drawn) == len(set(drawn)) and Counter(k for k, _ in drawn) == {"": 20, "card": 20, "email": 1}
    assert sorted(drawn) == sorted(tuple(r) for r in pii.sampled_stretches(docs.repartition(7), 20).collect())
    assert pii.fit(docs.filter("text not like '%@%' and text not like 'pay%'")) is None
