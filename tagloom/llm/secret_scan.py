"""Secret scan: candidate strings, and a random forest that removes the false positives.

A candidate is a run of at least 16 key characters, in which ``=`` is only padding at the end, or
a shorter value that is assigned to a name with a credential word. Its features are its length, its character classes and
transitions, how far common letter sequences of the corpus cover it (the dictionary), the path
or source of its row, and the words next to it. The forest is trained here on labelled findings
and votes on every candidate of every whole text.
"""

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tagloom.llm.common import id_and_text, stage, text_slices

CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:={1,2}(?![A-Za-z0-9+/=_-]))?")
#: An assignment sign and the value behind it, quoted or up to a sign that ends a value.
ASSIGNED = re.compile(r"""[=:]>?[ \t]{0,3}(?:(["'])([^"'\s]{6,200})\1|([^\s"'&;,<>(){}\[\]=:][^\s"'&;,<>(){}\[\]]{5,199}))""")
NAME = re.compile(r"""([A-Za-z][A-Za-z0-9_-]*)["']?[ \t:]{0,3}\Z""")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
BEFORE, BEHIND = 48, 16
#: Words that name credentials.
CREDENTIAL_WORDS = frozenset(("token", "secret", "password", "passwd", "pwd", "key", "apikey", "api_key", "credential", "credentials", "auth", "bearer", "private", "access"))
PLACEHOLDERS = frozenset(("example", "sample", "dummy", "placeholder", "test", "your", "xxx", "changeme", "fake"))
#: Most labelled findings used for training; half for each label.
SAMPLE_FINDINGS = 5000
TREES, DEPTH, LEAST_LEAF = 31, 8, 3

LETTERS = 26
WORD = re.compile(r"[A-Za-z_]+")
ASSIGN_SIGNS = ("=", ":", "=>")


def letter_counts(docs):
    """Counts of three-letter sequences over all texts: at most 26 ** 3 rows."""

    def run(batches):
        total = np.zeros(LETTERS**3, dtype=np.int64)
        for batch in text_slices(batches):
            column = batch.column("text")
            raw = np.frombuffer(" ".join(column.to_pylist()).encode(), dtype=np.uint8) | 32
            letters = raw.astype(np.int32) - 97
            fine = (letters >= 0) & (letters < LETTERS)
            if len(raw) > 2:
                inside = fine[:-2] & fine[1:-1] & fine[2:]
                codes = (letters[:-2] * LETTERS + letters[1:-1]) * LETTERS + letters[2:]
                total += np.bincount(codes[inside], minlength=LETTERS**3)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"code": pa.array(found, pa.int64()), "n": pa.array(total[found], pa.int64())})

    return id_and_text(docs).select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def dictionary(docs):
    """log probability of the third letter behind two others, as one bounded array."""
    counts = np.zeros(LETTERS**3)
    for row in letter_counts(docs).collect():  # at most 17,576 rows
        counts[row.code] = row.n
    pairs = counts.reshape(-1, LETTERS)
    return np.log((pairs + 0.1) / (pairs.sum(axis=1, keepdims=True) + 0.1 * LETTERS)).ravel()


FEATURES = (
    "length", "distinct share", "entropy", "digit share", "upper share", "letter share", "hex only", "class changes", "letter-digit changes", "covered share",
    "mean transition", "longest letters", "symbol share", "path depth", "path name", "credential word", "assigned", "quoted", "placeholder", "words near", "repeated",
)


def is_credential(word):
    """Whether a word, or a part of a name like ``access_token`` or ``apiKey``, names a credential."""
    return word.lower() in CREDENTIAL_WORDS or any(p.lower() in CREDENTIAL_WORDS for p in NAME_PARTS.findall(word))


def _kind(c):
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def features(text, start, end, path, table):
    """Features of the candidate ``text[start:end]`` in a row of the given path or source."""
    own = text[start:end]
    size = end - start
    kinds = [_kind(c) for c in own]
    counts = [own.count(c) for c in set(own)]
    entropy = -sum(n / size * math.log2(n / size) for n in counts)
    letters = np.frombuffer(own.lower().encode(), dtype=np.uint8).astype(np.int64) - 97
    fine = (letters >= 0) & (letters < LETTERS)
    codes = (letters[:-2] * LETTERS + letters[1:-1]) * LETTERS + letters[2:]
    known = table[codes[fine[:-2] & fine[1:-1] & fine[2:]]]
    before, behind = text[max(0, start - BEFORE) : start], text[end : end + BEHIND]
    named = any(map(is_credential, WORD.findall(before)[-3:]))
    words = [w.lower() for w in WORD.findall(before)[-3:]]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:]))
    mixed = sum((a == 0) != (b == 0) for a, b in zip(kinds, kinds[1:]))
    runs = [len(r) for r in re.findall("[A-Za-z]+", own)]
    path = path or ""
    return [
        size, len(counts) / size, entropy, kinds.count(0) / size, kinds.count(2) / size, (kinds.count(1) + kinds.count(2)) / size, float(not own.lower().strip("0123456789abcdef")),
        changes / size, mixed / size, float((known > -3.5).sum()) / size, float(known.mean()) if len(known) else -6.0, max(runs, default=0) / size, kinds.count(3) / size,
        path.count("/"), (sum(path.encode()) % 97) / 97, float(named), float(before.rstrip(" \t\"'").endswith(ASSIGN_SIGNS)),
        float(before[-1:] in "\"'" and before != ""), float(any(w in own.lower() or w in words for w in PLACEHOLDERS)), len(words) + len(WORD.findall(behind)), max(counts) / size,
    ]


def findings(text):
    """Spans of the candidates of a text, in order; none overlap.

    A value assigned to a credential name is a candidate from 6 characters on. If it is quoted, it
    is taken whole and stands for the runs inside it; otherwise the runs stay and it is left out.
    """
    runs = [m.span() for m in CANDIDATE.finditer(text)]
    out, at = [], 0
    for m in ASSIGNED.finditer(text):
        name = NAME.search(text, max(0, m.start() - BEFORE), m.start())
        if name is None or not is_credential(name[1]):
            continue
        a, b = m.span(2 if m[1] else 3)
        while at < len(runs) and runs[at][1] <= a:
            out.append(runs[at])
            at += 1
        until = at
        while until < len(runs) and runs[until][0] < b:
            until += 1
        if until == at or (m[1] and a <= runs[at][0] and runs[until - 1][1] <= b):
            out.append((a, b))
            at = until
    return out + runs[at:]


def rule_label(text, start, end):
    """Label of a finding by review rule: a credential is named and assigned, and the value is no placeholder.

    Stands in for a table of reviewed findings; ``fit`` takes such a table as well.
    """
    before = text[max(0, start - BEFORE) : start].rstrip(" \t\"'")
    own = text[start:end].lower()
    digits = sum(c.isdigit() for c in own)
    return int(before.endswith(ASSIGN_SIGNS) and any(map(is_credential, WORD.findall(before)[-3:])) and digits > 1 and not any(w in own for w in PLACEHOLDERS))


def grow(rows, labels, rng, depth=DEPTH):
    """One tree on a bootstrap sample: nested (feature, cut, low, high) or a leaf's share of secrets."""
    share = float(labels.mean())
    if depth == 0 or len(labels) < 2 * LEAST_LEAF or share in (0.0, 1.0):
        return share
    best = (share * (1 - share) - 1e-9, None, None)
    for feature in rng.permutation(rows.shape[1])[: max(2, round(rows.shape[1] ** 0.5))]:
        order = np.argsort(rows[:, feature], kind="stable")
        values, sums = rows[order, feature], np.cumsum(labels[order])
        sizes = np.arange(1, len(labels) + 1)
        cuts = np.flatnonzero(values[1:] > values[:-1])
        cuts = cuts[(cuts + 1 >= LEAST_LEAF) & (len(labels) - cuts - 1 >= LEAST_LEAF)]
        if not len(cuts):
            continue
        low, high = sums[cuts] / sizes[cuts], (sums[-1] - sums[cuts]) / (len(labels) - sizes[cuts])
        weight = sizes[cuts] / len(labels)
        impurity = weight * low * (1 - low) + (1 - weight) * high * (1 - high)
        at = int(impurity.argmin())
        if impurity[at] < best[0]:
            best = (float(impurity[at]), int(feature), float((values[cuts[at]] + values[cuts[at] + 1]) / 2))
    if best[1] is None:
        return share
    low = rows[:, best[1]] <= best[2]
    return (best[1], best[2], grow(rows[low], labels[low], rng, depth - 1), grow(rows[~low], labels[~low], rng, depth - 1))


def train(rows, labels, seed=3):
    """A forest of TREES trees, each on a bootstrap sample with as many rows of either label.

    So few secrets weigh as much as many other findings. If one label does not occur, every tree
    is the leaf of the other.
    """
    rng = np.random.default_rng(seed)
    sides = [side for side in (np.flatnonzero(labels == 0), np.flatnonzero(labels != 0)) if len(side)]
    forest = []
    for _ in range(TREES):
        drawn = np.concatenate([side[rng.integers(0, len(side), -(-len(labels) // len(sides)))] for side in sides])
        forest.append(grow(rows[drawn], labels[drawn], rng))
    return forest


def vote(forest, row):
    """Mean share of secrets in the leaves that a candidate reaches."""
    total = 0.0
    for node in forest:
        while not isinstance(node, float):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        total += node
    return total / len(forest)


def _to_list(node):
    return node if isinstance(node, float) else [node[0], node[1], _to_list(node[2]), _to_list(node[3])]


def distinct_findings(docs, table, labelled=None):
    """(features, label) of the findings of all ``docs``, equal ones once, stored."""
    rows = id_and_text(docs, F.col("source").cast("string").alias("source"))
    if labelled is not None:
        marks = labelled.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end", "label")).alias("marks"))
        rows = rows.join(marks, "doc_id")
    else:
        rows = rows.filter(F.col("text").rlike("[A-Za-z0-9+/_-]{16}|[=:]")).withColumn("marks", F.lit(None).cast("array<struct<start:long,end:long,label:int>>"))

    def run(batches):
        for batch in text_slices(batches):
            out = {"features": [], "label": []}
            for text, path, marks in zip(batch.column("text").to_pylist(), batch.column("source").to_pylist(), batch.column("marks").to_pylist()):
                found = [(m["start"], m["end"], m["label"]) for m in marks] if marks is not None else [(a, b, rule_label(text, a, b)) for a, b in findings(text)]
                for a, b, label in found:
                    out["features"].append(features(text, a, b, path, table))
                    out["label"].append(label)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("features", pa.list_(pa.float64())), ("label", pa.int32())]))

    found = rows.select("text", "source", "marks").mapInArrow(run, "features array<double>, label int")
    return stage(found.distinct(), "secret-findings")


def sampled_findings(found, limit=SAMPLE_FINDINGS):
    """Of each label the ``limit // 2`` findings with the smallest hashes."""
    by_hash = [F.xxhash64("features"), F.col("features")]
    sides = [found.filter(side).orderBy(*by_hash).limit(limit // 2) for side in (F.col("label") == 0, F.col("label") != 0)]
    return sides[0].unionByName(sides[1])


def fit(docs, table, labelled=None):
    """A forest trained in one task on at most SAMPLE_FINDINGS distinct findings of all ``docs``.

    ``labelled`` is a table (doc_id, start, end, label) of reviewed findings; without it all
    findings of all rows are labelled by ``rule_label``. None if there is no finding at all; if all
    findings have one label, the forest gives this label to every candidate.
    """
    import json

    def learn(frame):
        import pandas as pd

        matrix, labels = np.array(frame["features"].tolist(), dtype=float), frame["label"].to_numpy(dtype=float)
        order = np.lexsort((*matrix.T, labels))  # the same forest whatever the order of arrival
        return pd.DataFrame({"forest": [json.dumps([_to_list(t) for t in train(matrix[order], labels[order])])]})

    found = sampled_findings(distinct_findings(docs, table, labelled))
    row = found.groupBy(F.lit(0).alias("all")).applyInPandas(learn, "forest string").first()
    return None if row is None else json.loads(row[0])


def scan(docs):
    """doc_id, n_candidates, n_secrets, candidates, secrets (``start:end`` in code points) of each row.

    Every candidate of the whole text is judged; a secret has a vote of at least one half. A
    null text is empty. If the review rule labels no finding of all rows a secret, there is none;
    if it labels all so, all are.
    """
    table = dictionary(docs)
    forest = fit(docs, table)

    def run(batches):
        for batch in text_slices(batches):
            all_, kept = [], []
            for text, path in zip(batch.column("text").to_pylist(), batch.column("source").to_pylist()):
                spans = findings(text)
                all_.append(spans)
                kept.append([s for s in spans if forest is None or vote(forest, features(text, *s, path, table)) >= 0.5])
            texts = [[",".join(f"{a}:{b}" for a, b in s) for s in x] for x in (all_, kept)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(map(len, all_), pa.int64()), pa.array(map(len, kept), pa.int64()), *(pa.array(t, pa.string()) for t in texts)], names=["doc_id", "n_candidates", "n_secrets", "candidates", "secrets"])

    rows = id_and_text(docs, F.col("source").cast("string").alias("source"))
    return rows.mapInArrow(run, "doc_id long, n_candidates long, n_secrets long, candidates string, secrets string")
