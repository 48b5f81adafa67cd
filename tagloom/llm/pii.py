"""Personal data in texts: fixed base patterns, and further spans by a semi-Markov random field.

The model scores whole candidate segments of up to MAX_TOKENS tokens by features of the segment
(digits, groups, checksum, signs, words before) and of its borders. Dynamic programming over the
tokens of a stretch around digits and at-signs chooses boundaries and kinds together. Weights
come from maximum likelihood, trained on a bounded sample in which the base patterns, also in
variants that these patterns miss, are the wanted segments. The sample is of stretches of all rows,
drawn by hash for each kind and for stretches without personal data.
"""

import heapq
import random
import re
import zlib
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tagloom.llm.common import id_and_text, stage, text_slices

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS = 24
REACH = 48  # characters of a stretch on either side of a digit or at-sign
#: Bound of the training sample: distinct stretches for each kind, and as many without personal data.
SAMPLE_STRETCHES = 80
#: The longest stretch used for training, in characters.
LONGEST_STRETCH = 1000
EPOCHS = 8
#: Least score over "no personal data" of a span that is added.
MARGIN = 1.0

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]+")
TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|[^A-Za-z0-9]")
CUES = (
    frozenset(("tel", "phone", "telefon", "fon", "fax", "mobile", "mobil", "call", "cell", "teléfono", "téléphone")),
    frozenset(("mail", "email", "e-mail", "correo", "courriel", "contact", "kontakt")),
    frozenset(("card", "visa", "mastercard", "karte", "tarjeta", "carte")),
    frozenset(("ip", "host", "server", "address", "adresse")),
)


def luhn(digits):
    total = 0
    for at, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if at % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def digits_of(text):
    return [c for c in text if "0" <= c <= "9"]


def emails(text):
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            out.append((start, free))
        at = text.find("@", max(at + 1, free))
    return out


def small_number(part):
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and int(part) <= 255)


def ips(text):
    out = []
    for run in NUMBERS.finditer(text):
        parts = run[0].split(".")
        at = run.start()
        for four in range(0, len(parts) - 3, 4):
            group = parts[four : four + 4]
            end = at + sum(map(len, group)) + 3
            if all(map(small_number, group)):
                out.append((at, end))
            at = end + 1
    return out


def cards(text):
    found = ((m.span(), digits_of(m[0])) for m in CARD.finditer(text) if 13 <= len(m[0]) <= 40)
    return [span for span, d in found if 13 <= len(d) <= 19 and luhn(d)]


def phones(text):
    return [m.span() for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]


FINDERS = dict(zip(KINDS, (emails, ips, cards, phones)))


def base_spans(text):
    """(kind, start, end) of the base patterns, by kind, then start."""
    return [(kind, *span) for kind, find in FINDERS.items() for span in find(text)]


def stretches(text):
    """Parts of a text around digits and at-signs, as (start, end); near ones are one."""
    out = []
    for m in TRIGGER.finditer(text):
        start, end = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if out and start <= out[-1][1]:
            out[-1][1] = end
        else:
            out.append([start, end])
    return out


FEATURES = (
    "bias", "digits<7", "digits7-8", "digits9-12", "digits13-15", "digits16-19", "digits>19", "one @", "@ then dot", "letters", "plus", "parenthesis",
    "one group", "two groups", "groups>2", "only digits", "only numbers", "four small", "checksum", "fours", "word before", "word behind", "sign before", "sign behind",
    "cue phone", "cue mail", "cue card", "cue ip", "colon or slash", "hyphens", "leading zero", "other sign",
)


def features(text, start, end, before):
    """Indices of the features of the segment ``text[start:end]``; ``before`` is the word before it."""
    span = text[start:end]
    groups = re.findall(r"[0-9]+", span)
    count = sum(map(len, groups))
    letters, at = any(c.isalpha() for c in span), span.count("@")
    numeric = not letters and not at
    left, right = text[start - 1 : start], text[end : end + 1]
    on = [
        True, count < 7, 7 <= count <= 8, 9 <= count <= 12, 13 <= count <= 15, 16 <= count <= 19, count > 19, at == 1 and span[0] != "@" and span[-1] != "@",
        at == 1 and "." in span.split("@")[-1].strip("."), letters, numeric and span[0] == "+", numeric and "(" in span and ")" in span,
        numeric and len(groups) == 1, numeric and len(groups) == 2, numeric and len(groups) > 2, span.isdigit(), numeric,
        len(groups) == 4 and numeric and span.count(".") == 3 and len(span) == count + 3 and all(map(small_number, groups)),
        numeric and 13 <= count <= 19 and luhn(digits_of(span)), numeric and len(groups) > 2 and all(len(g) == 4 for g in groups),
        left.isalnum(), right.isalnum(), left in ("@", ".", "-", "+", "_", "%", "/", ",", ":") and left != "",
        right in ("@", "-", "_", "/", "%") and right != "" or (right == "." and text[end + 1 : end + 2].isalnum()),
        *(before in cue for cue in CUES), ":" in span or "/" in span, numeric and span.count("-") > 1 and "(" not in span, span[0] == "0",
        any(not (c.isalnum() or c in "@._%+-() ") for c in span),
    ]
    return [i for i, x in enumerate(on) if x]


def candidates(text, start, end):
    """Token ends of a stretch and its candidate segments: (first token, token behind, features)."""
    tokens = [(m.start(), m.end()) for m in TOKEN.finditer(text, start, end)]
    found, word, before = [], "", []
    for a, b in tokens:
        before.append(word)
        if text[a].isalpha():
            word = text[a:b].lower()
    for i, (a, first_end) in enumerate(tokens):
        if not (text[a].isalnum() or text[a] in "+("):
            continue
        digits, at, blanks = 0, False, 0
        for j in range(i, min(len(tokens), i + MAX_TOKENS)):
            c, d = tokens[j]
            head = text[c]
            if head.isspace():
                blanks += 1
                if blanks > 6 or head == "\n" or (j + 1 < len(tokens) and text[tokens[j + 1][0]].isspace()):
                    break
            at = at or head == "@"
            if head.isdigit():
                digits += d - c
            if head.isalpha() and blanks and not at:
                break  # words do not join numbers
            if blanks and at:
                break
            if head.isalnum() and (at or digits >= 7) and not (at and text[a] == "("):
                found.append((i, j + 1, features(text, a, d, before[i])))
    return tokens, found


def segment_scores(found, weights):
    return [weights[f].sum(axis=0) for _, _, f in found]


def best_segments(tokens, found, weights):
    """The best segmentation: (start, end, kind, score) of its segments."""
    ends = {}
    for (i, j, _), scores in zip(found, segment_scores(found, weights)):
        kind = int(scores.argmax())
        ends.setdefault(j, []).append((i, kind, float(scores[kind])))
    best, back = [0.0] * (len(tokens) + 1), [None] * (len(tokens) + 1)
    for j in range(1, len(tokens) + 1):
        best[j] = best[j - 1]
        for i, kind, score in ends.get(j, ()):
            if best[i] + score > best[j]:
                best[j], back[j] = best[i] + score, (i, kind, score)
    out, j = [], len(tokens)
    while j:
        if back[j]:
            i, kind, score = back[j]
            out.append((tokens[i][0], tokens[j - 1][1], KINDS[kind], score))
            j = i
        else:
            j -= 1
    return out[::-1]


def _expected(tokens, found, weights):
    """log Z and the probability of each candidate with each kind (forward and backward sums)."""
    size = len(tokens)
    scores = segment_scores(found, weights)
    total = [float(np.logaddexp.reduce(s)) for s in scores]
    by_end, by_start = {}, {}
    for n, (i, j, _) in enumerate(found):
        by_end.setdefault(j, []).append((i, n))
        by_start.setdefault(i, []).append((j, n))
    alpha, beta = [0.0] * (size + 1), [0.0] * (size + 1)

    def joined(values):
        top = max(values)
        return top + log(sum(exp(v - top) for v in values))

    for j in range(1, size + 1):
        alpha[j] = joined([alpha[j - 1], *(alpha[i] + total[n] for i, n in by_end.get(j, ()))])
    for i in range(size - 1, -1, -1):
        beta[i] = joined([beta[i + 1], *(beta[j] + total[n] for j, n in by_start.get(i, ()))])
    return [np.exp(alpha[i] + beta[j] - alpha[size] + s) for (i, j, _), s in zip(found, scores)]


def train(stretches_and_spans, epochs=EPOCHS, rate=0.5, decay=2e-5):
    """Weights (features x kinds) by stochastic gradient ascent of the conditional likelihood."""
    weights = np.zeros((len(FEATURES), len(KINDS)))
    prepared = []
    for text, spans in stretches_and_spans:
        tokens, found = candidates(text, 0, len(text))
        wanted = {(a, b): KINDS.index(kind) for kind, a, b in spans}
        prepared.append((tokens, found, [wanted.get((tokens[i][0], tokens[j - 1][1])) for i, j, _ in found]))
    order = random.Random(11)
    for epoch in range(epochs):
        order.shuffle(prepared)
        for tokens, found, wanted in prepared:
            if not found:
                continue
            for (_, _, on), probability, kind in zip(found, _expected(tokens, found, weights), wanted):
                step = -probability
                if kind is not None:
                    step[kind] += 1
                weights[on] += rate / (1 + epoch) * step
            weights *= 1 - decay
    return weights


def variants(text, spans, order):
    """A stretch with its spans, and forms of it that the base patterns miss."""
    yield text, spans
    out, shift, kept = text, 0, []
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        a, b = a + shift, b + shift
        own = out[a:b]
        if kind == "phone":
            new = own[1:] if len(re.findall("[0-9]+", own)) > 2 else own
        elif kind == "card":
            d = "".join(digits_of(own))
            new = order.choice(("/", ".", " ", "-")).join(d[i : i + 4] for i in range(0, len(d), 4))
        else:
            new = own
        out = out[:a] + new + out[b:]
        shift += len(new) - len(own)
        kept.append((kind, a, a + len(new)))
    yield out, kept


def plain_numbers(order):
    """A stretch of numbers that are nobody's data: dates, times, versions, amounts, counts, codes."""
    n = order.randint
    forms = (
        f"{n(1900, 2030)}-{n(1, 12):02}-{n(1, 28):02}", f"{n(1, 28)}.{n(1, 12)}.{n(1900, 2030)} {n(0, 23)}:{n(0, 59):02}:{n(0, 59):02}", f"v{n(0, 9)}.{n(0, 30)}.{n(0, 999)}",
        f"{n(1, 999)}.{n(100, 999)}.{n(100, 999)},{n(10, 99)}", f"{n(1, 999)},{n(100, 999)},{n(100, 999)}", f"3.{n(10**9, 10**12)}", f"{n(10**6, 10**20)}", f"978-{n(0, 9)}-{n(10, 99)}-{n(100000, 999999)}-{n(0, 9)}",
        f"{n(1, 200)} {n(1, 200)} {n(1, 200)} {n(1, 200)}", f"{n(1900, 2030)}-{n(1900, 2030)} {n(1900, 2030)}-{n(1900, 2030)}", f"{n(10**8, 10**14)} {n(10**8, 10**14)}", f"{n(1, 99)}/{n(1, 99)}/{n(1900, 2030)}",
        f"{n(1900, 2030)} {n(1900, 2030)} {n(1900, 2030)}", f"{n(0, 9)}{n(10**14, 10**15 - 1)}", f"{n(100, 999)} {n(100, 999)} {n(100, 999)} {n(100, 999)}",
    )
    return f"of the {order.choice(forms)} and then", []


def sides_of(text):
    """(kind or "", stretch) of the stretches of a text that hold whole base spans, or none."""
    spans = base_spans(text)
    for a, b in stretches(text):
        near = [(k, s, e) for k, s, e in spans if s < b and e > a]
        if b - a <= LONGEST_STRETCH and all(a <= s and e <= b for _, s, e in near):
            for kind in {k for k, _, _ in near} or {""}:
                yield kind, text[a:b]


def sampled_stretches(docs, limit=SAMPLE_STRETCHES):
    """(kind, stretch): for each kind, and for none (""), the ``limit`` distinct stretches of all rows with the smallest hashes."""

    def run(batches):
        held = {kind: [] for kind in ("", *KINDS)}  # heaps of the smallest hashes, so a task sends few rows
        known = {kind: set() for kind in held}
        for batch in text_slices(batches):
            for text in batch.column("text").to_pylist():
                for kind, stretch in sides_of(text):
                    item = (-zlib.crc32(stretch.encode()), stretch)
                    if item in known[kind] or (len(held[kind]) >= limit and item < held[kind][0]):
                        continue
                    known[kind].add(item)
                    heapq.heappush(held[kind], item)
                    if len(held[kind]) > limit:
                        known[kind].discard(heapq.heappop(held[kind]))
        rows = [(kind, -h, stretch) for kind, items in held.items() for h, stretch in items]
        yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in enumerate((pa.string(), pa.int64(), pa.string()))], names=["kind", "hash", "stretch"])

    found = id_and_text(docs).filter(F.col("text").rlike("[0-9@]")).select("text").mapInArrow(run, "kind string, hash long, stretch string")
    found = stage(found.distinct(), "pii-stretches")
    chosen = [found.filter(F.col("kind") == kind).orderBy("hash", F.desc("stretch")).limit(limit) for kind in ("", *KINDS)]
    for more in chosen[1:]:
        chosen[0] = chosen[0].unionByName(more)
    return chosen[0].select("kind", "stretch")


def training_data(texts):
    """Stretches with wanted spans, their variants, and plain numbers.

    Few stretches come again with other variants, so that training has enough steps.
    """
    order = random.Random(7)
    out = [(text, base_spans(text)) for text in texts]
    if not any(spans for _, spans in out):
        return []
    order.shuffle(out)
    out *= max(1, SAMPLE_STRETCHES * len(KINDS) // (2 * len(out)))
    ready = [v for text, spans in out for v in variants(text, spans, order)]
    return ready + [plain_numbers(order) for _ in range(len(ready))]


def fit(docs):
    """Weights trained in one task on sampled stretches of all ``docs``; None if no row holds a base span in a usable stretch."""

    def run(frame):
        import pandas as pd

        data = training_data(sorted(set(frame["stretch"])))
        return pd.DataFrame({"weights": [train(data).ravel().tolist() if data else None]})

    row = sampled_stretches(docs).groupBy(F.lit(0).alias("all")).applyInPandas(run, "weights array<double>").first()
    return None if row is None or row[0] is None else np.array(row[0]).reshape(len(FEATURES), len(KINDS))


def all_spans(text, weights):
    """(base spans, all spans) of a text."""
    base = base_spans(text)
    if weights is None:
        return base, base
    taken = sorted((a, b) for _, a, b in base)
    added = []
    for a, b in stretches(text):
        inside = [s for s in taken if s[0] < b and s[1] > a]
        if all(any(x <= m.start() and m.end() <= y for x, y in inside) for m in TRIGGER.finditer(text, a, b)):
            continue  # the base patterns hold every digit and at-sign here
        for start, end, kind, score in best_segments(*candidates(text, a, b), weights):
            if score >= MARGIN and not any(s < end and e > start for s, e in inside):
                added.append((kind, start, end))
    order = {kind: n for n, kind in enumerate(KINDS)}
    return base, sorted(base + added, key=lambda s: (order[s[0]], s[1]))


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
SPANS = "doc_id long, text string, base array<struct<kind: string, start: long, end: long>>, spans array<struct<kind: string, start: long, end: long>>"
ARROW_SPANS = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("base", pa.list_(SPAN)), ("spans", pa.list_(SPAN))])


def find_spans(docs, weights, *more):
    """doc_id, text, base, spans (code points, end exclusive) of each row, and the columns ``more``.

    A null text is empty and has no spans; repeated rows and null ids are treated like any row.
    """
    rows = id_and_text(docs, *more)
    extra = [f for f in rows.schema.fields if f.name in more]

    def run(batches):
        for batch in text_slices(batches):
            both = [all_spans(t, weights) for t in batch.column("text").to_pylist()]
            lists = [pa.array([[dict(zip(("kind", "start", "end"), s)) for s in pair[n]] for pair in both], pa.list_(SPAN)) for n in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), *lists, *(batch.column(c) for c in more)], names=[*ARROW_SPANS.names, *more])

    return rows.mapInArrow(run, ", ".join([SPANS, *(f"`{f.name}` {f.dataType.simpleString()}" for f in extra)]))


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(kind):
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


def personal_data(docs):
    """doc_id, base counts by kind, base_sha256 and all spans of each row of ``docs``."""
    found = find_spans(docs, fit(docs))
    counts = [_count(kind).alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def masked(text, spans):
    """A text with each span replaced by its kind in brackets; spans that overlap are one."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask(docs, *more):
    """``docs`` as doc_id, text and the columns ``more``, with personal data masked in ``text``."""
    weights = fit(docs)
    rows = id_and_text(docs, *more)

    def run(batches):
        for batch in text_slices(batches):
            texts = pa.array([masked(t, all_spans(t, weights)[1]) for t in batch.column("text").to_pylist()], pa.string())
            yield batch.set_column(batch.schema.get_field_index("text"), "text", texts)

    return rows.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields))
