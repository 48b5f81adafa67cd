"""Quality classifier: supervised subword embeddings.

Every word counts with one hashed vector for itself and one for each of its character n-grams;
a word equal to the one before it adds the vector of repetition. A document is the mean of all
these vectors, and a softmax over the mean gives the class. Vectors and output weights are
trained together by stochastic gradient descent in numpy on a bounded sample of labelled rows.
For two classes each vector acts on the score only through its product with the difference of
the output weights, so scoring looks up one number for each word.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import functions as F

from tagloom.llm.common import bounded_sample, id_and_text, text_slices

BUCKETS = 1 << 16
REPEAT = BUCKETS  # the vector of a repeated word
NGRAMS = (2, 3, 4)
DIMENSIONS = 16
#: Bound of the labelled rows used for training.
SAMPLE_ROWS = 3000
EPOCHS = 12
RATE = 4.0

FACTOR = np.uint64(0x100000001B3)
MIX = np.uint64(0x9E3779B97F4A7C15)


def held_out(doc_id):
    """Whether a row's label must not be learned from: crc32 of its id modulo 3 is 1."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def words_of(texts):
    """Word codes of texts in turn, the end of each text's codes, the distinct words."""
    lists = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
    # Splitting leaves empty words at the borders; they hold no feature and are skipped.
    flat = lists.flatten()
    filled = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(filled)])[lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()]
    coded = flat.filter(pa.array(filled)).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), ends, coded.dictionary.to_pylist()


def subwords(words):
    """Buckets of the features of each word, in turn, and the offsets of the words."""
    raw = [w.encode() for w in words]
    sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)) + 2
    text = np.frombuffer(b"".join(b"<" + w + b">" for w in raw), dtype=np.uint8).astype(np.uint64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(raw)), sizes)
    left = np.repeat(ends, sizes) - np.arange(len(text))  # bytes up to the end of the word
    owners, buckets = [np.arange(len(raw))], [np.fromiter((xxhash.xxh32_intdigest(w) % BUCKETS for w in raw), dtype=np.int64, count=len(raw))]
    for size in NGRAMS:
        if len(text) < size:
            continue
        value = np.full(len(text) - size + 1, size, dtype=np.uint64)
        for i in range(size):
            value = value * FACTOR + text[i : len(text) - size + 1 + i]
        value *= MIX
        inside = left[: len(value)] >= size
        owners.append(owner[: len(value)][inside])
        buckets.append((value[inside] >> np.uint64(48)).astype(np.int64) % BUCKETS)
    owners, buckets = np.concatenate(owners), np.concatenate(buckets)
    order = np.argsort(owners, kind="stable")
    return buckets[order], np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(raw)))])


def repeats(codes, ends):
    """How many words of each text equal the word before."""
    same = np.zeros(len(codes) + 1, dtype=np.int64)
    same[2:] = codes[1:] == codes[:-1]
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    same[np.minimum(starts, len(codes) - 1)[starts < len(codes)] + 1] = 0  # a text's first word follows no other
    total = np.cumsum(same)
    return total[ends] - total[starts]


FEATURES = "label int, buckets array<int>, counts array<float>"
ARROW_FEATURES = pa.schema([("label", pa.int32()), ("buckets", pa.list_(pa.int32())), ("counts", pa.list_(pa.float32()))])


def training_features(rows):
    """Label and counts by bucket of each row (doc_id, text, label)."""

    def run(batches):
        for batch in text_slices(batches):
            codes, ends, words = words_of(batch.column("text"))
            buckets, offsets = subwords(words)
            same = repeats(codes, ends)
            begin, found, counts = 0, [], []
            for end, repeated in zip(ends, same):
                own, times = np.unique(codes[begin:end], return_counts=True)
                begin = end
                lengths = offsets[own + 1] - offsets[own]
                at = np.repeat(offsets[own] - np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(own) else own, lengths) + np.arange(lengths.sum())
                total = np.bincount(buckets[at.astype(np.int64)], weights=np.repeat(times, lengths), minlength=BUCKETS + 1)
                total[REPEAT] = repeated
                found.append(np.flatnonzero(total).astype(np.int32))
                counts.append(total[found[-1]].astype(np.float32))
            yield pa.RecordBatch.from_pydict({"label": batch.column("label"), "buckets": found, "counts": counts}, schema=ARROW_FEATURES)

    return rows.select("doc_id", "text", F.col("label").cast("int").alias("label")).mapInArrow(run, FEATURES)


def descend(examples, epochs=EPOCHS, rate=RATE, seed=5):
    """Train on (label, buckets, counts); returns the score of each bucket and the bias.

    The returned values are the products of the vectors with the difference of the two rows
    of output weights.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (BUCKETS + 1, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    output, bias = np.zeros((2, DIMENSIONS), dtype=np.float32), np.zeros(2, dtype=np.float32)
    steps, done = epochs * len(examples), 0
    for _ in range(epochs):
        for number in rng.permutation(len(examples)):
            label, buckets, counts = examples[number]
            speed = np.float32(rate * (1 - done / steps))
            done += 1
            share = counts / counts.sum() if len(counts) else counts
            hidden = share @ vectors[buckets]
            logits = output @ hidden + bias
            odds = np.exp(logits - logits.max())
            error = -odds / odds.sum()
            error[label] += 1
            back = error @ output
            output += speed * np.outer(error, hidden)
            bias += np.float32(0.02) * speed * error
            vectors[buckets] += speed * np.outer(share, back)
    return vectors @ (output[1] - output[0]), float(bias[1] - bias[0])


def fit(docs, labels, sample=SAMPLE_ROWS):
    """(scores by bucket, bias), trained in one task on at most ``sample`` labelled rows.

    Learns only from rows outside the held-out third. Labels given twice count once (the
    larger); rows without label or id are left out. None if no labelled row is left.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label")).filter("doc_id IS NOT NULL AND label IN (0, 1)")
    known = known.filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = bounded_sample(known, "doc_id", sample)
    rows = id_and_text(docs).join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])

    def run(table):
        order = pc.sort_indices(table.append_column("mass", pc.list_value_length(table["buckets"])), sort_keys=[("label", "ascending"), ("mass", "ascending")])
        table = table.take(order).combine_chunks()
        lists = [table[c].combine_chunks() for c in ("buckets", "counts")]
        cuts = lists[0].offsets.to_numpy()
        buckets, counts = (x.values.to_numpy() for x in lists)
        examples = [(label, buckets[a:b], counts[a:b]) for label, a, b in zip(table["label"].to_pylist(), cuts, cuts[1:])]
        scores, bias = descend(examples)
        return pa.table({"scores": pa.array([scores.astype(np.float64)], pa.list_(pa.float64())), "bias": [bias]})

    features = training_features(rows).withColumn("all", F.lit(0))
    row = features.groupBy("all").applyInArrow(lambda t: run(t.select(["label", "buckets", "counts"])), "scores array<double>, bias double").first()
    return None if row is None else (np.array(row["scores"]), row["bias"])


def score(docs, model, *more):
    """doc_id, score (probability of quality 1) and the columns ``more`` of each row of ``docs``.

    Whole texts are read; a null text counts as empty and gets the score of the bias alone.
    Without a model every score is 0.5.
    """
    rows = id_and_text(docs, *(c for c in more if c != "text"))
    extra = [rows.schema[c] for c in more]

    def run(batches):
        table, bias = model if model is not None else (np.zeros(BUCKETS + 1), 0.0)
        for batch in text_slices(batches):
            codes, ends, words = words_of(batch.column("text"))
            buckets, offsets = subwords(words)
            by_word = np.concatenate([[0.0], np.cumsum(table[buckets])])
            word_score, word_features = by_word[offsets[1:]] - by_word[offsets[:-1]], np.diff(offsets)
            sums = np.concatenate([[0.0], np.cumsum(word_score[codes])])
            sizes = np.concatenate([[0], np.cumsum(word_features[codes])])
            starts, same = np.concatenate([[0], ends[:-1]]).astype(np.int64), repeats(codes, ends)
            total = sums[ends] - sums[starts] + same * table[REPEAT]
            count = np.maximum(1, sizes[ends] - sizes[starts] + same)
            found = 1 / (1 + np.exp(-np.clip(total / count + bias, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found), *(batch.column(c) for c in more)], names=["doc_id", "score", *more])

    return rows.mapInArrow(run, ", ".join(["doc_id long, score double", *(f"`{f.name}` {f.dataType.simpleString()}" for f in extra)]))


def classify(docs, labels):
    """doc_id, held_out, score, predicted for each row of ``docs``."""
    judged = score(docs, fit(docs, labels))
    return judged.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
