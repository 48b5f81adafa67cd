"""Near-duplicates by circulant MinHash, banding and exact Jaccard verification.

Two permutations of one range make all coordinates of a signature: the first scatters the
shingles, the second is shifted by one place for each further coordinate. The values of a
shingle are then one window of the second permutation, and a signature is the minimum of the
windows of a text's shingles. Texts that agree in all rows of a band share a bucket.

Texts with equal shingle sets are one class from the start. Each bucket links its members to
its smallest one only; links are confirmed on the full sets. Buckets whose members are then
not all connected are searched again in blocks: members of different components with alike
signatures are compared on their full sets too, so that a member unlike the smallest one keeps
its links.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from tagloom.llm.common import id_and_text, stage, text_slices
from tagloom.llm.components import components
from tagloom.llm.encoding import take_runs

WORDS = 5
NUMERATOR, DENOMINATOR = 75, 100
BANDS, ROWS = 44, 5
#: Size of the permuted range.
RANGE = 1 << 20
#: One byte of each of so many coordinates makes the sketch that screens candidates.
SKETCH = 200
#: Share of equal sketch bytes below which a pair is not confirmed. A pair at the threshold
#: lies 5 standard deviations above it.
SCREEN = 0.60
#: Members of a block when a bucket is searched again; two blocks meet in a task.
BLOCK = 2048
#: Document ids sent to every task at most, 8 MB; more are joined by a shuffle.
SENT_IDS = 1_000_000

MIX = np.uint64(0x9E3779B97F4A7C15)


def _permutations():
    rng = np.random.default_rng(20_240_501)
    first, second = rng.permutation(RANGE).astype(np.int64), rng.permutation(RANGE).astype(np.uint32)
    width = BANDS * ROWS
    # Shifts run backwards over the window, so it is laid out once with its end joined to its start.
    circle = np.concatenate([second, second[: width - 1]])
    return first, np.lib.stride_tricks.sliding_window_view(circle, width)


_STATE = {}


def _mixed(values):
    values = (values ^ (values >> np.uint64(31))) * MIX
    return values ^ (values >> np.uint64(29))


class Shingler:
    """Distinct 64-bit shingle hashes of texts; words are hashed once for each task."""

    def __init__(self, limit=400_000):
        self.hashes, self.limit = {}, limit

    def shingles(self, text):
        """Sorted distinct shingle hashes: of 5-word runs, or of the whole if shorter."""
        words = text.encode().lower().split()
        if not words:
            return np.zeros(0, dtype=np.uint64)
        known = self.hashes
        if len(known) > self.limit:
            known.clear()
        try:
            row = np.array([known[w] for w in words], dtype=np.uint64)
        except KeyError:
            for w in set(words):
                if w not in known:
                    known[w] = xxhash.xxh64_intdigest(w)
            row = np.array([known[w] for w in words], dtype=np.uint64)
        size = min(WORDS, len(words))
        total = np.full(len(words) - size + 1, size, dtype=np.uint64)
        for i in range(size):
            total = _mixed(total * MIX + row[i : len(row) - size + 1 + i])
        return np.unique(total)


def signature(shingles):
    """All coordinates of a shingle set."""
    if "windows" not in _STATE:
        _STATE["first"], _STATE["windows"] = _permutations()
    places = _STATE["first"][(shingles % np.uint64(RANGE)).astype(np.int64)]
    low = None
    for start in range(0, len(places), 4096):  # bounded memory for long texts
        part = _STATE["windows"][places[start : start + 4096]].min(axis=0)
        low = part if low is None else np.minimum(low, part)
    return low


SETS = "doc_id long, n_shingles long, class string, bands array<long>, sketch binary"
ARROW_SETS = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("class", pa.string()), ("bands", pa.list_(pa.int64())), ("sketch", pa.binary())])


def shingle_sets(docs):
    """doc_id, size and digest of each text's shingle set, its band keys and its sketch."""

    def run(batches):
        shingler = Shingler()
        band_salt = np.arange(BANDS, dtype=np.uint64) << np.uint64(40)
        for batch in text_slices(batches):
            rows = {name: [] for name in ARROW_SETS.names}
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                own = shingler.shingles(text)
                digest = bands = sketch = None
                if len(own):
                    digest = hashlib.blake2b(own.tobytes(), digest_size=16).hexdigest()
                    low = signature(own).astype(np.uint64)
                    keys = band_salt
                    for row in low[: BANDS * ROWS].reshape(BANDS, ROWS).T:
                        keys = _mixed(keys * MIX + row)
                    bands, sketch = keys.view(np.int64).tolist(), _mixed(low[:SKETCH]).astype(np.uint8).tobytes()
                for name, value in zip(ARROW_SETS.names, (doc_id, len(own), digest, bands, sketch)):
                    rows[name].append(value)
            yield pa.RecordBatch.from_pydict(rows, schema=ARROW_SETS)

    return id_and_text(docs).mapInArrow(run, SETS)


def _near_sizes(a, b):
    return (F.least(a, b) * DENOMINATOR >= F.greatest(a, b) * NUMERATOR)


def _screen(pairs, reps):
    """The pairs (a, b) whose set sizes and sketches allow a link."""
    for side in ("a", "b"):
        pairs = pairs.join(reps.select(F.col("rep").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("sketch").alias(f"sketch_{side}")), side)

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                left, right = (np.frombuffer(b"".join(batch.column(f"sketch_{s}").to_pylist()), dtype=np.uint8).reshape(-1, SKETCH) for s in "ab")
                near = (left == right).mean(axis=1) >= SCREEN
                yield pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(near))

    return pairs.filter(_near_sizes(F.col("n_a"), F.col("n_b"))).select("a", "b", "sketch_a", "sketch_b").mapInArrow(run, "a long, b long")


def _texts_of(ids, docs):
    """(rep, text) of the documents with the given ids, staged."""
    if ids.count() <= SENT_IDS:  # else the texts are dealt out by id
        ids = F.broadcast(ids)
    return stage(id_and_text(docs).join(ids, F.col("doc_id") == F.col("rep")).select("rep", "text"), "texts").dropDuplicates(["rep"])


def _confirm(pairs, docs):
    """The pairs whose full shingle sets reach the similarity."""
    texts = _texts_of(stage(pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), "pair-ids"), docs)
    for side in ("a", "b"):
        pairs = pairs.join(texts.select(F.col("rep").alias(side), F.col("text").alias(f"text_{side}")), side)

    def run(batches):
        shingler = Shingler()
        for batch in text_slices(batches, "text_a"):
            keep, memo = [], (None, None)
            for a, left, right in zip(batch.column("a").to_pylist(), batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()):
                if memo[0] != a:
                    memo = (a, shingler.shingles(left))
                other = shingler.shingles(right)
                common = len(np.intersect1d(memo[1], other, assume_unique=True))
                keep.append(DENOMINATOR * common >= NUMERATOR * (len(memo[1]) + len(other) - common))
            yield pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))

    return pairs.mapInArrow(run, "a long, b long")


def _cells(buckets, labels, reps):
    """Members of the buckets that hold several components, dealt into cells (bucket, cell).

    A bucket's main members, those connected with its smallest one, need no comparison with
    each other. They and the rest are cut into blocks; a block of either meets each block of the
    rest in a cell of its own, so any bucket is covered in bounded memory.
    """
    members = buckets.join(labels, F.col("rep") == F.col("node"), "left").select("bucket", "rep", "hub", F.coalesce("component", "rep").alias("component"))
    hubs = labels.select(F.col("node").alias("hub"), F.col("component").alias("main"))
    members = members.join(hubs, "hub", "left").select("bucket", "rep", "component", (F.col("component") == F.coalesce("main", "hub")).alias("is_main"))
    sizes = members.groupBy("bucket").agg(F.count_if("is_main").alias("mains"), F.count_if(~F.col("is_main")).alias("rest")).filter("rest > 0")
    rows = members.join(sizes, "bucket").join(reps.select("rep", "n_shingles", "sketch", "bands"), "rep")
    main_blocks, rest_blocks = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("mains", "rest"))
    number = F.pmod(F.xxhash64("rep"), F.when(F.col("is_main"), main_blocks).otherwise(rest_blocks)).cast("int")
    span = lambda n: F.sequence(F.lit(0), n - 1)
    cell = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    with_mains = F.transform(span(main_blocks), lambda i: cell("main", i, F.col("block")))
    with_rest = F.transform(span(rest_blocks), lambda o: cell("rest", F.least(o, F.col("block")), F.greatest(o, F.col("block"))))
    cells = F.when(F.col("is_main"), F.transform(span(rest_blocks), lambda j: cell("main", F.col("block"), j))).otherwise(F.concat(with_mains, with_rest))
    return rows.withColumn("block", number).select("bucket", "rep", "component", "n_shingles", "sketch", "bands", "is_main", "block", F.explode(cells).alias("cell"))


def _alike(key, table):
    """(member, its partners) of a cell: other component, near size, alike sketch, and no earlier bucket in common."""
    kind, i, j = key[1].as_py().values()
    part, size, block = (table[c].to_numpy() for c in ("component", "n_shingles", "block"))
    sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), dtype=np.uint8).reshape(-1, SKETCH)
    bands = table["bands"].combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    if kind == "main":
        first = ~table["is_main"].to_numpy()
    else:
        first = np.ones(len(part), bool) if i == j else block == i
    second = np.arange(len(part)) if kind == "rest" and i == j else np.flatnonzero(~first)
    for at in np.flatnonzero(first):
        other = second[second > at] if kind == "rest" and i == j else second
        other = other[(part[other] != part[at]) & (np.minimum(size[other], size[at]) * DENOMINATOR >= np.maximum(size[other], size[at]) * NUMERATOR)]
        other = other[(sketch[other] == sketch[at]).mean(axis=1) >= SCREEN]
        if len(other):
            earliest = (bands[other] == bands[at]).argmax(axis=1)
            other = other[bands[at][earliest] == key[0].as_py()]
            if len(other):
                yield at, other


def _more_links(buckets, labels, reps, docs):
    """Links between different components, confirmed inside the cells on the full sets.

    A cell first names the members that have an alike partner; their texts join them, and the
    cell confirms pairs until its components are connected as far as they can be. Only links
    leave a cell, fewer than it has members, never the pairs tried.
    """

    def name(key, table):
        table = table.sort_by("rep")
        found = np.zeros(len(table), bool)
        for at, other in _alike(key, table):
            found[at] = found[other] = True
        return table.filter(pa.array(found))

    cells = _cells(buckets, labels, reps)
    named = stage(cells.groupBy("bucket", "cell").applyInArrow(name, cells.schema), "open-members")
    ids = stage(named.select("rep").distinct(), "open-ids")

    def confirm(key, table):
        table = table.sort_by("rep")
        rep, part, shingler = table["rep"].to_pylist(), table["component"].to_pylist(), Shingler()
        sets = [shingler.shingles(t) for t in table["text"].to_pylist()]
        sizes = np.array([len(s) for s in sets])
        numbers = np.unique(np.concatenate(sets), return_inverse=True)[1]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        marked = np.zeros(len(numbers) + 1, dtype=np.int32)
        root = {}

        def top(x):
            while x in root:
                x = root[x]
            return x

        links = []
        for at, other in _alike(key, table):
            other = other[[top(part[o]) != top(part[at]) for o in other]]
            if not len(other):
                continue
            own = numbers[offsets[at] : offsets[at + 1]]
            marked[own] = 1
            flat, ends = take_runs(numbers, offsets, other)
            common = np.diff(np.concatenate([[0], np.cumsum(marked[flat])])[np.concatenate([[0], ends])])
            marked[own] = 0
            for o in other[DENOMINATOR * common >= NUMERATOR * (sizes[at] + sizes[other] - common)]:
                x, y = top(part[at]), top(part[o])
                if x != y:
                    root[max(x, y)] = min(x, y)
                    links.append((min(rep[at], rep[o]), max(rep[at], rep[o])))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    with_text = named.join(_texts_of(ids, docs), "rep")
    return stage(with_text.groupBy("bucket", "cell").applyInArrow(confirm, "a long, b long").distinct(), "more-links")


def near_duplicates(docs):
    """doc_id, n_shingles, component_id, kept for each row of ``docs``.

    A null or wordless text has an empty set and is linked with nothing. Texts of fewer than
    five words are linked only if their word sequences are equal. Rows that repeat a doc_id
    count as that document. A row without doc_id is judged alone (component_id null, kept).
    """
    sets = stage(shingle_sets(docs), "shingle-sets")
    with_words = sets.filter("class IS NOT NULL AND doc_id IS NOT NULL")
    # The set of a class is the set of each of its rows, so any row's bands and sketch will do.
    low = with_words.groupBy("class").agg(F.min("doc_id").alias("doc_id"))
    reps = with_words.join(low, ["class", "doc_id"]).dropDuplicates(["class", "doc_id"])
    reps = stage(reps.select(F.col("doc_id").alias("rep"), "class", "n_shingles", "bands", "sketch"), "representatives")

    keyed = reps.select("rep", F.explode("bands").alias("bucket"))
    hubs = keyed.groupBy("bucket").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("members")).filter("members > 1")
    buckets = stage(keyed.join(hubs, "bucket").select("bucket", "rep", "hub"), "buckets")
    stars = buckets.filter("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    links = stage(_confirm(stage(_screen(stars, reps), "alike-pairs"), docs), "links")
    labels = components(links)
    more = _more_links(buckets, labels, reps, docs)
    if not more.isEmpty():
        labels = components(links.unionByName(more))

    classes = reps.join(labels, F.col("rep") == F.col("node"), "left").select("class", F.coalesce("component", "rep").alias("component"))
    judged = sets.join(classes, "class", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return judged.select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))
