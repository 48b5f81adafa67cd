"""Exact duplicates by an extendible-hash index on shared files.

Texts are hashed; an owner task holds the keys of some ranges (leading bits) and inserts them
into a directory of buckets. A bucket that overflows is split by its next bit, and the
directory doubles when the bucket already uses all its bits. Keys that are equal are chained
and told apart by comparing the texts' bytes. Owners receive their keys in ascending order, so
a bucket is complete once a later key range begins: it is then written to the shared folder
and leaves the memory.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import functions as F

from tagloom.llm.common import fresh_dir, fresh_name, id_and_text, read_file, stage, text_slices, write_file

BUCKET_TEXTS = 1024
BUCKET_BYTES = 4 << 20
HASH_BITS = 63
NO_ID = -(1 << 63)
#: Groups of equal texts sent to every task at most, about 10 MB; more are joined by a shuffle.
SENT_GROUPS = 100_000

CANDIDATES = "owner long, key long, text string, best long, copies long"
ARROW_CANDIDATES = pa.schema([("owner", pa.int64()), ("key", pa.int64()), ("text", pa.string()), ("best", pa.int64()), ("copies", pa.int64())])
DIRECTORY = "owner long, own_bits int, prefix long, depth int, path string, groups array<struct<text_sha256: string, keep_id: long, group_size: long>>"
ARROW_DIRECTORY = pa.schema(
    [
        ("owner", pa.int64()), ("own_bits", pa.int32()), ("prefix", pa.int64()), ("depth", pa.int32()), ("path", pa.string()),
        ("groups", pa.list_(pa.struct([("text_sha256", pa.string()), ("keep_id", pa.int64()), ("group_size", pa.int64())]))),
    ]
)
ENTRY = pa.schema([("key", pa.int64()), ("text", pa.large_string()), ("keep_id", pa.int64()), ("copies", pa.int64())])


def key_of(text, hash_bits=HASH_BITS):
    return xxhash.xxh64_intdigest(text.encode()) >> (64 - hash_bits)


class Bucket:
    """Chains of entries ``[text, best id, copies]`` by key, for the keys that start with ``prefix``."""

    def __init__(self, prefix, depth):
        self.prefix, self.depth = prefix, depth
        self.chains, self.texts, self.bytes = {}, 0, 0

    def put(self, key, text, best, copies):
        chain = self.chains.setdefault(key, [])
        for entry in chain:
            if entry[0] == text:
                entry[1], entry[2] = max(entry[1], best), entry[2] + copies
                return
        chain.append([text, best, copies])
        self.texts += 1
        self.bytes += len(text)


class Directory:
    """Extendible-hash directory over the keys of one owner."""

    def __init__(self, bits, capacity=BUCKET_TEXTS, capacity_bytes=BUCKET_BYTES):
        self.bits, self.capacity, self.capacity_bytes = bits, capacity, capacity_bytes
        self.depth, self.slots = 0, [Bucket(0, 0)]

    def bucket(self, key):
        return self.slots[key >> (self.bits - self.depth)]

    def insert(self, key, text, best, copies):
        bucket = self.bucket(key)
        bucket.put(key, text, best, copies)
        while (bucket.texts > self.capacity or bucket.bytes > self.capacity_bytes) and len(bucket.chains) > 1 and bucket.depth < self.bits:
            self.split(bucket)
            bucket = self.bucket(key)
        return bucket

    def split(self, bucket):
        if bucket.depth == self.depth:
            self.slots = [b for b in self.slots for _ in (0, 1)]
            self.depth += 1
        low, high = Bucket(bucket.prefix << 1, bucket.depth + 1), Bucket(bucket.prefix << 1 | 1, bucket.depth + 1)
        shift = self.bits - bucket.depth - 1
        for key, chain in bucket.chains.items():
            half = high if key >> shift & 1 else low
            half.chains[key] = chain
            half.texts += len(chain)
            half.bytes += sum(len(e[0]) for e in chain)
        span = 1 << (self.depth - bucket.depth)
        first = bucket.prefix * span
        self.slots[first : first + span] = [low] * (span // 2) + [high] * (span // 2)

    def take_before(self, bucket):
        """Remove and return the buckets of smaller keys that still hold texts."""
        done, end = [], bucket.prefix << (self.depth - bucket.depth)
        start = end
        while start and self.slots[start - 1].chains:
            start -= 1
            if not done or done[-1] is not self.slots[start]:
                done.append(self.slots[start])
        for slot in range(start, end):
            old = self.slots[slot]
            if slot == start or old is not self.slots[slot - 1]:
                blank = Bucket(old.prefix, old.depth)
            self.slots[slot] = blank
        return done[::-1]

    def remaining(self):
        out = []
        for bucket in self.slots:
            if bucket.chains and (not out or out[-1] is not bucket):
                out.append(bucket)
        return out


def _candidates(docs, owner_bits, hash_bits):
    """One row for each distinct text of a batch: its key, largest doc_id and rows."""

    def run(batches):
        for batch in text_slices(batches):
            coded = batch.column("text").dictionary_encode()
            codes = coded.indices.to_numpy()
            ids = batch.column("doc_id").fill_null(NO_ID).to_numpy()
            best = np.full(len(coded.dictionary), NO_ID, dtype=np.int64)
            np.maximum.at(best, codes, ids)
            keys = np.array([key_of(t, hash_bits) for t in coded.dictionary.to_pylist()], dtype=np.int64)
            copies = np.bincount(codes, minlength=len(best)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys >> (hash_bits - owner_bits)), pa.array(keys), coded.dictionary.cast(pa.string()), pa.array(best), pa.array(copies)], schema=ARROW_CANDIDATES)

    return id_and_text(docs).mapInArrow(run, CANDIDATES)


def build_index(docs, folder, hash_bits=HASH_BITS, capacity=BUCKET_TEXTS, capacity_bytes=BUCKET_BYTES):
    """The index of all texts; returns its directory, one row for each bucket file.

    ``groups`` lists the texts of the bucket that occur in more than one row. The directory is
    a written table, and only the files it names belong to the index.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    owner_bits = min(hash_bits, max(1, (8 * parts - 1).bit_length()))
    own_bits = hash_bits - owner_bits

    def run(batches):
        owner, directory, current = None, None, None

        def close(buckets):
            rows = {name: [] for name in ARROW_DIRECTORY.names}
            for bucket in buckets:
                entries = [(k, *e) for k, chain in sorted(bucket.chains.items()) for e in chain]
                path = f"{folder}/{owner}-{bucket.prefix}-{bucket.depth}-{fresh_name()}.bucket"
                write_file(path, to_bytes(entries))
                groups = [{"text_sha256": hashlib.sha256(t.encode()).hexdigest(), "keep_id": None if best == NO_ID else best, "group_size": n} for _, t, best, n in entries if n > 1]
                for name, value in zip(ARROW_DIRECTORY.names, (owner, own_bits, bucket.prefix, bucket.depth, path, groups)):
                    rows[name].append(value)
            return pa.RecordBatch.from_pydict(rows, schema=ARROW_DIRECTORY)

        mask = (1 << own_bits) - 1
        for batch in batches:
            for row_owner, key, text, best, copies in zip(*(c.to_pylist() for c in batch.columns)):
                if row_owner != owner:
                    if directory is not None:
                        yield close(directory.remaining())
                    owner, directory, current = row_owner, Directory(own_bits, capacity, capacity_bytes), None
                bucket = directory.insert(key & mask, text, best, copies)
                if bucket is not current and current is not None:
                    done = directory.take_before(bucket)
                    if done:
                        yield close(done)
                current = bucket
        if directory is not None:
            yield close(directory.remaining())

    owned = _candidates(docs, owner_bits, hash_bits).repartition(parts, "owner").sortWithinPartitions("owner", "key")
    return stage(owned.mapInArrow(run, DIRECTORY), "hash-directory")


def to_bytes(entries):
    """A bucket file: key, text, keep_id and rows of each entry, as a compressed Arrow stream."""
    keys, texts, best, copies = zip(*entries)
    table = pa.table([pa.array(keys, pa.int64()), pa.array(texts, pa.large_string()), pa.array([None if b == NO_ID else b for b in best], pa.int64()), pa.array(copies, pa.int64())], schema=ENTRY)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, ENTRY, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue()


def look_up(directory, texts, hash_bits=HASH_BITS):
    """keep_id and rows of given texts, read from the one bucket file that each key leads to.

    ``texts`` is a DataFrame with a column ``text``; texts that the index lacks get nulls.
    """
    # The split of a key into owner and bucket bits is the one the index was built with, stored in its directory.
    own_bits = directory.agg(F.max("own_bits")).first()[0]
    if own_bits is None:
        return texts.select("text", F.lit(None).cast("long").alias("keep_id"), F.lit(None).cast("long").alias("group_size"))

    def keyed(batches):
        for batch in batches:
            found = [key_of(t or "", hash_bits) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"text": batch.column("text"), "key": found, "owner": [k >> own_bits for k in found]}, schema=pa.schema([("text", pa.string()), ("key", pa.int64()), ("owner", pa.int64())]))

    keys = texts.select("text").mapInArrow(keyed, "text string, key long, owner long")
    own = F.col("key").bitwiseAND(F.lit((1 << own_bits) - 1))
    fits = F.call_function("shiftright", own, F.lit(own_bits) - F.col("depth")) == F.col("prefix")
    pairs = keys.join(directory.select("owner", "prefix", "depth", "path"), "owner", "left").filter(fits | F.col("path").isNull())
    # A text of an owner without a fitting bucket has no bucket to look in.
    pairs = keys.join(pairs.select("text", "key", "path").distinct(), ["text", "key"], "left")

    def search(batches):
        for batch in batches:
            keep, size = [], []
            for text, key, path in zip(*(batch.column(c).to_pylist() for c in ("text", "key", "path"))):
                table = pa.ipc.open_stream(read_file(path)).read_all() if path else ENTRY.empty_table()
                hit = table.filter(pc.and_(pc.equal(table["key"], key & ((1 << own_bits) - 1)), pc.equal(table["text"], pa.scalar(text or "", pa.large_string()))))
                keep.append(hit["keep_id"][0].as_py() if len(hit) else None)
                size.append(hit["copies"][0].as_py() if len(hit) else None)
            yield pa.RecordBatch.from_pydict({"text": batch.column("text"), "keep_id": keep, "group_size": size}, schema=pa.schema([("text", pa.string()), ("keep_id", pa.int64()), ("group_size", pa.int64())]))

    return pairs.select("text", "key", "path").mapInArrow(search, "text string, keep_id long, group_size long")


def mark_duplicates(docs, *more, hash_bits=HASH_BITS, capacity=BUCKET_TEXTS):
    """doc_id, keep_id, group_size, kept, text_sha256 and the columns ``more`` of each row of ``docs``.

    A null text equals the empty text. Of equal texts the row with the largest doc_id stays.
    Rows that share doc_id and text share their fate. A null doc_id ranks below all others; a
    group with null ids only keeps all its rows. No rows give no rows.
    """
    index = build_index(docs, fresh_dir(docs.sparkSession, "hash-index"), hash_bits, capacity)
    groups = index.select(F.explode("groups").alias("g")).select("g.*", F.lit(True).alias("grouped"))
    if groups.count() <= SENT_GROUPS:  # else rows and groups are dealt out by digest
        groups = F.broadcast(groups)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"), *more)
    joined = rows.join(groups, "text_sha256", "left")
    keep = F.when(F.col("grouped"), F.col("keep_id")).otherwise(F.col("doc_id"))
    return joined.select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256", *more
    )
