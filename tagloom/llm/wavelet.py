"""Token ids in shard files that hold a wavelet matrix: access, counting and occurrence lookup.

The wavelet matrix keeps one bit-plane for each bit of an id, highest first; behind each plane
the ids are stably parted by that bit. Rank and select on the planes answer which id stands at
a place, how often an id occurs and where, from the compressed file alone.
"""

import json
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.llm.common import batch_of, fresh_dir, fresh_name, id_and_text, read_file, stage, wide_slices, write_file
from tagloom.llm.encoding import opened

SHARD_TOKENS = 4_000_000
PART = 1 << 16  # ids parted at once, so that their places stay in the processor's cache (a multiple of 8)
BLOCK = 512  # bits between two stored ranks
MAGIC = b"WVMX1\n"
POPULATION = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


class WaveletMatrix:
    """Bit-planes over a sequence of ids, with rank and select."""

    def __init__(self, size, planes, zeros):
        self.size, self.planes, self.zeros = size, planes, zeros
        self.levels = len(planes)
        self._ranks = {}

    @classmethod
    def build(cls, values, levels):
        current = np.asarray(values, dtype=np.uint16 if levels <= 16 else np.uint32)
        parted, high = np.empty_like(current), np.empty_like(current)
        planes, zeros = [], []
        for shift in range(levels - 1, -1, -1):
            one, plane, n_low, n_high = current.dtype.type(1 << shift), [], 0, 0
            for lo in range(0, len(current), PART):
                part = current[lo : lo + PART]
                bits = (part & one) != 0
                plane.append(np.packbits(bits, bitorder="little"))
                ones = int(np.count_nonzero(bits))
                np.compress(~bits, part, out=parted[n_low : n_low + len(part) - ones])
                np.compress(bits, part, out=high[n_high : n_high + ones])
                n_low, n_high = n_low + len(part) - ones, n_high + ones
            parted[n_low:] = high[:n_high]
            planes.append(np.concatenate(plane) if plane else np.zeros(0, dtype=np.uint8))
            zeros.append(n_low)
            current, parted = parted, (np.empty_like(current) if current is values else current)
        return cls(len(current), planes, zeros)

    def _bits(self, level):
        return np.unpackbits(self.planes[level], count=self.size, bitorder="little").view(bool)

    def values(self):
        """All ids in order: the partings undone from the last plane to the first."""
        out = np.zeros(self.size, dtype=np.uint16 if self.levels <= 16 else np.uint32)
        inner = np.empty_like(out)
        for level in range(self.levels - 1, -1, -1):
            out, inner = inner, out
            one = out.dtype.type(1 << (self.levels - 1 - level))
            low, high = 0, self.zeros[level]
            for lo in range(0, self.size, PART):
                part = out[lo : lo + PART]
                bits = np.unpackbits(self.planes[level][lo // 8 : (lo + PART) // 8], count=len(part), bitorder="little").view(bool)
                ones = int(np.count_nonzero(bits))
                part[np.flatnonzero(~bits)] = inner[low : low + len(part) - ones]
                part[np.flatnonzero(bits)] = inner[high : high + ones] | one
                low, high = low + len(part) - ones, high + ones
        return out.astype(np.uint32)

    def rank(self, level, places):
        """Ones of a plane before each place."""
        if level not in self._ranks:
            counts = POPULATION[self.planes[level]]
            padded = np.zeros(-(-max(1, len(counts)) // (BLOCK // 8)) * (BLOCK // 8), dtype=np.int64)
            padded[: len(counts)] = counts
            self._ranks[level] = np.concatenate([[0], np.cumsum(padded.reshape(-1, BLOCK // 8).sum(axis=1))])
        places = np.atleast_1d(np.asarray(places, dtype=np.int64))
        plane = np.concatenate([self.planes[level], np.zeros(BLOCK // 8 + 1, dtype=np.uint8)])
        block = places // BLOCK
        span = block[:, None] * (BLOCK // 8) + np.arange(BLOCK // 8)
        left = np.clip(places[:, None] - span * 8, 0, 8)
        part = plane[np.minimum(span, len(plane) - 1)] & ((1 << left) - 1).astype(np.uint8)
        return self._ranks[level][block] + POPULATION[part].sum(axis=1, dtype=np.int64)

    def select(self, level, bit, numbers):
        """Place of the ``numbers``-th (from 0) one or zero of a plane."""
        places = np.flatnonzero(self._bits(level) if bit else ~self._bits(level))
        return places[numbers]

    def access(self, places):
        """Ids at the given places."""
        places = np.atleast_1d(np.asarray(places, dtype=np.int64))
        out = np.zeros(len(places), dtype=np.uint32)
        for level in range(self.levels):
            ones = self.rank(level, places)
            bit = (self.planes[level][places // 8] >> (places % 8).astype(np.uint8)) & 1
            places = np.where(bit == 1, self.zeros[level] + ones, places - ones)
            out = (out << np.uint32(1)) | bit
        return out

    def _range(self, value):
        start, end = 0, self.size
        for level in range(self.levels):
            before, behind = self.rank(level, [start, end])
            if value >> (self.levels - 1 - level) & 1:
                start, end = self.zeros[level] + before, self.zeros[level] + behind
            else:
                start, end = start - before, end - behind
        return int(start), int(end)

    def count(self, value):
        """How often an id occurs."""
        start, end = self._range(value)
        return end - start

    def find(self, value):
        """All places of an id, ascending."""
        start, end = self._range(value)
        places = np.arange(start, end)
        for level in range(self.levels - 1, -1, -1):
            bit = value >> (self.levels - 1 - level) & 1
            places = self.select(level, bit, places - (self.zeros[level] if bit else 0))
        return np.sort(places)


def to_bytes(values, levels, doc_ids, ends):
    """A shard file: header, then compressed sections (document ids, their nulls and ends, bit-planes)."""
    matrix = WaveletMatrix.build(values, levels)
    press = zstandard.ZstdCompressor(level=1)
    known = np.array([d is not None for d in doc_ids], dtype=bool)
    sections = [np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(), np.packbits(known).tobytes(), np.asarray(ends, dtype="<i8").tobytes()]
    packed = [press.compress(s) for s in sections + [p.tobytes() for p in matrix.planes]]
    head = json.dumps({"size": matrix.size, "levels": levels, "docs": len(doc_ids), "zeros": matrix.zeros, "sections": [len(p) for p in packed]}).encode()
    return b"".join([MAGIC, len(head).to_bytes(4, "little"), head, *packed])


def from_bytes(payload):
    """(matrix, document ids, ends of the documents) of a shard file."""
    if payload[: len(MAGIC)] != MAGIC:
        raise ValueError("not a token shard")
    at = len(MAGIC) + 4
    size = int.from_bytes(payload[at - 4 : at], "little")
    head = json.loads(payload[at : at + size])
    at += size
    unpack, parts = zstandard.ZstdDecompressor(), []
    for length in head["sections"]:
        parts.append(unpack.decompress(payload[at : at + length]))
        at += length
    known = np.unpackbits(np.frombuffer(parts[1], dtype=np.uint8), count=head["docs"])
    doc_ids = [int(d) if k else None for d, k in zip(np.frombuffer(parts[0], dtype="<i8"), known)]
    matrix = WaveletMatrix(head["size"], [np.frombuffer(p, dtype=np.uint8) for p in parts[3:]], head["zeros"])
    return matrix, doc_ids, np.frombuffer(parts[2], dtype="<i8")


SHARDS = "part int, number int, path string, docs long, tokens long"
ARROW_SHARDS = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64())])


def write_shards(docs, tokenizer, end_id, levels, folder, shard_tokens=SHARD_TOKENS):
    """Write all documents' ids in ascending doc_id order; returns the table of shards.

    A task writes the shards of its range of ids one after another. The table of shards is
    itself written, and names exactly the files of the tasks that counted. A null text is
    empty (its document holds ``end_id`` only); a null doc_id comes first; rows of one doc_id
    are ordered by text. Columns: part, number, path, docs, tokens.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = id_and_text(docs).repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        encoder = opened(tokenizer)
        ids, doc_ids, ends, size = [], [], [], 0

        def flush():
            path = f"{folder}/{part:06d}-{number:06d}-{fresh_name()}.wm"
            write_file(path, to_bytes(np.concatenate(ids), levels, doc_ids, ends))
            return batch_of(ARROW_SHARDS, part=[part], number=[number], path=[path], docs=[len(doc_ids)], tokens=[size])

        for batch in wide_slices(batches):
            flat, stops = encoder.encode(batch.column("text"))
            begin = 0
            for doc_id, stop in zip(batch.column("doc_id").to_pylist(), stops):
                ids += [flat[begin:stop], np.array([end_id], dtype="<u4")]
                size += int(stop - begin) + 1
                begin = stop
                doc_ids.append(doc_id)
                ends.append(size)
                if size >= shard_tokens:
                    yield flush()
                    number += 1
                    ids, doc_ids, ends, size = [], [], [], 0
        if doc_ids:
            yield flush()

    return stage(ordered.mapInArrow(run, SHARDS), "token-shards")


def shard_starts(shards):
    """The shards with the number of ids before each: sums inside a task's part, then over the parts."""
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("tokens").alias("part_tokens"))
    parts = parts.select("part", F.coalesce(F.sum("part_tokens").over(before), F.lit(0)).alias("part_start"))
    inside = W.partitionBy("part").orderBy("number").rowsBetween(W.unboundedPreceding, -1)
    own = shards.withColumn("inside", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    return own.join(parts, "part").select("path", "docs", "tokens", (F.col("part_start") + F.col("inside")).alias("first"))


DOCUMENTS = "doc_id long, start long, n_tokens long, ids binary"
ARROW_DOCUMENTS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def read_documents(shards, content=True):
    """Documents read back from their shard files: doc_id, start, n_tokens, ids (unsigned 32-bit).

    ``content=False`` gives the ids' crc32 as ``ids_crc32`` instead of the ids.
    """
    spread = max(1, shards.count())
    schema = ARROW_DOCUMENTS if content else pa.schema([*list(ARROW_DOCUMENTS)[:3], ("ids_crc32", pa.int64())])

    def run(batches):
        for batch in batches:
            for path, first in zip(batch.column("path").to_pylist(), batch.column("first").to_pylist()):
                matrix, doc_ids, ends = from_bytes(read_file(path))
                ids = memoryview(matrix.values().astype("<u4")).cast("B")
                starts = np.concatenate([[0], ends[:-1]])
                runs = [ids[4 * a : 4 * b] for a, b in zip(starts, ends)]
                cells = {"ids": [bytes(r) for r in runs]} if content else {"ids_crc32": [zlib.crc32(r) for r in runs]}
                yield batch_of(schema, doc_id=doc_ids, start=starts + first, n_tokens=ends - starts, **cells)

    # As many tasks as shards: the rows are tiny, the files behind them are not.
    placed = shard_starts(shards).repartition(min(spread, 100_000), "path")
    return placed.mapInArrow(run, DOCUMENTS if content else DOCUMENTS.replace("ids binary", "ids_crc32 long"))


def occurrences(shards, token):
    """(start of the shard, count, places) of an id in every shard, looked up in the bit-planes."""

    def run(batches):
        for batch in batches:
            for path, first in zip(batch.column("path").to_pylist(), batch.column("first").to_pylist()):
                matrix = from_bytes(read_file(path))[0]
                places = matrix.find(token)
                yield batch_of(pa.schema([("first", pa.int64()), ("n", pa.int64()), ("places", pa.list_(pa.int64()))]), first=[first], n=[matrix.count(token)], places=[(places + first).tolist()])

    return shard_starts(shards).repartition(max(1, shards.count()), "path").mapInArrow(run, "first long, n long, places array<long>")


def shard_and_read(docs, tokenizer, end_id, levels):
    """Write the shards below the shared folder, then doc_id, start, n_tokens, ids_crc32 from the files."""
    shards = write_shards(docs, tokenizer, end_id, levels, fresh_dir(docs.sparkSession, "tokens"))
    return read_documents(shards, content=False)
