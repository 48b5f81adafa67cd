"""Harmonic packing of tokenised documents into sequences.

A length belongs to the reciprocal class ``k`` when ``k`` but not ``k + 1`` pieces of it fit
into a sequence; a sequence of class ``k`` holds ``k`` pieces. Tasks number the pieces of each
class on their own; adding the counts of the tasks before turns these numbers into bins, so no
task ever looks at another's pieces. Long documents are cut to exact reciprocal lengths, which
fill their bins; only short ends stay as they are. The one bin of each class that is not full
(fewer than ``capacity`` pieces over all classes' bins) is packed by first fit.
"""

import bisect

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.llm.common import id_and_text, stage, text_slices
from tagloom.llm.encoding import opened

CAPACITY = 4096
#: Pieces of this class or above (at most 1/32 of a sequence) are not cut further.
WHOLE_CLASS = 32

PIECES = "doc_id long, start long, length long, doc_tokens long, class int, worker int, rank long, ids binary"
ARROW_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("class", pa.int32()), ("worker", pa.int32()), ("rank", pa.int64()), ("ids", pa.binary())]
)


def cut_lengths(total, capacity=CAPACITY, whole_class=WHOLE_CLASS):
    """Lengths of a document's pieces, in order."""
    lengths = [capacity] * (total // capacity)
    rest = total % capacity
    while rest:
        fit = capacity // rest
        length = rest if fit >= whole_class or rest == capacity // fit else capacity // (fit + 1)
        lengths.append(length)
        rest -= length
    return lengths


def cut(docs, tokenizer, end_id, capacity=CAPACITY, whole_class=WHOLE_CLASS):
    """Pieces of all documents with their ids (little-endian unsigned 32-bit), staged as a table.

    ``rank`` numbers the pieces of a class inside the task ``worker``. A null text is empty and
    gives one piece holding only ``end_id``; repeated rows and null ids are pieces like any.
    """

    def run(batches):
        worker = TaskContext.get().partitionId()
        seen = {}
        encoder = opened(tokenizer)
        for batch in text_slices(batches):
            ids, ends = encoder.encode(batch.column("text"))
            rows = {name: [] for name in ARROW_PIECES.names}
            begin = 0
            for doc_id, end in zip(batch.column("doc_id").to_pylist(), ends):
                own = np.append(ids[begin:end], np.uint32(end_id)).astype("<u4")
                begin, start = end, 0
                for length in cut_lengths(len(own), capacity, whole_class):
                    kind = capacity // length
                    rank = seen.get(kind, 0)
                    seen[kind] = rank + 1
                    for name, value in zip(ARROW_PIECES.names, (doc_id, start, length, len(own), kind, worker, rank, own[start : start + length].tobytes())):
                        rows[name].append(value)
                    start += length
            yield pa.RecordBatch.from_pydict(rows, schema=ARROW_PIECES)

    return stage(id_and_text(docs).mapInArrow(run, PIECES), "pieces")


def fill(pieces, capacity=CAPACITY):
    """``pieces`` with ``sequence_id`` and ``offset``; other columns are carried along.

    Every piece gets one place, sequences are gapless from 0, and no sequence exceeds ``capacity``.
    """
    counts = stage(pieces.groupBy("worker", "class").agg(F.count(F.lit(1)).alias("pieces")), "piece-counts")
    before = W.partitionBy("class").orderBy("worker").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("worker", "class", F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("first"))
    # At most 2 * sqrt(capacity) classes exist.
    classes = counts.groupBy("class").agg(F.floor(F.sum("pieces") / F.col("class")).alias("bins"))
    bins_before = W.orderBy("class").rowsBetween(W.unboundedPreceding, -1)
    classes = classes.select("class", "bins", F.coalesce(F.sum("bins").over(bins_before), F.lit(0)).alias("base"))
    placed = pieces.join(starts, ["worker", "class"]).join(F.broadcast(classes), "class")
    placed = placed.withColumn("number", F.col("first") + F.col("rank"))
    bin_of = F.floor(F.col("number") / F.col("class"))
    full = placed.filter(bin_of < F.col("bins")).withColumn("sequence_id", F.col("base") + bin_of)
    rest = placed.filter(bin_of >= F.col("bins")).select("worker", "class", "rank", "length")
    tails = stage(_first_fit(rest, capacity), "tail-bins")
    total = classes.agg(F.coalesce(F.sum("bins"), F.lit(0)).alias("total"))
    tails = tails.withColumn("sequence_id", F.col("bin") + total.scalar()).drop("bin")
    last = placed.filter(bin_of >= F.col("bins")).join(tails, ["worker", "class", "rank"])
    everything = full.unionByName(last)
    inside = W.partitionBy("sequence_id").orderBy("class", "number").rowsBetween(W.unboundedPreceding, -1)
    return everything.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0))).drop("first", "base", "bins", "number")


def _first_fit(rest, capacity):
    """Bin of each piece of the unfilled bins: one bounded group, largest pieces first."""

    def run(frame):
        frame = frame.sort_values(["length", "class", "worker", "rank"], ascending=[False, True, True, True])
        free, bins, used = [], [], 0  # free places in ascending order, each with its bin
        for length in frame["length"]:
            at = bisect.bisect_left(free, (int(length), -1))
            left, number = free.pop(at) if at < len(free) else (capacity, used)
            used = max(used, number + 1)
            bins.append(number)
            bisect.insort(free, (left - int(length), number))
        return frame.assign(bin=bins)[["worker", "class", "rank", "bin"]]

    return rest.groupBy(F.lit(0).alias("all")).applyInPandas(run, "worker int, class int, rank long, bin long")


def pack(docs, tokenizer, end_id, capacity=CAPACITY):
    """One row for each piece: doc_id, start, length, doc_tokens, ids_crc32, sequence_id, offset."""
    pieces = cut(docs, tokenizer, end_id, capacity).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return fill(pieces, capacity).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
