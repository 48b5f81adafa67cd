"""Shared helpers of the training-data operators: reading, staging, Arrow slices, shared files."""

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import functions as F

from tagloom.session import scratch_table_path

#: Text handled at once inside a task; a worker's memory is a small multiple of it.
SLICE_BYTES = 4 << 20
#: Text handled at once where each distinct word of a slice costs a lookup.
WIDE_BYTES = 16 << 20
#: Rows of text sent to Python at once.
BATCH_ROWS = 1000


def read_table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df, name):
    """Write ``df`` below the shared folder and read it back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_table_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh_dir(spark, name):
    """A new folder name below the shared folder."""
    return scratch_table_path(spark, name)


def id_and_text(docs, *more):
    """Only the needed columns, a null text read as the empty text.

    Also sees to it that batches of texts sent to Python hold few rows, as texts can be long.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *more)


def text_slices(batches, column="text", limit=SLICE_BYTES):
    """Cut record batches so that each holds at most ``limit`` bytes of text (one row at least)."""
    for batch in batches:
        for start, stop in runs_within(pc.binary_length(batch.column(column)).fill_null(0), limit):
            yield batch.slice(start, stop - start)
        pa.default_memory_pool().release_unused()


def gathered(batches, column="text", limit=SLICE_BYTES):
    """Join consecutive batches until one holds about ``limit`` bytes of text."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= limit:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def wide_slices(batches, column="text", limit=WIDE_BYTES):
    """``batches`` joined and cut to about ``limit`` bytes of text each: words repeat more often inside a wider slice."""
    return text_slices(gathered(batches, column, limit), column, limit)


def runs_within(sizes, limit):
    """Cut consecutive sizes (an Arrow array) into runs (start, stop) of at most ``limit`` in sum, one at least."""
    total = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(total):
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + limit, side="right")))
        yield start, stop
        start = stop


def store_of(uri):
    """File system and path of a shared folder, for tasks that write files of their own format."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file:///") else uri)


def write_file(uri, payload):
    """Write a whole file under its final name; names carry a fresh suffix, so a repeated task never overwrites."""
    files, path = store_of(uri)
    files.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with files.open_output_stream(path) as out:
        out.write(payload)


def read_file(uri):
    files, path = store_of(uri)
    with files.open_input_file(path) as source:
        return source.read()


def fresh_name():
    return uuid.uuid4().hex


def batch_of(schema, **columns):
    """Record batch with the columns in the order and types of an Arrow schema."""
    return pa.record_batch(
        [pa.array(columns[f.name], type=f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name].cast(f.type) for f in schema],
        schema=schema,
    )


def bounded_sample(rows, key, limit):
    """At most ``limit`` rows, those with the smallest hashes of ``key``; the chosen keys are broadcast."""
    chosen = rows.select(key).filter(F.col(key).isNotNull()).distinct().orderBy(F.xxhash64(key), key).limit(limit)
    return rows.join(F.broadcast(chosen), key, "left_semi")
