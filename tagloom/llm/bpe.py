"""BPE encoding through a table of distinct words, and decoding through an id-to-piece join.

Encoding splits the texts into words block by block. A block keeps, for each position, the
number of its word, and the list of its distinct words. The lists go, dealt by word hash, to
the word table, where each distinct word of the corpus is encoded once; its ids return to the
blocks that asked for it and are joined to the positions. So a frequent word travels once for
each block, not once for each occurrence.
"""

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import functions as F

from tagloom.llm.common import fresh_dir, fresh_name, gathered, id_and_text, read_file, runs_within, stage, text_slices, write_file
from tagloom.llm.encoding import BYTE_CHARACTERS, opened, take_runs

BLOCK_BYTES = 16 << 20
CHUNK = 1_000_000  # words or ids handled at once
POSITIONS = -1  # the part of the row that holds a block's positions

BLOCKS = "block long, part int, words binary, path string"
ARROW_BLOCKS = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("words", pa.binary()), ("path", pa.string())])
ENCODED_WORDS = "block long, part int, ids binary"
ARROW_ENCODED_WORDS = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("ids", pa.binary())])
ENCODED = "doc_id long, ids array<int>"
ARROW_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
POSITION_FILE = pa.schema([("doc_ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("codes", pa.binary())])


def squeeze(lengths, content):
    """Lengths and content of a list of strings or runs, compressed together."""
    head = np.asarray(lengths, dtype="<u4").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(len(head).to_bytes(8, "little") + head + content)


def unsqueeze(payload):
    raw = zstandard.ZstdDecompressor().decompress(payload)
    size = int.from_bytes(raw[:8], "little")
    return np.frombuffer(raw, dtype="<u4", count=size // 4, offset=8).astype(np.int64), raw[8 + size :]


def squeeze_words(words):
    """A string array without nulls as bytes."""
    return squeeze(pc.binary_length(words).to_numpy(), b"".join(words.cast(pa.binary()).to_pylist()))


def unsqueeze_words(payload):
    lengths, content = unsqueeze(payload)
    ends = np.cumsum(lengths).tolist()
    return [content[a:b].decode() for a, b in zip([0, *ends], ends)]


def write_positions(path, doc_ids, ends, codes):
    """A block's documents and, for each position, the number of its word, as byte planes."""
    planes = codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    row = pa.RecordBatch.from_pydict({"doc_ids": [doc_ids], "ends": [ends], "codes": [zstandard.ZstdCompressor(level=3).compress(planes)]}, schema=POSITION_FILE)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, POSITION_FILE) as out:
        out.write_batch(row)
    write_file(path, sink.getvalue())


def read_positions(path):
    row = pa.ipc.open_stream(read_file(path)).read_next_batch()
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(row.column("codes")[0].as_py()), dtype=np.uint8)
    codes = planes.reshape(4, -1).T.copy().view("<u4").ravel()
    return row.column("doc_ids")[0].values, row.column("ends")[0].values.to_numpy(), codes


def split_blocks(docs, tokenizer, parts):
    """The blocks of ``docs``, staged: their distinct words by part, and where their positions are.

    The positions stay in a file of the block in the shared folder; the staged table names the
    files that count.
    """
    folder = fresh_dir(docs.sparkSession, "word-positions")

    def run(batches):
        base = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(text_slices(gathered(batches, limit=BLOCK_BYTES), limit=2 * BLOCK_BYTES)):
            codes, ends, words = opened(tokenizer).split(batch.column("text"))
            part = np.fromiter((xxhash.xxh32_intdigest(w) % parts for w in words), dtype=np.int64, count=len(words))
            listed = pa.array(words, pa.string())
            del words
            order = pc.sort_indices(pa.table({"part": part, "word": listed}), sort_keys=[("part", "ascending"), ("word", "ascending")]).to_numpy()
            place = np.empty(len(order), dtype=np.int64)
            place[order] = np.arange(len(order))
            listed, part = listed.take(pa.array(order)), part[order]
            kinds, starts = np.unique(part, return_index=True)
            cuts = [*starts, len(part)]
            path = f"{folder}/{base + number}-{fresh_name()}.positions"
            write_positions(path, batch.column("doc_id").to_pylist(), ends, place[codes])
            squeezed = [squeeze_words(listed[a:b]) for a, b in zip(cuts, cuts[1:])]
            yield pa.RecordBatch.from_pydict(
                {"block": [base + number] * (len(kinds) + 1), "part": [POSITIONS, *kinds], "words": [None, *squeezed], "path": [path] + [None] * len(kinds)}, schema=ARROW_BLOCKS
            )

    return stage(id_and_text(docs).mapInArrow(run, BLOCKS), "word-blocks")


def encode_words(words, tokenizer, parts):
    """The word table at work: every part encodes each of its distinct words once."""

    def run(batches):
        encoder, known = opened(tokenizer), {}
        for batch in batches:
            for block, part, squeezed in zip(*(batch.column(c).to_pylist() for c in ("block", "part", "words"))):
                own = unsqueeze_words(squeezed)
                new = [w for w in own if w not in known]
                flat, offsets = encoder.ids_of(new)
                encoder.forget()
                for w, a, b in zip(new, offsets, offsets[1:]):
                    known[w] = flat[a:b].tobytes()
                runs = [known[w] for w in own]
                lengths = np.fromiter(map(len, runs), dtype=np.int64, count=len(runs)) // 4
                yield pa.RecordBatch.from_pydict({"block": [block], "part": [part], "ids": [squeeze(lengths, b"".join(runs))]}, schema=ARROW_ENCODED_WORDS)

    return words.repartition(parts, "part").mapInArrow(run, ENCODED_WORDS)


def encode(docs, tokenizer):
    """(doc_id, ids) of each row's whole text.

    A null text is encoded as the empty text, to no ids; repeated rows and null ids are kept;
    other columns are not read.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = split_blocks(docs, tokenizer, parts)
    words = blocks.filter(F.col("part") > POSITIONS).select("block", "part", "words")
    found = encode_words(words, tokenizer, parts).groupBy("block").agg(F.collect_list(F.struct("part", "ids")).alias("found"))
    places = blocks.filter(F.col("part") == POSITIONS).select("block", "path")

    def run(batches):
        for batch in batches:
            for path, lists in zip(batch.column("path").to_pylist(), batch.column("found")):
                runs = [unsqueeze(f["ids"]) for f in sorted(lists.as_py(), key=lambda f: f["part"])]
                flat = np.frombuffer(b"".join(r[1] for r in runs), dtype="<u4")
                offsets = np.concatenate([[0], *(r[0] for r in runs)]).cumsum()
                doc_ids, ends, codes = read_positions(path)
                starts = np.concatenate([[0], ends[:-1]])
                for first, last in runs_within(pa.array(ends - starts), CHUNK):
                    ids, run_ends = take_runs(flat, offsets, codes[starts[first] : ends[last - 1]])
                    cut = pa.array(np.concatenate([[0], run_ends[ends[first:last] - starts[first] - 1]]).astype(np.int32))
                    yield pa.RecordBatch.from_arrays([doc_ids[first:last], pa.ListArray.from_arrays(cut, pa.array(ids.astype(np.int32)))], schema=ARROW_ENCODED)

    return places.join(found, "block").select("path", "found").mapInArrow(run, ENCODED)


_PIECES = {}


def pieces_of(tokenizer):
    """Bytes of each id of a byte-level vocabulary, in id order, with an empty piece behind the last."""
    if tokenizer not in _PIECES:
        vocabulary = opened(tokenizer).tokenizer.get_vocab(with_added_tokens=True)
        with open(tokenizer, encoding="utf-8") as source:
            added = {t["content"] for t in json.load(source)["added_tokens"]}
        byte_of = {chr(c): b for b, c in BYTE_CHARACTERS.items()}
        pieces = [b""] * (max(vocabulary.values()) + 2)
        for token, number in vocabulary.items():
            pieces[number] = token.encode() if token in added else bytes(byte_of[c] for c in token)
        _PIECES[tokenizer] = pa.array(pieces, pa.binary())
    return _PIECES[tokenizer]


def decode(encoded, tokenizer):
    """``encoded`` with its column ``ids`` replaced by ``text``; all other columns are kept.

    The ids are joined to the id-to-piece table (bounded by the vocabulary) inside the tasks.
    An id outside the vocabulary adds nothing, null ids give the empty text, and bytes that are
    no UTF-8 become replacement characters.
    """
    others = [f for f in encoded.schema.fields if f.name != "ids"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in others), "text string"])

    def run(batches):
        pieces = pieces_of(tokenizer)
        cut = (b.slice(i, j - i) for b in batches for i, j in runs_within(pc.list_value_length(b.column("ids")).fill_null(0), CHUNK))
        for batch in cut:
            lists = pc.fill_null(batch.column("ids"), [])
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
            ids = np.where((ids < 0) | (ids >= len(pieces)), len(pieces) - 1, ids)
            joined = pieces.take(pa.array(ids))
            places = np.frombuffer(joined.buffers()[1], dtype=np.int32)[joined.offset : joined.offset + len(ids) + 1] if len(ids) else np.zeros(1, np.int32)
            cuts = np.ascontiguousarray(places[np.concatenate([[0], ends])])
            data = joined.buffers()[2] if len(ids) and joined.buffers()[2] is not None else pa.py_buffer(b"")
            text = pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(cuts), data])
            try:
                text = text.cast(pa.string())
            except pa.ArrowInvalid:
                text = pa.array([t.decode("utf-8", "replace") for t in text.to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in others), text], names=[*(f.name for f in others), "text"])

    return encoded.mapInArrow(run, schema)


def round_trip(docs, tokenizer):
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row's whole text."""
    digest = F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256)
    encoded = encode(docs, tokenizer).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), digest.alias("ids_sha256"), "ids")
    return decode(encoded, tokenizer).select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
