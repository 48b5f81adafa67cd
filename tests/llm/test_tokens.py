import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tagloom.llm import packing, wavelet
from tagloom.llm.common import wide_slices
from tagloom.llm.encoding import WordEncoder

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


TOKENIZERS = {path: Tokenizer.from_file(path) for path in (BYTE, WORD)}
ENCODERS = {path: WordEncoder(path) for path in (BYTE, WORD)}


def plain(path, texts):
    found = TOKENIZERS[path].encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [f.ids for f in found]


def by_words(path, texts):
    ids, ends = ENCODERS[path].encode(pa.array(texts, pa.string()))
    return [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends)]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_ids_equal_the_library(path):
    random.seed(3)
    alphabet = list("ab AB1.,'  \n\t́éÉ!<|>-_Σς\x85 　sStTmMdD") + ["<|endoftext|>", "<|startoftext|>"]
    texts = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 40))) for _ in range(4000)] + [None]
    assert by_words(path, texts) == plain(path, texts)


def test_words_over_several_lines_are_cut_at_single_line_feeds():
    texts = ["ab.\ncd ef\nGh,\nij\n", "ab\n\ncd x\r\ny \nz", "é.\nÉa o\n's <|endoftext|>\nab <|ENDOFTEXT|> <|endof\ntext|>", "a\t\nb\x85\nc\u0301 d\n\u0301e", "The the <|EndOfText|> END"]
    assert [len(ENCODERS[path]._pieces("ab.\ncd")) for path in (BYTE, WORD)] == [4, 3]
    for path in (BYTE, WORD):
        for _ in range(2):  # from the cache too
            assert by_words(path, texts) == plain(path, texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=4))
def test_ids_of_any_text(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    for path in (BYTE, WORD):
        assert by_words(path, texts) == plain(path, texts)


@pytest.mark.parametrize("source", ["documents", "odd_docs"])
def test_packing_against_the_library(source, request):
    docs = request.getfixturevalue(source)
    rows = packing.pack(docs, WORD, end_id=2).collect()
    given_rows = docs.select("doc_id", "text").collect()
    ids = plain(WORD, [r.text for r in given_rows])
    wanted = sorted((r.doc_id if r.doc_id is not None else -1, len(i) + 1) for r, i in zip(given_rows, ids))
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.doc_tokens) for r in rows if r.start == 0)
    assert got == wanted
    if source == "documents":
        by_id = {r.doc_id: np.array([*i, 2], dtype="<u4") for r, i in zip(given_rows, ids)}
        for r in rows:
            assert r.ids_crc32 == zlib.crc32(by_id[r.doc_id][r.start : r.start + r.length].tobytes())
        pieces = {}
        for r in rows:
            pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        for doc_id, own in pieces.items():
            at = 0
            for start, length in sorted(own):
                assert start == at
                at += length
            assert at == len(by_id[doc_id])
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    assert sorted(sequences) == list(range(len(sequences)))


def test_packing_pads_little(documents):
    rows = packing.pack(documents, WORD, end_id=2).collect()
    used, sequences = sum(r.length for r in rows), len({r.sequence_id for r in rows})
    assert sequences * packing.CAPACITY < 1.05 * used


def test_packing_of_nothing(no_docs):
    assert packing.pack(no_docs, WORD, end_id=2).count() == 0


@given(st.integers(1, 30_000))
def test_cut_is_whole(total):
    lengths = packing.cut_lengths(total)
    assert sum(lengths) == total and all(0 < n <= packing.CAPACITY for n in lengths)
    for n in lengths:
        kind = packing.CAPACITY // n
        assert kind * n <= packing.CAPACITY


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 255), max_size=1500))
def test_wavelet_matrix(values):
    payload = wavelet.to_bytes(np.array(values, dtype=np.uint32), 8, [1, None], [0, len(values)])
    matrix, doc_ids, ends = wavelet.from_bytes(payload)
    assert doc_ids == [1, None] and ends.tolist() == [0, len(values)]
    assert matrix.values().tolist() == values
    if values:
        assert matrix.access(np.arange(len(values))).tolist() == values
    for v in set(values[:5]) | {0, 255}:
        places = [i for i, x in enumerate(values) if x == v]
        assert matrix.count(v) == len(places) and matrix.find(v).tolist() == places


@pytest.mark.parametrize("source", ["documents", "odd_docs", "no_docs"])
def test_token_shards(source, request):
    docs = request.getfixturevalue(source)
    shards = wavelet.write_shards(docs, BYTE, 0, 16, wavelet.fresh_dir(docs.sparkSession, "t"), shard_tokens=5000)
    got = sorted(wavelet.read_documents(shards).collect(), key=lambda r: r.start)
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    ids = [[*i, 0] for i in plain(BYTE, [r.text for r in rows])]
    assert [r.doc_id for r in got] == [r.doc_id for r in rows]
    at = 0
    for r, i in zip(got, ids):
        assert (r.start, r.n_tokens) == (at, len(i)) and np.frombuffer(r.ids, "<u4").tolist() == i
        at += len(i)
    flat = [x for i in ids for x in i]
    token = flat[0] if flat else 5
    found = wavelet.occurrences(shards, token).collect()
    assert sorted(p for r in found for p in r.places) == [i for i, x in enumerate(flat) if x == token]
    digests = wavelet.read_documents(shards, content=False).collect()
    assert sorted(r.ids_crc32 for r in digests) == sorted(zlib.crc32(np.array(i, dtype="<u4").tobytes()) for i in ids)


def test_words_of_latin_letters_and_trailing_signs():
    import pyarrow as pa
    import public_tokenizers

    from tagloom.llm.encoding import TRAILING, WordEncoder

    letters = [chr(c) for c in range(0x21, 0x250) if chr(c).isalpha()]
    texts = [form for c in letters for form in (c, c + c, "Ab" + c + ".,", "x" + c + "###", " " + c + "b;")]
    texts += [word + sign * n + end for word in ("x", "1", "x²", "don't", "<|endoftext|>") for sign in TRAILING for n in (1, 2) for end in ("", "'s", "\ny")]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        encoder = WordEncoder(public_tokenizers.path(name))
        for _ in range(2):  # words met first, then words remembered
            ids, ends = encoder.encode(pa.array(texts))
            begins = [0, *ends[:-1]]
            want = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
            assert [t for t, a, b, w in zip(texts, begins, ends, want) if list(ids[a:b]) != w.ids] == []


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_words_are_cut_together_into_fewer_pieces(path):
    stems = ["ab", "x1", "Café", "İstanbulİ", "", "a\xa0", "日本"]
    words = [stem + tail for stem in stems for tail in ("", ",", "!!", "\n", ".\nab,")]
    texts = [" ".join(words[i:] + words[:i]) for i in range(len(words))] + ["", "\n", " ", None, "a  b,\nc d."]
    assert by_words(path, texts) == plain(path, texts)
    slots, ends, pieces = ENCODERS[path]._cut(pa.array(["ab", "ab,", "ab!!", "x.\nab,", "x,"]))
    assert sorted(pieces) == sorted(["ab", "x", "", ",", "!!", ".", "", "\n"])
    assert ends.tolist() == [3, 6, 9, 15, 18]
    spelled = "".join(pieces[i] for i in slots)
    assert spelled == "abab,ab!!x." + ("\n" if ENCODERS[path].spaced else "") + "ab,x,"


def test_batches_are_joined_into_wide_slices():
    batches = [pa.record_batch([pa.array([i, None]), pa.array(["x" * 50, "y" * 50])], names=["doc_id", "text"]) for i in range(10)]
    slices = list(wide_slices(iter(batches), limit=300))
    assert len(slices) <= 5 and pa.Table.from_batches(slices).equals(pa.Table.from_batches(batches))


@pytest.mark.parametrize("size", [0, 1, wavelet.PART - 1, wavelet.PART, 2 * wavelet.PART + 5])
def test_planes_are_parted_in_parts(size):
    values = np.random.default_rng(size).integers(0, 50_000, size).astype(np.uint16)
    given = values.copy()
    matrix = wavelet.WaveletMatrix.build(values, 16)
    assert (values == given).all() and (matrix.values() == given).all()
    current = given
    for level in range(16):
        ones = ((current >> (15 - level)) & 1).astype(bool)
        assert (np.packbits(ones, bitorder="little") == matrix.planes[level]).all() and matrix.zeros[level] == (~ones).sum()
        current = np.concatenate([current[~ones], current[ones]])
