"""Token ids of whole texts, with each distinct word of a batch encoded once.

A text is cut at spaces followed by something that is no white space. Both tokenizers used here
cut there too, so the ids of the whole are the ids of the words in turn. A text holding a space
followed by white space is left whole where the tokenizer keeps white space.
"""

import os

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from array import array  # noqa: E402

import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
import pyarrow.compute as pc  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

#: Distinct words remembered by a task between batches; those met again live on in the next generation.
CACHED_WORDS = 250_000
UNSAFE_SPACE = r" [\s\x0b\x{85}\p{Z}]"
#: Characters behind a word that both tokenizers cut off (no part of a special token's spelling).
TRAILING = ".,;:!?#*$%&"

#: A line feed that has white space, or nothing, beside it.
UNSAFE_LINE = r"(?:^|[\s\x0b\x1c-\x1f\x{85}\p{Z}])\n|\n(?:$|[\s\x0b\x1c-\x1f\x{85}\p{Z}])"
#: A word whose trailing characters are cut off for all words at once: it ends in a digit or common letter.
CUT_BEHIND = r"[0-9A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}]$"
#: Runs put together at once, so that their places stay in the processor's cache.
RUNS_AT_ONCE = 1 << 15

#: Letters below this are the same in every Unicode version.
COMMON_LETTERS = "\u0250"
#: The one of them whose lower case is two characters.
DOTTED = "\u0130"


def _byte_characters():
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: b for b in printable} | {b: 256 + i for i, b in enumerate(others)}


BYTE_CHARACTERS = _byte_characters()

_OPEN = {}


def opened(path):
    """The tokenizer of a file, opened once by each worker process."""
    if path not in _OPEN:
        _OPEN[path] = WordEncoder(path)
    return _OPEN[path]


def take_runs(flat, offsets, picks):
    """Concatenate the runs ``flat[offsets[p]:offsets[p + 1]]`` in the order of ``picks``; also their ends."""
    lengths = (offsets[1:] - offsets[:-1])[picks]
    ends = np.cumsum(lengths)
    out = np.empty(int(ends[-1]) if len(ends) else 0, dtype=flat.dtype)
    shifts = offsets[:-1][picks] - (ends - lengths)
    for lo in range(0, len(picks), RUNS_AT_ONCE):
        part = slice(lo, lo + RUNS_AT_ONCE)
        start, stop = int(ends[lo] - lengths[lo]), int(ends[part][-1])
        at = np.repeat(shifts[part], lengths[part])
        at += np.arange(start, stop)
        np.take(flat, at, out=out[start:stop], mode="clip")
    return out, ends


def _behind(lines, stems):
    """What each line holds behind its stem (its first characters)."""
    width = pc.binary_length(stems).to_numpy()
    lengths = pc.binary_length(lines).to_numpy()
    offsets = np.frombuffer(lines.buffers()[1], dtype=np.int32)[lines.offset : lines.offset + len(lines) + 1].astype(np.int64)
    data = np.frombuffer(lines.buffers()[2] or b"", dtype=np.uint8)
    picks = np.flatnonzero(lengths > width)
    starts, stops = offsets[:-1][picks] + width[picks], offsets[1:][picks]
    bounds = np.empty(2 * len(picks) + 1, dtype=np.int64)  # runs of stems and tails in turn
    bounds[0:-1:2], bounds[1::2] = starts, stops
    bounds[-1] = bounds[-2] if len(picks) else 0
    tails, _ = take_runs(data, bounds, 2 * np.arange(len(picks)))
    ends = np.concatenate([[0], np.cumsum(lengths - width)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(lines), pa.py_buffer(ends), pa.py_buffer(tails))


class WordEncoder:
    """Ids of texts, equal to ``Tokenizer.encode(text, add_special_tokens=False).ids``."""

    def __init__(self, path):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        normalizer = self.tokenizer.normalizer
        #: Whether a space belongs to the word behind it; else white space is dropped and case folded.
        self.spaced = normalizer is None
        self.recent, self.older = {}, {}

    def forget(self):
        """Drop the remembered words, where a caller keeps its own."""
        self.recent, self.older = {}, {}

    def split(self, texts):
        """Words of texts (no nulls): codes, end of each text's codes, and the distinct words.

        The words are given as they must be encoded, that is, with their leading space where
        the tokenizer keeps it.
        """
        codes, ends, words = self._words(texts)
        return codes, ends, words.to_numpy(zero_copy_only=False).tolist()

    def _words(self, texts):
        """``split`` with the distinct words as an Arrow array."""
        whole = pc.match_substring_regex(texts, UNSAFE_SPACE).to_numpy(zero_copy_only=False) if self.spaced else np.zeros(len(texts), bool)
        if whole.any():
            parts = pc.if_else(pa.array(whole), pa.scalar("", texts.type), texts)
        else:
            parts = texts
        lists = pc.split_pattern(parts, " ")
        ends = lists.offsets.to_numpy()[1:].astype(np.int64) - lists.offsets[0].as_py()
        coded = lists.flatten().dictionary_encode()
        codes = coded.indices.to_numpy().astype(np.int64)
        words = coded.dictionary
        if self.spaced:  # the first word of a text has no space before it
            first = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
            head = pc.if_else(pa.array(whole), texts, lists.flatten().take(pa.array(first))).dictionary_encode()
            codes[first] = len(words) + head.indices.to_numpy()
            words = pa.concat_arrays([pc.binary_join_element_wise(pa.scalar(" ", words.type), words, pa.scalar("", words.type)), head.dictionary])
        return codes, ends, words

    def _cut(self, words):
        """Distinct words as runs of shorter pieces that are encoded independently: pieces are fewer than words.

        Words are cut at single line feeds and before trailing characters, as ``_pieces`` does for one word.
        Returns three places in the pieces for each line of a word (stem, trailing characters, line feed; the
        empty piece where there is none), the end of each word's lines, and the distinct pieces.
        """
        words = words.cast(pa.string())
        unsafe = pc.match_substring_regex(words, UNSAFE_LINE)
        lists = pc.split_pattern(pc.if_else(unsafe, pa.scalar(""), words), "\n")
        ends = lists.offsets.to_numpy()[1:].astype(np.int64) - lists.offsets[0].as_py()
        lines = lists.flatten()
        whole = unsafe.to_numpy(zero_copy_only=False)
        if whole.any():  # such a word is one line, line feeds and all
            owner = np.repeat(np.arange(len(words)), np.diff(ends, prepend=0))
            lines = pc.if_else(pa.array(whole[owner]), words.take(pa.array(owner)), lines)
        stems = pc.ascii_rtrim(lines, characters=TRAILING)
        stems = pc.if_else(pc.match_substring_regex(stems, CUT_BEHIND), stems, lines)
        coded = stems.dictionary_encode()
        tails = _behind(lines, stems)
        coded_tails = tails.dictionary_encode()
        n, m = len(coded.dictionary), len(coded_tails.dictionary)
        slots = np.full((len(lines), 3), n + m, dtype=np.int64)  # the empty piece
        slots[:, 0] = coded.indices.to_numpy()
        slots[:, 1] = n + coded_tails.indices.to_numpy()
        if self.spaced:
            slots[:, 2] = n + m + 1
            slots[ends - 1, 2] = n + m
        pieces = pa.concat_arrays([coded.dictionary, coded_tails.dictionary]).to_numpy(zero_copy_only=False).tolist()
        return slots.ravel(), 3 * ends, [*pieces, "", "\n"]

    def _pieces(self, word):
        """A word as strings that are encoded independently, in order.

        A line feed with no white space beside it is a piece of its own, or none where white space is dropped.
        """
        if "\n" in word:
            lines = word.split("\n")
            if all(a and b and not a[-1].isspace() and not b[0].isspace() for a, b in zip(lines, lines[1:])):
                pieces = list(self._pieces(lines[0]))
                for line in lines[1:]:
                    if self.spaced:
                        pieces.append("\n")
                    pieces += self._pieces(line)
                return pieces
        stem = word.rstrip(TRAILING)
        if len(stem) == len(word) or not stem[-1:].isalnum() or stem[-1] == DOTTED:
            stem, tail = word, ""
        else:
            tail = word[len(stem) :]
        if not self.spaced and stem.isascii() and "<|" not in stem:
            stem = stem.lower()
        return (stem, tail) if tail else (stem,)

    def _plain(self, piece):
        """A piece that is one word of common letters, as the model takes it; else None."""
        letters = piece[1:] if self.spaced and piece[:1] == " " else piece
        if not letters.isalpha():
            return None
        if letters.isascii():
            return "\u0120" + letters if letters is not piece else letters
        if max(letters) < COMMON_LETTERS and (self.spaced or DOTTED not in letters):
            if not self.spaced:
                piece = piece.lower()
            return piece.encode().decode("latin-1").translate(BYTE_CHARACTERS)
        return None

    def ids_of(self, words):
        """Ids of each distinct word: all ids in turn, and the offsets of the words.

        Words met before are looked up whole; only the others are taken apart.
        """
        if len(self.recent) > CACHED_WORDS:
            self.recent, self.older = {}, self.recent
        cache = self.recent
        runs = list(map(cache.get, words))
        places = self._simple(words, runs)
        if places:
            pieces = [self._pieces(words[i]) for i in places]
            self._learn({p for pair in pieces for p in pair})
            for i, own in zip(places, pieces):
                if len(own) == 1:
                    runs[i] = cache[words[i]] = cache[own[0]]
                elif len(own) == 2:
                    runs[i] = cache[words[i]] = cache[own[0]] + cache[own[1]]
                else:  # words over several lines seldom come again
                    runs[i] = b"".join([cache[piece] for piece in own])
        offsets = np.zeros(len(runs) + 1, dtype=np.int64)
        np.cumsum(np.fromiter(map(len, runs), dtype=np.int64, count=len(runs)) // 4, out=offsets[1:])
        return np.frombuffer(b"".join(runs), dtype="<u4"), offsets

    def _simple(self, words, runs):
        """Fill in the missing runs of words remembered from before or made of ASCII letters alone; the places left."""
        cache, older, spaced, tokenize = self.recent, self.older.get, self.spaced, self.tokenizer.model.tokenize
        left = []
        for i, run in enumerate(runs):
            if run is not None:
                continue
            word = words[i]
            run = older(word)
            if run is None:
                if not word.isascii():
                    left.append(i)
                    continue
                letters = word[1:] if spaced and word[:1] == " " else word
                if not letters.isalpha():
                    left.append(i)
                    continue
                if spaced:
                    plain = word if letters is word else "\u0120" + letters
                else:
                    plain = word.lower()
                    run = cache.get(plain)
                if run is None:
                    run = array("I", [t.id for t in tokenize(plain)]).tobytes()
                    if not spaced:
                        cache[plain] = run
            cache[word] = runs[i] = run
        return left

    def _learn(self, pieces):
        """Put the ids of pieces that are encoded independently into the cache."""
        cache, older = self.recent, self.older
        model, others = self.tokenizer.model, []
        for piece in pieces:
            if piece in cache:
                continue
            known = older.get(piece)
            if known is None:
                plain = self._plain(piece)
                if plain is None:
                    others.append(piece)
                    continue
                known = array("I", [t.id for t in model.tokenize(plain)]).tobytes()
            cache[piece] = known
        for start in range(0, len(others), 20_000):
            part = others[start : start + 20_000]
            for piece, found in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                cache[piece] = array("I", found.ids).tobytes()

    def encode(self, texts):
        """Ids of texts in turn and the end of each text's ids; a null text counts as empty."""
        texts = pc.fill_null(texts, "")
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        codes, word_ends, words = self._words(texts)
        slots, slot_ends, pieces = self._cut(words)
        flat, piece_ends = take_runs(*self.ids_of(pieces), slots)
        ids, run_ends = take_runs(flat, np.concatenate([[0], piece_ends[slot_ends - 1]]), codes)
        return ids, run_ends[word_ends - 1]
