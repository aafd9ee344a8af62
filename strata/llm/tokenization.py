"""Worker-side encoders over the ``tokenizers`` library with bounded caches.

Most words of a corpus repeat. Arrow splits the texts of a batch into pieces and
numbers the distinct ones; a worker keeps what it has learnt of the pieces it
has met, gives only new ones to the library, and Arrow gathers the results back
into text order. Splitting a text this way never changes the library's result:

* ``WordEncoder`` splits at ASCII white space, which its vocabulary drops and
  which no match of its pre-token pattern and no special string crosses, and
  words of simple ASCII characters further into their pre-tokens;
* ``SpaceCounter`` splits at single spaces, each of which begins a pre-token of
  its vocabulary unless it stands beside another space, at white space beyond
  ASCII or within a special string; texts with those go whole to the library.

A new piece of plain characters, those with one meaning in Python's and the
library's pattern engines, is split into pre-tokens here and given to the
library's BPE model directly; every other piece goes through its full pipeline.
"""

from __future__ import annotations

import ctypes
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Entries of one generation of a worker cache (about 200 bytes each).
CACHE_ENTRIES = 150_000
# Bytes of text handled at once; bounds the pieces a worker holds.
SLICE_BYTES = 4 << 20


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE writes each byte as one printable character: printable
    Latin-1 bytes as themselves, the others from U+0100 upwards in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in table:
            table[b] = chr(0x100 + len(table) - len(plain))
    return table


_LETTERS = _byte_letters()


def byte_level(piece: str) -> str:
    if piece.isascii() and piece.isalpha():
        return piece
    return piece.encode("utf-8").decode("latin-1").translate(_LETTERS)


# Characters with one meaning in both engines and no change under NFC: ASCII
# without controls, and the letters of Latin-1 and Latin Extended-A.
_LETTER_RANGES = "À-ÖØ-öø-įı-ňŊ-ž"
_PLAIN_WORD = re.compile(f"[!-~{_LETTER_RANGES}]+")
_WORD_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")

_PLAIN_TEXT = re.compile(f"[\t\n\u000b\u000c\r -~{_LETTER_RANGES}]*")
_BYTE_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\w\s]|_)+|\s+(?!\S)|\s+")

_OPEN: dict[tuple, object] = {}


def release_memory(encoders: bool = True) -> None:
    """Give a worker's free memory back to the system at the end of a task, as idle
    workers stay; with ``encoders`` also what the encoders of other operators hold."""
    if encoders:
        _OPEN.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not this C library
        pass


def _load(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _specials(tokenizer):
    """Pattern of the special strings a text may hold, or None."""
    strings = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    return re.compile("|".join(map(re.escape, strings))) if strings else None


class _Cache:
    """Two generations: what was met since the last turn, and before it. A full
    young generation becomes the old one, so repeated keys stay and single ones
    go; at most twice ``entries`` plus one slice's keys are held. ``make`` gives
    the values of a list of new keys."""

    def __init__(self, make, entries: int, fixed: dict | None = None):
        self.make, self.entries, self.fixed = make, entries, fixed or {}
        self.young, self.old = dict(self.fixed), {}

    def look_up(self, keys: list) -> list:
        """The values of distinct ``keys``."""
        if len(self.young) >= self.entries + len(self.fixed):
            self.young, self.old = dict(self.fixed), self.young
        old, young = self.old, self.young
        values, new = list(map(young.get, keys)), []
        for i, value in enumerate(values):
            if value is None:
                value = old.get(keys[i])
                if value is None:
                    new.append(i)
                else:
                    young[keys[i]] = values[i] = value
        if new:
            for i, value in zip(new, self.make([keys[i] for i in new])):
                young[keys[i]] = values[i] = value
        return values


class WordEncoder:
    """Ids of whole texts for a lower-casing word BPE that drops white space.

    Words of simple bytes are split by the kind of their bytes, all of a slice
    at once, into runs of letters, single digits and runs of signs, which are its
    pre-tokens; any other word stays whole. Arrow numbers the distinct parts and
    one cache holds their ids."""

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        self.tokenizer = _load(path)
        self.model = self.tokenizer.model
        self.vocab_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if self.vocab_size <= 1 << 16 else np.dtype("<u4")
        self.special_rx = _specials(self.tokenizer)
        self.cache = _Cache(lambda keys: list(map(self._part, keys)), entries)

    @classmethod
    def shared(cls, path: str) -> "WordEncoder":
        key = (cls, path)
        if key not in _OPEN:
            _OPEN[key] = cls(path)
        return _OPEN[key]

    def _part(self, part: str) -> bytes:
        if part.isalpha() and part.isascii() or _SIMPLE.fullmatch(part):
            ids = [t.id for t in self.model.tokenize(part)]
        elif not _PLAIN_WORD.fullmatch(part) or "<" in part and self.special_rx and self.special_rx.search(part):
            ids = self.tokenizer.encode(part, add_special_tokens=False).ids
        else:
            ids = [t.id for piece in _WORD_PIECES.findall(part.lower()) for t in self.model.tokenize(byte_level(piece))]
        return array(self.dtype.char, ids).tobytes()

    def encode(self, texts: pa.Array, limit: int = SLICE_BYTES):
        """Yields, in order, (ids, offsets) of consecutive runs of ``texts`` of about
        ``limit`` bytes: the ids of all of them, and where each text's begin and end.
        Null: empty."""
        for run in slices(texts, limit):
            parts, at = word_parts(run)
            known = parts.dictionary_encode()
            del parts
            pa.default_memory_pool().release_unused()
            values = self.cache.look_up(_strings(known.dictionary))
            ends = np.cumsum([0, *map(len, values)])
            table = pa.Array.from_buffers(pa.large_binary(), len(values), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(values))])
            del values
            gathered = table.take(known.indices)
            if len(gathered):
                ends = np.frombuffer(gathered.buffers()[1], np.int64)[: len(gathered) + 1]
            ids = np.frombuffer(gathered.buffers()[2] or b"", self.dtype, count=ends[-1] // self.dtype.itemsize)
            del known, table
            yield ids, ends[at] // self.dtype.itemsize


# Kinds of bytes in the words of a text.
_SPACE, _LETTER, _DIGIT, _SIGN, _OTHER = range(5)


def _kinds() -> np.ndarray:
    """Kind of each byte: white space, letter, digit, sign, or not simple (beyond
    ASCII, a control, or one that may begin a contraction or a special string)."""
    kinds = np.full(256, _OTHER, np.uint8)
    for c in map(chr, range(0x21, 0x7F)):
        if c not in "'<":
            kinds[ord(c)] = _LETTER if c.isalpha() else _DIGIT if c.isdigit() else _SIGN
    kinds[list(b"\t\n\v\f\r ")] = _SPACE
    return kinds


_KINDS = _kinds()
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_SIMPLE = re.compile("[!-&(-;=-~]+")


def word_parts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The parts of all words of ``texts`` (large binary without nulls) in order,
    and the number of parts before each text and in all. A word of simple bytes
    is lower-cased and split where their kind changes and at each digit; a word
    with another byte is one part as it is."""
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    kinds = np.append(_KINDS[data], np.uint8(_SPACE))
    filled = kinds != _SPACE
    begins = filled.copy()
    begins[1:] &= (kinds[1:] != kinds[:-1]) | (kinds[1:] == _DIGIT)
    begins[bounds] = filled[bounds]
    lower = _LOWER[data]
    others = np.flatnonzero(kinds == _OTHER)
    if len(others):
        first = begins.copy()
        first[1:] &= ~filled[:-1]
        first[bounds] = filled[bounds]
        starts = np.flatnonzero(first)
        ends = np.append(starts[1:], len(data))
        whole = np.unique(np.searchsorted(starts, others, side="right") - 1)
        steps = np.zeros(len(data) + 1, np.int8)
        steps[starts[whole]] += 1
        steps[ends[whole]] -= 1
        inside = np.cumsum(steps, dtype=np.int8).astype(bool)
        begins &= ~inside | first
        lower = np.where(inside[:-1], data, lower)
    del kinds
    starts = np.flatnonzero(begins)
    lasts = filled[:-1] & (begins[1:] | ~filled[1:])
    del begins
    offsets = np.concatenate([[0], np.cumsum(np.flatnonzero(lasts) + 1 - starts)])
    parts = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(lower[filled[:-1]])])
    return parts, np.searchsorted(starts, bounds)


def _strings(parts: pa.Array) -> list[str]:
    """The strings of ``parts`` (large binary, no line ends), decoded at once."""
    if not len(parts):
        return []
    offsets = np.frombuffer(parts.buffers()[1], np.int64)[parts.offset : parts.offset + len(parts) + 1]
    data = np.frombuffer(parts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return np.insert(data, offsets[1:-1] - offsets[0], ord("\n")).tobytes().decode("utf-8").split("\n")


class SpaceCounter:
    """Id counts of whole texts for a byte-level BPE.

    Tier one is a fixed table of frequent pieces and their counts, tier two a
    bounded cache of what else the worker has met."""

    def __init__(self, path: str, frequent: dict[bytes, int], entries: int = CACHE_ENTRIES):
        self.tokenizer = _load(path)
        self.model = self.tokenizer.model
        self.special_rx = _specials(self.tokenizer)
        self.cache = _Cache(lambda keys: list(map(self._spaced, keys)), entries, frequent)
        self.pieces = _Cache(lambda keys: list(map(self._piece, keys)), entries)

    @classmethod
    def shared(cls, path: str, key: str, frequent) -> "SpaceCounter":
        held = _OPEN.get((cls, path))
        if held is None or held[0] != key:
            held = _OPEN[(cls, path)] = (key, cls(path, frequent()))
        return held[1]

    def _piece(self, piece: str) -> int:
        return len(self.model.tokenize(byte_level(piece)))

    def _spaced(self, word: bytes) -> int:
        """Ids of a piece that follows a space."""
        return self.whole(" " + word.decode("utf-8"))

    def whole(self, text: str) -> int:
        if _PLAIN_TEXT.fullmatch(text) and not ("<" in text and self.special_rx and self.special_rx.search(text)):
            return sum(self.pieces.look_up(_BYTE_PIECES.findall(text)))
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def count(self, texts: pa.Array):
        """Yields the id counts of consecutive runs of ``texts``. Null: 0."""
        for part in slices(texts):
            odd = np.flatnonzero(odd_spacing(part, self.special_rx).to_numpy(zero_copy_only=False))
            words = pc.split_pattern(part.view(pa.large_string()), " ")
            at = words.offsets.to_numpy()
            at = at - at[0]
            flat = words.flatten().view(pa.large_binary())
            known = flat.dictionary_encode()
            values = np.array(self.cache.look_up(known.dictionary.to_pylist()), np.int64)
            counts = values[known.indices.to_numpy()] if len(flat) else np.empty(0, np.int64)
            some = np.flatnonzero(np.diff(at))  # a text's first piece follows no space
            firsts = flat.take(pa.array(at[some])).to_pylist()
            counts[at[some]] = [self.whole(w.decode("utf-8")) for w in firsts]
            total = np.concatenate([[0], np.cumsum(counts)])
            out = total[at[1:]] - total[at[:-1]]
            for i in odd:
                out[i] = self.whole(part[int(i)].as_py().decode("utf-8"))
            yield out


# White space beyond ASCII, and the separators that only some engines count as white space.
_ODD_SPACE = "[\u001c-\u001f\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def odd_spacing(texts: pa.Array, special_rx) -> pa.Array:
    """True for texts that must not be split at single spaces."""
    text = texts.view(pa.large_string())
    found = pc.or_(pc.match_substring(text, "  "), pc.match_substring_regex(text, _ODD_SPACE))
    if special_rx is not None:
        found = pc.or_(found, pc.match_substring_regex(text, special_rx.pattern))
    return pc.fill_null(found, False)


def slices(texts: pa.Array, limit: int = SLICE_BYTES):
    """Consecutive runs of ``texts``, as large binary, of about ``limit`` bytes."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(texts):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield texts.slice(start, stop - start)
        start = stop
