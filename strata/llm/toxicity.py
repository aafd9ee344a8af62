"""Class-conditional Kneser-Ney toxicity scores.

Two models of words, toxic and ordinary, of two orders. A word is a run of letters
and digits, in lower case. The higher order is the word w after a word v (none at
the start of a text): with c_c(v, w) a class's occurrences, c(v, w) those in all
labelled text, and D the discount,

    P_c(w | v) = max(c_c(v, w) - D, 0) / c_c(v) + L_c(v) * B_c(w | v)
    B_c(w | v) = max(c(v, w) - D, 0) / c(v) + L(v) * P_c(w)

where L_c(v) and L(v) hand on what the discounts took after v. The lower order counts a
word by the distinct words that stand before it in the class's texts, as Kneser-Ney
counts do: copies of a text, however many, repeat their contexts and add nothing.
With n_c these counts and N_c their sum,

    P_c(w) = (n_c(w) - D(n_c(w))) / N_c + L_c * P(w)

where L_c hands on what the discounts took, and the shared backoff P(w) is the
Kneser-Ney model of all labelled text (distinct words before w, of either class).
D is 2; in the lower order at most 99 % of a count, so an expression with one or two
contexts in a class is left to the backoff almost wholly. Pairs seen at most twice
are left to the lower order, so only the others are kept.

A word's evidence is log P_toxic(w | v) - log P_ordinary(w | v), less what the
backoffs alone would give (in both orders, so that a class with less text does not
speak for itself), and no less than zero. A text has two length-normalised
evidences: the mean over all its words, and the mean over the two distinct words
that speak most for the toxic class, so that a few expressions count the same in a
long text. These two are taken by the lower order, whatever stands before them: the
largest of many conditional ratios would be that of some rare pair in near copies.
A logistic calibration, on labelled documents that the counts left out, turns the
evidences into a score. Counts cover every other labelled row.

Words are 64-bit hashes throughout. Texts never move: words and pairs with evidence
are broadcast, each of 16 bytes, at most BROADCAST_WORDS at once. More are cut into
shards by hash, of which a worker holds one at a time; beyond MAX_SHARDS they are
joined with the distinct pairs of each text.

Pairs are counted in cells, by the hash of the word and in large tables also by that
of the word before, so that a frequent word is in several cells. A task sends its
distinct pairs to a cell as one compressed block, and a cell is counted whole where it
arrives. What discounts take after v is its occurrences less what its frequent pairs
keep, so no pair is dealt a second time by v.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import prepare, store
from strata.llm.groups import checked_broadcast
from strata.llm.labels import fit_logistic, join_labels, remainder, training_labels
from strata.llm.tokenization import release_memory, slices

# Discounts of the class models, the least share of a count that stays, and the
# discount of the shared model.
DISCOUNT, LEAST_SHARE, SHARED_DISCOUNT = 2.0, 0.01, 0.75
# Distinct words that make the second evidence.
TELLING = 2
CALIBRATION_FOLD = 4
BROADCAST_WORDS = 1_000_000
# Shards of a larger model, at most 2 ** 16, and words looked up in all of them at once.
MAX_SHARDS, CHUNK_WORDS = 64, 2_000_000
# Bytes of labelled text to a cell of pairs, the most ranges of words that cells are made
# of (more cells are made by the word before), and pairs that a task holds.
CELL_BYTES, MAX_BANDS, HELD_PAIRS = 4 << 20, 128, 1_000_000
# Steps and ends of the evidences in the calibration's table: 150 x 400 bins at most.
PEAK_BINS, PEAK_END, MEAN_BINS, MEAN_END = 10, 15.0, 400, 1.0
# Bytes of text handled at once: each becomes several 8-byte numbers.
SLICE_BYTES = 1 << 20
RIDGE = 1e-5

_STEP = 0x9E3779B97F4A7C15
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Whether each code point is a letter or digit."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalnum() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _LETTERS[0]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pieces(raw: str, size: int = SLICE_BYTES):
    """A text in parts of about ``size`` characters that end at spaces."""
    start = 0
    while start < len(raw):
        stop = raw.find(" ", start + size) if start + size < len(raw) else -1
        stop = len(raw) if stop < 0 else stop
        yield raw[start:stop]
        start = stop


def _keys_of(text: str) -> np.ndarray:
    """64-bit hashes of the words of ``text``, in order."""
    x = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    inside = np.concatenate([[False], _letters()[x], [False]])
    begins, ends = np.flatnonzero(inside[1:-1] & ~inside[:-2]), np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
    if not len(begins):
        return np.empty(0, np.uint64)
    lengths = ends - begins
    at = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    place = np.arange(lengths.sum()) - np.repeat(at, lengths)
    letters = _mixed(x[np.repeat(begins, lengths) + place].astype(np.uint64) + np.uint64(_STEP))
    powers = np.multiply.accumulate(np.full(int(lengths.max()), _STEP, np.uint64))
    return _mixed(np.add.reduceat(letters * powers[place], at))


def word_keys(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words, offsets of the texts)."""
    found, at = [np.empty(0, np.uint64)], [0]
    for t in texts:
        raw = t.as_buffer().to_pybytes().decode("utf-8") if t.is_valid else ""
        keys = [_keys_of(piece) for piece in _pieces(raw)]
        found += keys
        at.append(at[-1] + sum(map(len, keys)))
    return np.concatenate(found), np.array(at)


class KeyTable:
    """Positions of 64-bit keys by open addressing, looked up in bulk."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(4 * len(keys) + 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.rows = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
        left, at = np.arange(len(keys)), self._home(keys)
        while len(left):
            free = self.rows[at] < 0
            slot, first = np.unique(at[free], return_index=True)
            took = left[free][first]
            self.rows[slot], self.keys[slot] = took, keys[took]
            stay = self.rows[at] != left
            left, at = left[stay], (at[stay] + 1) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(_STEP)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 where it is unknown."""
        at = self._home(keys)
        out = self.rows[at]
        wrong = np.flatnonzero((out >= 0) & (self.keys[at] != keys))
        while len(wrong):
            at[wrong] = (at[wrong] + 1) & self.mask
            out[wrong] = self.rows[at[wrong]]
            wrong = wrong[(out[wrong] >= 0) & (self.keys[at[wrong]] != keys[wrong])]
        return out


def _before(keys: np.ndarray, at: np.ndarray) -> np.ndarray:
    """32 bits of the hash before each word, 0 at the start of a text."""
    before = np.concatenate([np.zeros(1, np.uint64), keys[:-1]])[: len(keys)]
    before[at[:-1][np.diff(at) > 0]] = 0
    return before >> np.uint64(32)


def _pair_keys(keys: np.ndarray, before: np.ndarray) -> np.ndarray:
    """64-bit keys of pairs, as ``_PAIR`` makes them in Spark."""
    return keys ^ (before << np.uint64(16))


_PAIR = "w ^ shiftleft(v, 16)"


_TOXIC, _ORDINARY, _END = 1, 2, 4
_WORD, _BEFORE, _OFTEN = 0, 1, 2


def _firsts(*columns: np.ndarray) -> np.ndarray:
    """Where a row of sorted ``columns`` differs from the one before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _summed(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(w, q, n) sorted by w and q, n added up over equal ones."""
    w, q, n = map(np.concatenate, zip(*rows))
    order = np.lexsort((q, w))
    w, q, n = w[order], q[order], n[order]
    begin = _firsts(w, q)
    return w[begin], q[begin], np.add.reduceat(n, begin) if len(n) else n


def _pack(w: np.ndarray, q: np.ndarray, n: np.ndarray) -> tuple[int, int, bytes]:
    """(words, pairs, block) of sorted pairs: each word once, differences of neighbours,
    bytes of one place together."""
    begin = _firsts(w)
    runs = np.diff([*begin, len(w)]).astype(np.uint32)
    before = (q >> 3).astype(np.uint32)
    columns = (np.diff(w[begin], prepend=np.uint64(0)), runs, np.diff(before, prepend=np.uint32(0)), (q & 7).astype(np.uint8), n.astype(np.uint32))
    raw = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T.tobytes() for c in columns)
    return len(begin), len(w), pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(words: int, pairs: int, block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    types = ((np.uint64, words), (np.uint32, words), (np.uint32, pairs), (np.uint8, pairs), (np.uint32, pairs))
    raw = np.frombuffer(pa.decompress(block, sum(np.dtype(t).itemsize * k for t, k in types), codec="zstd", asbytes=True), np.uint8)
    columns, at = [], 0
    for t, k in types:
        size = np.dtype(t).itemsize
        columns.append(np.ascontiguousarray(raw[at : at + size * k].reshape(size, k).T).view(t).reshape(k))
        at += size * k
    w, runs, before, kind, n = columns
    before = np.cumsum(before, dtype=np.uint32)
    return np.repeat(np.cumsum(w, dtype=np.uint64), runs), (before.astype(np.int64) << 3) | kind, n.astype(np.int64)


def _pairs_of(texts: pa.Array, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(w, q, n) of the pairs of some texts, n their occurrences: q holds 32 bits of the
    hash before, and the class in its two lowest bits. The last word of a text comes
    once more, with _END and nothing before it."""
    keys, at = word_keys(texts)
    kind = np.where(toxic, _TOXIC, _ORDINARY)
    q = (_before(keys, at) << np.uint64(3)).astype(np.int64) | np.repeat(kind, np.diff(at))
    some = np.diff(at) > 0
    w = np.concatenate([keys, keys[at[1:][some] - 1]])
    return _summed([(w, np.concatenate([q, kind[some] | _END]), np.ones(len(w), np.int64))])


def _blocks(bands: int, salts: int):
    """(text, label) to (cell, words, pairs, block)."""
    shift = np.uint64(65 - bands.bit_length())

    def dealt(w, q, n):
        cell = (w >> shift).astype(np.int64) if bands > 1 else np.zeros(len(w), np.int64)
        cell = cell * salts + (q >> 3) % salts
        order = np.argsort(cell, kind="stable")
        cell, w, q, n = cell[order], w[order], q[order], n[order]
        begin = _firsts(cell)
        blocks = [_pack(w[i:j], q[i:j], n[i:j]) for i, j in zip(begin, [*begin[1:], len(w)])]
        return pa.RecordBatch.from_arrays([pa.array(cell[begin]), *map(pa.array, zip(*blocks))], ["cell", "words", "pairs", "block"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            labels, done = batch.column(1).to_numpy(zero_copy_only=False), 0
            for part in slices(batch.column(0), SLICE_BYTES):
                held.append(_pairs_of(part, labels[done : done + len(part)] == 1))
                done += len(part)
                size += len(held[-1][0])
                if size > HELD_PAIRS:
                    held = [_summed(held)]
                    size = len(held[0][0])
                    if size > HELD_PAIRS // 2:
                        yield dealt(*held[0])
                        held, size = [], 0
        if size:
            yield dealt(*_summed(held))
        held.clear()  # before freed memory goes back, as idle workers stay
        release_memory()

    return run


_FOUND = ["kind", "w", "v", "t", "o", "n", "ct", "co"]


def _counted(discount: float):
    """Blocks, those of a cell together, to _FOUND: what a cell holds of a _WORD (ct and co,
    its occurrences before another word), its starts of texts as a _BEFORE, and its
    pairs beyond the discount."""

    def counts(held):
        w, q, n = _summed(held)
        begin = _firsts(w, q >> 2)  # a pair, both classes
        toxic = q & 3 == _TOXIC
        t, o = (np.add.reduceat(np.where(c, n, 0), begin) for c in (toxic, ~toxic))
        w, v, end = w[begin], q[begin] >> 3, q[begin] & _END > 0
        words = _firsts(w)
        of = lambda x: np.add.reduceat(x.astype(np.int64), words)
        sign = np.where(end, -1, 1)
        yield _WORD, w[words], np.zeros(len(words), np.int64), of((t > 0) & ~end), of((o > 0) & ~end), of(~end), of(t * sign), of(o * sign)
        if end.any():
            none = np.zeros(1, np.int64)
            yield _BEFORE, none.view(np.uint64), none, none, none, none, t[end].sum(keepdims=True), o[end].sum(keepdims=True)
        often = (t + o > discount) & ~end
        none = np.zeros(np.count_nonzero(often), np.int64)
        yield _OFTEN, w[often], v[often], t[often], o[often], (t + o)[often], none, none

    def rows(held):
        for kind, w, *values in counts(held):
            made = [pa.array(np.full(len(w), kind, np.int32)), pa.array(w.view(np.int64)), *map(pa.array, values)]
            batch = pa.RecordBatch.from_arrays(made, _FOUND)
            for i in range(0, len(w), 1 << 16):
                yield batch.slice(i, 1 << 16)

    def run(batches):
        cell, held, size, most = None, [], 0, HELD_PAIRS
        for batch in batches:
            for at, words, pairs, block in zip(*(batch.column(i) for i in range(4))):
                if at.as_py() != cell:
                    if held:
                        yield from rows(held)
                    cell, held, size, most = at.as_py(), [], 0, HELD_PAIRS
                held.append(_unpack(words.as_py(), pairs.as_py(), block.as_py()))
                size += len(held[-1][0])
                if size > most:
                    held = [_summed(held)]
                    size = len(held[0][0])
                    most = max(HELD_PAIRS, 2 * size)
        if held:
            yield from rows(held)
        held.clear()
        release_memory()

    return run


def count_words(docs: DataFrame, known: DataFrame, discount: float = DISCOUNT) -> DataFrame:
    """(kind, w, v, t, o, n, c), stored, of both orders from one pass over the pairs:
    t for the toxic class, o for the ordinary one, n for both. _WORD: distinct words
    before w. _BEFORE: what the discounts take after v, and c, the occurrences of v.
    _OFTEN: occurrences of the pairs beyond the discount."""
    train = join_labels(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), known.where(remainder("doc_id") != CALIBRATION_FOLD))
    cells = (train.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0) // CELL_BYTES + 1
    bands = 1
    while bands < min(cells, MAX_BANDS):
        bands *= 2
    salts = -(-cells // bands)
    blocks = train.select("text", "label").mapInArrow(_blocks(bands, salts), "cell long, words long, pairs long, block binary")
    counted = blocks.repartition("cell").sortWithinPartitions("cell").mapInArrow(_counted(float(discount)), "kind int, " + ", ".join(f"{c} long" for c in _FOUND[1:]))
    found = store(counted, "toxicity-found")
    columns = ["t", "o", "n", "c"]

    def row(kind, w, v, *values):
        return [F.lit(kind).alias("kind"), w.alias("w"), v.alias("v"), *(x.cast("double").alias(c) for x, c in zip(values, columns))]

    d, none, t, o, ct, co = F.lit(float(discount)), F.lit(0).cast("long"), F.col("t"), F.col("o"), F.col("ct"), F.col("co")
    words = found.where(F.col("kind") == _WORD)
    if salts > 1:
        words = words.groupBy("w").agg(*(F.sum(c).alias(c) for c in _FOUND[3:]))
    often = found.where(F.col("kind") == _OFTEN)
    # the discounts take all of a word's occurrences but what its frequent pairs keep
    kept = lambda x: F.least(d - x, F.lit(0.0))
    seen = found.where(F.col("kind") != _OFTEN).select(*row(_BEFORE, none, F.shiftrightunsigned("w", 32), ct, co, ct + co, ct + co))
    taken = seen.unionAll(often.select(*row(_BEFORE, none, F.col("v"), kept(t), kept(o), kept(t + o), none)))
    taken = taken.groupBy("kind", "w", "v").agg(*(F.sum(c).alias(c) for c in columns))
    totals = store(words.select(*row(_WORD, F.col("w"), none, t, o, F.col("n"), none)).unionAll(taken), "toxicity-counts")
    return totals.unionAll(often.select(*row(_OFTEN, F.col("w"), F.col("v"), t, o, t + o, none)))


def lower_order(counts: DataFrame, discount: float = DISCOUNT) -> DataFrame | None:
    """(w, pt, po, e), stored, of the words of the toxic class: P_toxic(w), P_ordinary(w)
    times the ratio of the backoffs, and the evidence, log pt - log po. None if a
    class has no words."""
    words = counts.where(F.col("kind") == _WORD)
    kept = lambda c: F.greatest(F.col(c) - F.lit(float(discount)), F.col(c) * F.lit(LEAST_SHARE))
    s = words.agg(*(F.sum(c).alias(c) for c in ("t", "o", "n")), F.sum(kept("t")).alias("kt"), F.sum(kept("o")).alias("ko"), F.count("*").alias("words")).first()
    if not s["t"] or not s["o"]:
        return None
    lt, lo = 1 - s["kt"] / s["t"], 1 - s["ko"] / s["o"]
    shared = (F.col("n") - SHARED_DISCOUNT) / s["n"] + SHARED_DISCOUNT * s["words"] / s["n"] / (s["words"] + 1)
    po = (kept("o") / s["o"] + lo * shared) * F.lit(float(lt / lo))
    both = words.where("t > 0").select("w", (kept("t") / s["t"] + lt * shared).alias("pt"), po.alias("po"))
    return store(both.withColumn("e", F.log(F.col("pt") / F.col("po"))), "toxicity-lower")


def higher_order(counts: DataFrame, lower: DataFrame, discount: float = DISCOUNT) -> DataFrame:
    """(w, p, e), stored: the pairs, p their key, whose evidence is not that of w alone.

    Where w is unknown to the toxic class the pair is too, and neither order speaks
    for it, so such words are left out."""
    d = F.lit(float(discount))
    often = store(counts.where(F.col("kind") == _OFTEN).select("w", "v", "t", "o", "n").join(lower, "w"), "toxicity-often")
    taken = counts.where(F.col("kind") == _BEFORE).select("v", F.col("t").alias("dt"), F.col("o").alias("do"), F.col("n").alias("dn"), "c")
    both = taken.join(checked_broadcast(often, BROADCAST_WORDS), "v").withColumn("seen", (F.col("n") - d) / F.col("c"))
    for p in ("pt", "po"):
        both = both.withColumn(p, F.col("seen") + F.col("dn") / F.col("c") * F.col(p))
    own = lambda c, left: F.when(F.col(c) > d, (F.col(c) - d) / F.col(left)).otherwise(0.0)
    value = F.greatest(F.log((own("t", "dt") + F.col("pt")) / (own("o", "do") + F.col("po"))), F.lit(0.0))
    pairs = both.select("w", F.expr(_PAIR).alias("p"), value.alias("value"), "e").where("value <> greatest(e, 0.0D)")
    return store(pairs.select("w", "p", F.col("value").alias("e")), "toxicity-pairs")


def fit_counts(docs: DataFrame, known: DataFrame, discount: float = DISCOUNT) -> DataFrame | None:
    """(w, e): the words with evidence for the toxic class, whatever stands before
    them. None if a class has no words."""
    lower = lower_order(count_words(docs, known, discount), discount)
    return None if lower is None else _telling(lower)


def _telling(lower: DataFrame) -> DataFrame:
    return lower.where("e > 0").select("w", "e")


def _text_evidence(keys: np.ndarray, at: np.ndarray, own: np.ndarray, every: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mean over the most telling distinct words, mean over all words) per text, from
    each word's evidence by itself, 0 if it has none, and with the word before it."""
    n = len(at) - 1
    mean = np.bincount(np.repeat(np.arange(n), np.diff(at)), every, n) / np.maximum(np.diff(at), 1)
    hits = np.flatnonzero(own)
    owner, value, word = np.searchsorted(at, hits, side="right") - 1, own[hits], keys[hits]
    order = np.lexsort((word, -value, owner))
    first = order[_firsts(owner[order], word[order])]
    owner, value = owner[first], value[first]
    place = np.arange(len(owner)) - np.searchsorted(owner, owner)
    some = place < TELLING
    return np.bincount(owner[some], value[some], n) / TELLING, mean


def _found_in(tables: tuple, keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(own, every) of ``_text_evidence`` from the whole model."""
    (table, e), (pair_table, pair_e) = tables
    own = np.zeros(len(keys))
    rows = table.find(keys)
    hits = np.flatnonzero(rows >= 0)
    own[hits] = e[rows[hits]]
    every = own.copy()
    if len(pair_e):
        found = pair_table.find(_pair_keys(keys, _before(keys, at)))
        known = np.flatnonzero(found >= 0)
        every[known] = pair_e[found[known]]
    return own, every


def _found_in_shards(shards: list[Broadcast], keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same from shards, each loaded once and let go: shard i of 2 ** b holds the keys
    whose highest b bits are i. Those of a pair are its word's."""
    shift = np.uint64(65 - len(shards).bit_length())
    both = []
    for wanted in (keys, _pair_keys(keys, _before(keys, at))):
        order = np.argsort(wanted)
        wanted = wanted[order]
        both.append((order, wanted, np.searchsorted(wanted >> shift, np.arange(len(shards) + 1, dtype=np.uint64)), np.full(len(keys), np.nan)))
    for i, shard in enumerate(shards):
        if both[0][2][i] == both[0][2][i + 1]:
            continue
        for (order, wanted, ends, out), (have, e) in zip(both, shard.value):
            if len(have):
                mine = slice(ends[i], ends[i + 1])
                rows = np.minimum(np.searchsorted(have, wanted[mine]), len(have) - 1)
                out[order[mine]] = np.where(have[rows] == wanted[mine], e[rows], np.nan)
        if hasattr(shard, "_path"):  # it can be loaded again
            vars(shard).pop("_value", None)
    own, pair = both[0][3], both[1][3]
    own = np.where(np.isnan(own), 0.0, own)
    return own, np.where(np.isnan(pair), own, pair)


def _scored_batches(batches, place: int, names: list[str], look_up, chunk: int):
    """The batches with ``peak`` and ``mean`` of the texts in column ``place``, looked up
    about ``chunk`` words and texts at a time."""
    waiting, held, size, peaks, means = [], [], 0, np.empty(0), np.empty(0)

    def resolve():
        keys = np.concatenate([k for k, _ in held])
        at = np.concatenate([[0], *(a[1:] + base for (_, a), base in zip(held, np.cumsum([0, *(len(k) for k, _ in held)])))])
        peak, mean = _text_evidence(keys, at, *look_up(keys, at))
        held.clear()
        return np.concatenate([peaks, peak]), np.concatenate([means, mean])

    def ready():
        nonlocal peaks, means
        while waiting and waiting[0][0] <= len(peaks):
            rows, columns = waiting.pop(0)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(peaks[:rows]), pa.array(means[:rows])], [*names, "peak", "mean"])
            peaks, means = peaks[rows:], means[rows:]

    for batch in batches:
        waiting.append((batch.num_rows, batch.columns[:place]))
        for part in slices(batch.column(place), SLICE_BYTES):
            held.append(word_keys(part))
            size += len(held[-1][0]) + len(part)
            if size >= chunk:
                peaks, means = resolve()
                size = 0
        yield from ready()
    if held:
        peaks, means = resolve()
    yield from ready()
    release_memory()


def _named(docs: DataFrame, columns: list[str]) -> tuple[DataFrame, list[str]]:
    """``columns`` as c0, c1, ..., so that no name clashes, and the text as t."""
    names = [f"c{i}" for i in range(len(columns))]
    return docs.select(*(F.col(c).alias(n) for c, n in zip(columns, names)), F.col("text").alias("t")), names


def evidence(docs: DataFrame, model: dict, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` as c0, c1, ... with ``peak`` and ``mean``, a text's two
    evidences."""
    spark = prepare(docs.sparkSession)
    table, limit = model["table"], model.get("entries", BROADCAST_WORDS)
    pairs = model["pairs"] if "pairs" in model else spark.createDataFrame([], "w long, p long, e double")
    if "few" not in model:
        size = table.count() + pairs.count()
        model["few"], model["shards"] = size <= limit, 1
        while model["shards"] * limit < size <= MAX_SHARDS * limit:
            model["shards"] *= 2
    if not model["few"] and model["shards"] == 1:
        return _joined_evidence(docs, table, pairs, columns)
    if "shared" not in model:
        model["shared"] = [spark.sparkContext.broadcast(_shard(table, pairs, i, model["shards"])) for i in range(model["shards"])]
    shared = model["shared"]
    named, names = _named(docs, columns)

    def run(batches):
        if len(shared) > 1:
            return _scored_batches(batches, len(names), names, lambda *x: _found_in_shards(shared, *x), CHUNK_WORDS)
        tables = tuple((KeyTable(keys), e) for keys, e in shared[0].value)
        return _scored_batches(batches, len(names), names, lambda *x: _found_in(tables, *x), 1)

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in named.schema.fields[:-1])
    return named.mapInArrow(run, ddl + ", peak double, mean double")


def _shard(table: DataFrame, pairs: DataFrame, i: int, shards: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted keys and evidences of the words and of the pairs in shard ``i``."""
    held = []
    for rows, key in ((table, "w"), (pairs, "p")):
        mine = rows if shards == 1 else rows.where(F.shiftrightunsigned(key, 65 - shards.bit_length()) == i)
        got = mine.select(key, "e").toArrow()
        keys = got[key].to_numpy().view(np.uint64)
        order = np.argsort(keys)
        held.append((keys[order], got["e"].to_numpy()[order]))
    return held


def _joined_evidence(docs: DataFrame, table: DataFrame, pairs: DataFrame, columns: list[str]) -> DataFrame:
    """The same by a join of the texts' distinct pairs with the model."""
    named, names = _named(docs, columns)
    texts = store(named.withColumn("row", F.monotonically_increasing_id()), "toxicity-texts")

    def run(batches):
        for batch in batches:
            done = 0
            for part in slices(batch.column(1), SLICE_BYTES):
                keys, at = word_keys(part)
                owner = np.repeat(np.arange(done, done + len(part)), np.diff(at))
                pair = _pair_keys(keys, _before(keys, at))
                order = np.lexsort((pair, keys, owner))
                keys, pair, owner = keys[order], pair[order], owner[order]
                new = np.ones(len(keys), bool)
                new[1:] = (keys[1:] != keys[:-1]) | (pair[1:] != pair[:-1]) | (owner[1:] != owner[:-1])
                begin = np.flatnonzero(new)
                times, owner = np.diff([*begin, len(keys)]), owner[begin]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(owner)), pa.array(keys[begin].view(np.int64)), pa.array(pair[begin].view(np.int64)), pa.array(times / np.diff(at)[owner - done])],
                    ["row", "w", "p", "share"],
                )
                done += len(part)
        release_memory()

    # words that speak alone or in some pair; in the mean a pair's evidence goes first
    words = table.unionByName(pairs.select("w", F.lit(0.0).alias("e"))).groupBy("w").agg(F.max("e").alias("e"))
    found = texts.select("row", "t").mapInArrow(run, "row long, w long, p long, share double").join(words, "w")
    found = found.join(pairs.select("p", F.col("e").alias("pe")), "p", "left")
    found = found.groupBy("row", "w").agg(F.max("e").alias("e"), F.sum(F.col("share") * F.coalesce("pe", "e")).alias("part"))
    best = F.slice(F.sort_array(F.collect_list("e"), asc=False), 1, TELLING)
    sums = found.groupBy("row").agg((F.aggregate(best, F.lit(0.0), lambda a, x: a + x) / TELLING).alias("peak"), F.sum("part").alias("mean"))
    zero = F.lit(0.0)
    return texts.drop("t").join(sums, "row", "left").select(*names, F.coalesce("peak", zero).alias("peak"), F.coalesce("mean", zero).alias("mean"))


def fit_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", discount: float = DISCOUNT, entries: int = BROADCAST_WORDS) -> dict:
    """Counts and calibration. With only one class labelled, or none, scores are
    that class's label, or 0."""
    prepare(docs.sparkSession)
    known = store(training_labels(labels, label), "labels")
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if set(totals) != {0, 1}:
        return {"constant": float(next(iter(totals), 0))}
    counts = count_words(docs, known, discount)
    lower = lower_order(counts, discount)
    if lower is None:
        return {"constant": 0.0}
    model = {"table": _telling(lower), "pairs": higher_order(counts, lower, discount), "entries": entries}
    held = join_labels(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), known.where(remainder("doc_id") == CALIBRATION_FOLD))
    # every calibration row counts, by bins of the evidences: a bounded table
    bin_of = lambda c, steps, end: F.round(F.least(F.col(c), F.lit(end)) * steps).alias(c)
    bins = evidence(held, model, ["label"]).groupBy(F.col("c0").alias("label"), bin_of("peak", PEAK_BINS, PEAK_END), bin_of("mean", MEAN_BINS, MEAN_END)).count().toPandas()
    if bins["label"].nunique() < 2:
        return {"constant": totals[1] / (totals[0] + totals[1])}
    x = np.column_stack([bins["peak"] / PEAK_BINS, bins["mean"] / MEAN_BINS])
    model["calibration"] = fit_logistic(x, bins["label"].to_numpy(np.float64), bins["count"].to_numpy(np.float64), RIDGE)
    return model


def _scored(docs: DataFrame, model: dict, columns: list[str]) -> DataFrame:
    names = [f"c{i}" for i in range(len(columns))]
    if "constant" in model:
        return docs.select(*(F.col(c).alias(n) for c, n in zip(columns, names)), F.lit(model["constant"]).alias("score"))
    c = model["calibration"]
    margin = F.lit(float(c["w"][0]))
    for i, name in enumerate(("peak", "mean")):
        margin = margin + (F.col(name) - F.lit(float(c["mean"][i]))) / F.lit(float(c["spread"][i])) * F.lit(float(c["w"][i + 1]))
    return evidence(docs, model, columns).select(*names, (1 / (1 + F.exp(-margin))).alias("score"))


def score_toxicity(docs: DataFrame, model: dict, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` with ``score``, the probability of label 1, from the
    whole text alone. Null and empty texts score as texts without evidence; every
    row, repeated or of null id, gets its own score; empty tables stay empty."""
    return _scored(docs, model, columns).toDF(*columns, "score")


def keep_ordinary(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns, whatever
    their names. Null and empty texts have no evidence, so they stay; repeated rows
    and null ids are judged row by row; an empty table stays empty."""
    scored = _scored(docs, fit_toxicity(docs, labels), docs.columns).where(F.col("score") < threshold)
    return scored.drop("score").toDF(*docs.columns)


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted for every document, from its text alone.
    Null and empty texts score as texts without evidence; null and repeated ids give
    one row each (a null id is held out as the crc32 of empty text is 0); other
    columns are not read, so they may have any name; an empty table stays empty."""
    scored = score_toxicity(docs, fit_toxicity(docs, labels), ["doc_id"])
    return scored.select("doc_id", (remainder("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
