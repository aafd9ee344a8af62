"""Runs of periodic words by descending-LCP Kruskal, and their collapse.

A run is a stretch of words with smallest period q, at least ``exponent`` times as
long as q, that no neighbouring word extends with that period. Per document:

1. Suffixes are sorted by prefix doubling; only classes that still hold several
   suffixes are refined. The ranks of every doubling give the longest common
   prefix (LCP) of neighbours in the order.
2. Neighbours are united by decreasing LCP, as Kruskal adds edges: a union-find
   over suffix classes, each with its positions in text order, the smaller class
   put into the larger one.
3. Positions i < j that become adjacent in a class at LCP l repeat l words at the
   distance q = j - i. With q <= l that is a stretch of period q from i to j + l;
   it is a run's first pair, and so the run's seed, if the word before i differs
   from the word before j. Each run is seeded once: its two first positions meet
   at their own LCP, and a primitive period has no occurrence in between.

All documents of a slice are sorted together in numpy; words of different
documents never compare equal. Texts stay in their task: nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import prepare
from strata.llm.tokenization import release_memory, slices

EXPONENT, MIN_LENGTH = 4, 6
# Bytes of text handled at once; a longer text is handled alone.
SLICE_BYTES = 2 << 20
# Positions of one bucket of a large ordered set.
BUCKET = 512


class OrderedPositions:
    """Positions in ascending order, in buckets: insertion and neighbours in
    about the square root of their number at worst."""

    __slots__ = ("buckets", "firsts", "size")

    def __init__(self, position: int):
        self.buckets, self.firsts, self.size = [[position]], [position], 1

    def __iter__(self):
        for bucket in self.buckets:
            yield from bucket

    def insert(self, x: int) -> tuple[int, int]:
        """Insert ``x``; (the position before it, the one after it), -1 if none."""
        b = max(bisect_right(self.firsts, x) - 1, 0)
        bucket = self.buckets[b]
        at = bisect_left(bucket, x)
        before = bucket[at - 1] if at else (self.buckets[b - 1][-1] if b else -1)
        after = bucket[at] if at < len(bucket) else (self.firsts[b + 1] if b + 1 < len(self.firsts) else -1)
        bucket.insert(at, x)
        self.firsts[b] = bucket[0]
        self.size += 1
        if len(bucket) > 2 * BUCKET:
            self.buckets.insert(b + 1, bucket[BUCKET:])
            self.firsts.insert(b + 1, bucket[BUCKET])
            del bucket[BUCKET:]
        return before, after


def suffix_neighbours(words: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, lcp) of neighbouring suffixes i, j in sorted order with lcp >= ``least``.

    ``words``: numbers that are equal only for equal words of one document, in
    document order; ``ends``: for each word the end of its document. Memory: 4
    bytes a word for each doubling that leaves equal suffixes."""
    n = len(words)
    none = np.empty(0, np.int64)
    if n < 2:
        return none, none, none
    order = np.argsort(words, kind="stable")
    ordered = words[order]
    first = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    slot = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n + 1, np.int32)
    rank[order], rank[n] = slot, -1
    levels, h, pairs = [rank.copy()], 1, []
    active = order[_repeated(slot)]
    while len(active):
        # ranks of active suffixes by their next h words; what ends before is smallest
        ahead = active + h
        nxt = np.where(ahead < ends[active], rank[np.minimum(ahead, n)].astype(np.int64) + 1, 0)
        own = rank[active].astype(np.int64)
        key = own * (n + 2) + nxt
        by = np.argsort(key, kind="stable")
        active, own, key = active[by], own[by], key[by]
        place = np.arange(len(active))
        group = np.concatenate([[True], own[1:] != own[:-1]])
        fresh = np.concatenate([[True], key[1:] != key[:-1]])
        base = np.maximum.accumulate(np.where(group, place, 0))
        slot = own + np.maximum.accumulate(np.where(fresh, place, 0)) - base
        rank[active] = slot
        h *= 2
        # neighbours that part here share between h / 2 and h words
        part = np.flatnonzero(fresh[1:] & ~group[1:]) if h > least else none
        pairs.append((active[part], active[part + 1], np.full(len(part), len(levels) - 1)))
        keep = _repeated(slot)
        active = active[keep]
        levels.append(rank.copy() if len(active) else None)
    i, j, top = (np.concatenate(c) for c in zip(*pairs)) if pairs else (none, none, none)
    lcp = np.zeros(len(i), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        if levels[level] is None:
            continue
        a, b = np.minimum(i + lcp, n), np.minimum(j + lcp, n)
        same = (levels[level][a] == levels[level][b]) & (top >= level)
        lcp += np.where(same, 1 << level, 0)
        levels[level] = None
    keep = lcp >= least
    return i[keep], j[keep], lcp[keep]


def _repeated(slot: np.ndarray) -> np.ndarray:
    """Whether another entry of the sorted ``slot`` is equal."""
    same = slot[1:] == slot[:-1]
    return np.concatenate([same, [False]]) | np.concatenate([[False], same])


def seeded_runs(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, exponent: int = EXPONENT, min_length: int = MIN_LENGTH) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period; ``starts`` and
    ``ends`` give each word's document."""
    least = min(max((exponent - 1) * q, min_length - q) for q in range(1, min_length + 1))
    i, j, lcp = suffix_neighbours(words, ends, max(least, 1))
    by = np.argsort(-lcp, kind="stable")
    parent: dict[int, int] = {}
    sets: dict[int, OrderedPositions] = {}
    runs = []

    def root(x: int) -> int:
        r = x
        while (up := parent.get(r, r)) != r:
            r = up
        while parent.get(x, r) != r:
            parent[x], x = r, parent[x]
        return r

    def seed(a: int, b: int, shared: int) -> None:
        q = b - a
        if shared >= (exponent - 1) * q and q + shared >= min_length:
            if a == starts[a] or words[a - 1] != words[b - 1]:
                runs.append((a, q + shared, q))

    for a, b, shared in zip(i[by].tolist(), j[by].tolist(), lcp[by].tolist()):
        a, b = root(a), root(b)
        small, large = sets.pop(a, None) or OrderedPositions(a), sets.pop(b, None) or OrderedPositions(b)
        if small.size > large.size:
            small, large, a, b = large, small, b, a
        parent[a] = b
        sets[b] = large
        moved = list(small)
        for k, x in enumerate(moved):
            before, after = large.insert(x)
            # neighbours within the smaller class met earlier
            if before >= 0 and not (k and moved[k - 1] == before):
                seed(before, x, shared)
            if after >= 0 and not (k + 1 < len(moved) and moved[k + 1] < after):
                seed(x, after, shared)
    return sorted(runs)


def _documents(words: pa.Array, at: np.ndarray):
    """(runs, kept) of the documents ``at[d]`` to ``at[d + 1]`` of ``words``: a list
    of runs for each, starts within the document, and which words stay."""
    known = words.dictionary_encode()
    lengths = np.diff(at)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    codes = owner * max(len(known.dictionary), 1) + known.indices.to_numpy(zero_copy_only=False)
    starts, ends = at[:-1][owner], at[1:][owner]
    runs: list[list] = [[] for _ in lengths]
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in seeded_runs(codes, starts, ends):
        d = int(owner[start])
        runs[d].append((start - int(at[d]), length, period))
        drop[start + period] += 1
        drop[start + length] -= 1
    return runs, np.cumsum(drop)[:-1] == 0


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words, offsets of texts): runs of characters other than ASCII white space."""
    lists = pc.ascii_split_whitespace(texts.view(pa.large_string()))
    flat = lists.flatten()
    some = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return flat.filter(pa.array(some)), np.concatenate([[0], np.cumsum(some)])[at]


def _best(runs: list) -> tuple:
    """The run of greatest exact length / period; ties: smallest start, then period."""
    best = runs[0]
    for run in runs[1:]:
        if run[1] * best[2] > best[1] * run[2]:  # runs ascend by start and period
            best = run
    return best


def _row(runs: list) -> tuple:
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    digest = hashlib.sha256(lines.encode()).hexdigest()
    if not runs:
        return 0, None, None, None, None, digest
    s, n, q = _best(runs)
    return len(runs), s, n, q, 1000 * n // q, digest


_FIELDS = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string"


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_runs, the run of greatest exponent (start,
    length, period, exponent_milli), runs_sha256 over all runs, ``runs`` as an
    array of (start, length, period), and ``collapsed``: the words that no run
    holds after its first period, joined by one space.

    Null and empty texts have no words, no runs and an empty collapsed text. Null
    and repeated ids give one row each. Only the two named columns are read, so
    others may have any name. An empty table gives an empty result. A text of any
    length is handled whole, in one task."""
    prepare(docs.sparkSession)
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(batches):
        for batch in batches:
            done = 0
            for part in slices(batch.column(1), SLICE_BYTES):
                words, at = _split(part)
                runs, kept = _documents(words, at)
                left = pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(kept)])[at], words.filter(pa.array(kept)))
                rows = list(zip(*(_row(r) for r in runs)))
                numbers = [pa.array(c, pa.int64()) for c in rows[:5]]
                spans = pa.array([[dict(zip(("start", "length", "period"), r)) for r in doc] for doc in runs], run_type)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, len(part)), *numbers, pa.array(rows[5], pa.string()), spans, pc.binary_join(left, pa.scalar(" ", pa.large_string())).cast(pa.string())],
                    ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "runs", "collapsed"],
                )
                done += len(part)
        release_memory()

    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return named.mapInArrow(work, f"doc_id long, {_FIELDS}, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def made_periodic(docs: DataFrame) -> DataFrame:
    """The stated input of the query: in documents whose crc32 of the id in
    decimal is divisible by ten, the words from a on repeat the p words from a. A
    null id counts as empty text (crc32 0)."""
    words = F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    some = docs.select("doc_id", "text", h.alias("h")).withColumn("w", F.when(F.col("h") % 10 == 0, words))
    g, n = F.floor(F.col("h") / 10), F.size("w").cast("long")
    some = some.withColumn("a", F.when(n > 0, g % n)).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + g % 8)))
    repeated = F.expr("array_join(transform(w, (x, i) -> IF(i < a, x, w[CAST(a + (i - a) % p AS INT)])), ' ')")
    return some.select("doc_id", F.when(F.col("a").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


def run_digests(docs: DataFrame) -> DataFrame:
    """The digest columns of ``periodic_runs`` over ``made_periodic`` documents."""
    found = periodic_runs(made_periodic(docs))
    return found.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", F.sha2("collapsed", 256).alias("collapsed_sha256")
    )
