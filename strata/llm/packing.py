"""Packing of tokenised documents into training windows by the sum-of-squares rule.

Online, within each task: a document of at least one window fills windows of its
own; what is left goes to the fill level h (0: a new window) for which the sum
over levels of the squared number of partially filled windows becomes smallest.
The numbers stand in a level array, the open windows of each level in a stack.

A task keeps at most OPEN_WINDOWS open; beyond that an arriving piece is cut to
fill the fullest one. Windows still open when the tasks end are merged by the
same rule in a tree of FAN_IN tasks a node, which reads them in order and holds
only those it keeps open. At its root the rest is poured together: full windows,
and a last part cut into powers of two, which need no padding. So nothing is
padded, and no task holds more than a bounded rest.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import prepare, store
from strata.llm.tokenization import SLICE_BYTES, WordEncoder, release_memory

WINDOW = 2048
OPEN_WINDOWS = 512
FAN_IN = 64
# Bytes of ids after which a task hands its rows on.
FLUSH_BYTES = 2 << 20

_COLUMNS = {
    "doc_id": pa.int64(), "row_key": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "doc_tokens": pa.int64(),
    "sequence_id": pa.int64(), "offset": pa.int64(), "sequence_tokens": pa.int64(), "ids": pa.binary(), "open_ids": pa.binary(), "task": pa.int64(),
}
_ARROW = pa.schema(list(_COLUMNS.items()))
_OPENED = ["node", "sequence_id", "offset", "doc_id", "row_key", "start", "length", "doc_tokens", "open_ids"]
_DDL = ", ".join(f"{n} {'binary' if t == pa.binary() else 'bigint'}" for n, t in _COLUMNS.items())


class Piece:
    __slots__ = ("doc_id", "row_key", "start", "ids", "doc_tokens")

    def __init__(self, doc_id, row_key, start, ids, doc_tokens):
        self.doc_id, self.row_key, self.start, self.ids, self.doc_tokens = doc_id, row_key, start, ids, doc_tokens

    def cut(self, at: int) -> tuple["Piece", "Piece"]:
        head = Piece(self.doc_id, self.row_key, self.start, self.ids[:at], self.doc_tokens)
        return head, Piece(self.doc_id, self.row_key, self.start + at, self.ids[at:], self.doc_tokens)


class LevelArray:
    """Open windows by fill level, and the sum-of-squares choice among them."""

    def __init__(self, window: int = WINDOW, open_windows: int = OPEN_WINDOWS):
        self.window, self.open_windows = window, open_windows
        self.counts = np.zeros(window + 1, np.int64)  # counts[window] stays 0: full windows leave
        self.stacks: list[list[list[Piece]]] = [[] for _ in range(window + 1)]
        self.held = 0

    def best_level(self, size: int) -> int:
        """The level whose windows an item of ``size`` should join, 0 for a new
        one; among equals the fullest. Moving a window from h to h + size changes
        the sum by (N[h]-1)^2 - N[h]^2 + (N[h+size]+1)^2 - N[h+size]^2."""
        counts, window = self.counts, self.window
        here = counts[1 : window - size + 1]
        change = 2 * (counts[size + 1 : window + 1] - here) + 2
        if len(change):
            change[-1] = 1 - 2 * here[-1]  # fills the window, which then counts no more
            change[here == 0] = np.iinfo(np.int64).max
            h = len(change) - 1 - int(np.argmin(change[::-1]))
            if change[h] <= 2 * counts[size] + 1:
                return h + 1
        return 0

    def add(self, pieces: list[Piece]) -> list[list[Piece]]:
        """Place pieces that stay together (less than a window); returns the
        windows filled by this."""
        done = []
        size = sum(len(p.ids) for p in pieces)
        if self.held >= self.open_windows and not self.best_level(size):
            top = int(np.flatnonzero(self.counts)[-1])
            if self.window - top < size:  # cut the item to fill the fullest window
                room, head = self.window - top, []
                while room:
                    piece = pieces.pop(0)
                    if len(piece.ids) > room:
                        piece, rest = piece.cut(room)
                        pieces.insert(0, rest)
                    head.append(piece)
                    room -= len(piece.ids)
                done.append(self._take(top) + head)
                size = sum(len(p.ids) for p in pieces)
            else:
                return self._join(top, size, pieces)
        return done + self._join(self.best_level(size), size, pieces)

    def _take(self, level: int) -> list[Piece]:
        self.counts[level] -= 1
        self.held -= 1
        return self.stacks[level].pop()

    def _join(self, level: int, size: int, pieces: list[Piece]) -> list[list[Piece]]:
        window = (self._take(level) if level else []) + pieces
        if level + size == self.window:
            return [window]
        self.counts[level + size] += 1
        self.held += 1
        self.stacks[level + size].append(window)
        return []

    def rest(self) -> list[list[Piece]]:
        """Open windows, fullest first."""
        return [w for stack in reversed(self.stacks) for w in stack]


def pour(windows: list[list[Piece]], window: int) -> list[list[Piece]]:
    """All pieces in order, cut into full windows and a tail of powers of two."""
    queue = [p for w in windows for p in w]
    left = sum(len(p.ids) for p in queue)
    queue.reverse()
    out = []
    while left:
        room = window if left >= window else 1 << (left.bit_length() - 1)
        left -= room
        made = []
        while room:
            piece = queue.pop()
            if len(piece.ids) > room:
                piece, rest = piece.cut(room)
                queue.append(rest)
            made.append(piece)
            room -= len(piece.ids)
        out.append(made)
    return out


class _Rows:
    """Output rows of placed pieces, column by column."""

    def __init__(self, task: int, first_id: int, dtype):
        self.task, self.next_id, self.dtype = task, first_id, dtype
        self.clear()

    def clear(self):
        self.columns: dict[str, list] = {n: [] for n in _COLUMNS}
        self.bytes = 0

    def write(self, pieces: list[Piece], closed: bool = True):
        offset, total = 0, sum(len(p.ids) for p in pieces)
        for p in pieces:
            raw = p.ids.tobytes()
            self.bytes += len(raw)
            values = (
                p.doc_id, p.row_key, p.start, len(p.ids), zlib.crc32(p.ids.astype("<u4")), p.doc_tokens,
                self.next_id, offset, total, raw if closed else None, None if closed else raw, self.task,
            )
            for column, value in zip(self.columns.values(), values):
                column.append(value)
            offset += len(p.ids)
        self.next_id += 1

    def batch(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(self.columns.values(), _COLUMNS.values())], schema=_ARROW)
        self.clear()
        return out


def _id_dtype(vocab: int) -> np.dtype:
    return np.dtype("<u2") if vocab <= 1 << 16 else np.dtype("<u4")


def pack_sequences(
    docs: DataFrame, tokenizer_path: str, end_id: int, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, open_windows: int = OPEN_WINDOWS
) -> DataFrame:
    """One row per piece: doc_id, row_key (its input row), start (the document's
    ids before it), length, ids_crc32 (as little-endian uint32), doc_tokens (ids of
    the document with ``end_id``), sequence_id, offset (within the sequence),
    sequence_tokens and ids (little-endian, 2 bytes each while the vocabulary has
    at most 65,536 ids, else 4).

    Null texts count as empty and hold the end id alone. Repeated rows and equal
    or null ids are packed row by row, told apart by row_key. Columns beyond the
    two named are not read. An empty table gives an empty result."""
    spark = prepare(docs.sparkSession)

    def first(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        levels, rows, row_key = LevelArray(window, open_windows), None, task << 36
        for batch in batches:
            encoder = WordEncoder.shared(tokenizer_path)
            dtype = _id_dtype(max(encoder.vocab_size, end_id + 1))
            rows = rows or _Rows(task, task << 32, dtype)
            keys, i = batch.column(0).to_pylist(), 0
            for ids, at in encoder.encode(batch.column(1), SLICE_BYTES // 2):
                full = np.insert(ids.astype(dtype, copy=False), at[1:], end_id)
                bounds = (at + np.arange(len(at))).tolist()
                for a, b in zip(bounds[:-1], bounds[1:]):
                    n = b - a
                    whole = n - n % window
                    for s in range(0, whole, window):
                        rows.write([Piece(keys[i], row_key, s, full[a + s : a + s + window], n)])
                    if whole < n:
                        for made in levels.add([Piece(keys[i], row_key, whole, full[a + whole : b].copy(), n)]):
                            rows.write(made)
                    i += 1
                    row_key += 1
                    if rows.bytes > FLUSH_BYTES:
                        yield rows.batch()
        if rows:
            for made in levels.rest():
                rows.write(made, closed=False)
            yield rows.batch()
        release_memory(encoders=False)

    def merge(base: int, last: bool):
        def run(batches):
            release_memory()  # of the encoders that made the pieces
            group, rows, levels, sequence, pieces = None, None, None, None, []

            def place():
                for made in levels.add(pieces):
                    rows.write(made)

            def finish():
                place()
                for made in pour(levels.rest(), window) if last else levels.rest():
                    rows.write(made, closed=last)
                    if rows.bytes > FLUSH_BYTES:
                        yield rows.batch()
                yield rows.batch()

            for batch in batches:
                for node, sequence_id, doc, row_key, start, length, doc_tokens, raw in zip(*(c.to_pylist() for c in batch.columns)):
                    if node != group:
                        if rows:
                            yield from finish()
                        group, sequence, pieces = node, sequence_id, []
                        dtype = np.dtype(f"<u{len(raw) // length}")
                        rows, levels = _Rows(group, base + (group << 32), dtype), LevelArray(window, open_windows)
                    if sequence_id != sequence:
                        place()
                        sequence, pieces = sequence_id, []
                        if rows.bytes > FLUSH_BYTES:
                            yield rows.batch()
                    pieces.append(Piece(doc, row_key, start, np.frombuffer(raw, dtype), doc_tokens))
            if rows:
                yield from finish()
            release_memory()

        return run

    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    tasks = texts.rdd.getNumPartitions()
    level = store(texts.mapInArrow(first, _DDL), "pieces")
    out = level.where(F.col("ids").isNotNull())
    depth = 0
    while True:
        tasks, depth = max(1, -(-tasks // FAN_IN)), depth + 1
        opened = level.where(F.col("open_ids").isNotNull()).withColumn("node", F.col("task") % tasks).select(*_OPENED).repartition("node")
        level = store(opened.sortWithinPartitions("node", "sequence_id", "offset").drop("offset").mapInArrow(merge(depth << 56, tasks == 1), _DDL), f"pieces-{depth}")
        out = out.unionByName(level.where(F.col("ids").isNotNull()))
        if tasks == 1:
            return out.drop("open_ids", "task")
