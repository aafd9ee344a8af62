"""Token counts of whole texts by a map-side two-tier lookup.

Tier one is a compact table of the corpus's most frequent pre-tokens and their
token counts, broadcast to every executor; tier two is each worker's bounded
cache, which encodes what tier one lacks. Texts are never shuffled and neither
are pre-tokens: each task sends one bounded summary of its frequent pre-tokens,
and a tree of merges reduces the summaries to the table.

The pre-token here is the piece of text between two single spaces. The table
only saves work: counts are the tokenizer's own whatever it holds.
"""

from __future__ import annotations

import uuid
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import prepare
from strata.llm.tokenization import SpaceCounter, slices

# Entries of the broadcast table, and of each summary on the way to it: a proven
# bound on what is broadcast (at most MAX_PIECE_BYTES + 16 bytes an entry).
TABLE_ENTRIES = 1 << 16
MAX_PIECE_BYTES = 64
# Summaries merged by one task of the reduction tree.
FAN_IN = 32

_SUMMARY = "task long, pieces binary, counts binary"


def _pack(task: int, pieces: list[bytes], counts: np.ndarray) -> dict:
    # a piece holds no space, so spaces separate pieces
    return {"task": task, "pieces": b" ".join(pieces), "counts": counts.astype("<i8").tobytes()}


def _unpack(pieces: bytes, counts: bytes) -> tuple[list[bytes], np.ndarray]:
    values = np.frombuffer(counts, "<i8")
    return (pieces.split(b" ") if len(values) else []), values


def _top(counts: dict[bytes, int], entries: int) -> dict[bytes, int]:
    """The ``entries`` most frequent; equal counts by piece."""
    if len(counts) <= entries:
        return counts
    return dict(sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:entries])


def _summarise(entries: int):
    def run(batches):
        from pyspark import TaskContext

        counts: dict[bytes, int] = {}
        for batch in batches:
            for part in slices(batch.column(0)):
                words = pc.split_pattern(part.view(pa.large_string()), " ").flatten().view(pa.large_binary())
                for piece, n in _frequent(words):
                    counts[piece] = counts.get(piece, 0) + n
                if len(counts) > 4 * entries:
                    counts = _top(counts, 2 * entries)
        counts = _top(counts, entries)
        row = _pack(TaskContext.get().partitionId(), list(counts), np.array(list(counts.values()), np.int64))
        yield pa.RecordBatch.from_pylist([row], pa.schema([("task", pa.int64()), ("pieces", pa.binary()), ("counts", pa.binary())]))

    return run


def _frequent(words: pa.Array):
    """(piece, count) of the pieces met more than once in a slice."""
    found = pc.value_counts(words)
    pieces, counts = found.field(0), found.field(1)
    keep = pc.and_(pc.greater(counts, 1), pc.less_equal(pc.binary_length(pieces), MAX_PIECE_BYTES))
    return zip(pieces.filter(keep).to_pylist(), counts.filter(keep).to_pylist())


def frequent_pieces(docs: DataFrame, text: str = "text", entries: int = TABLE_ENTRIES) -> dict[bytes, int]:
    """The corpus's most frequent pieces (bounded summaries of every task, merged
    in a tree, so their counts are lower bounds). Nulls count as empty."""

    def merge(key, pdf):
        import pandas as pd

        counts: dict[bytes, int] = {}
        for pieces, values in zip(pdf["pieces"], pdf["counts"]):
            for piece, n in zip(*_unpack(pieces, values)):
                counts[piece] = counts.get(piece, 0) + int(n)
        counts = _top(counts, entries)
        return pd.DataFrame([_pack(int(key[0]), list(counts), np.array(list(counts.values()), np.int64))])

    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    tasks = texts.rdd.getNumPartitions()
    level = texts.mapInArrow(_summarise(entries), _SUMMARY)
    while tasks > 1:
        tasks = -(-tasks // FAN_IN)
        level = level.groupBy((F.col("task") % tasks).alias("group")).applyInPandas(merge, _SUMMARY)
    rows = level.collect()  # one bounded row
    return dict(zip(*_unpack(bytes(rows[0]["pieces"]), bytes(rows[0]["counts"])))) if rows else {}


def token_counts(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", entries: int = TABLE_ENTRIES) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) per row of ``docs``.

    Null and empty texts: 0 and 0. Null and repeated ids: one row each. Special
    strings inside texts count as the tokenizer takes them by default. Columns
    beyond the two named are not read. An empty table gives an empty result."""
    spark = prepare(docs.sparkSession)
    pieces = list(frequent_pieces(docs, text, entries))
    lengths = array("H", SpaceCounter(tokenizer_path, {}).cache.look_up(pieces))  # a piece has at most MAX_PIECE_BYTES + 1
    shared = spark.sparkContext.broadcast((b" ".join(pieces), lengths.tobytes()))
    key = uuid.uuid4().hex

    def first_tier() -> dict[bytes, int]:
        names, counts = shared.value
        return dict(zip(names.split(b" "), array("H", counts)))

    def run(batches):
        for batch in batches:
            counter = SpaceCounter.shared(tokenizer_path, key, first_tier)
            sizes = pc.fill_null(pc.binary_length(batch.column(1).cast(pa.large_binary())), 0)
            n = np.concatenate([*counter.count(batch.column(1)), np.empty(0, np.int64)])
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes.cast(pa.int64()), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long"
    )
