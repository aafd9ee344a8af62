"""Links inside buckets of rows, computed block by block.

A bucket may hold any number of rows. It is cut into blocks, and each pair of
blocks is one unit of work, so no task gets an unbounded bucket; a unit never
emits pairs, only what each of its rows is linked to: how many, and the smallest
row it reaches within the unit.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.tokenization import release_memory

BLOCK = 256
# Rows up to this many (a few dozen bytes each) may be broadcast.
BROADCAST_ROWS = 1_000_000


def checked_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, a stored table of small rows, marked for broadcast only if it has at most ``rows``."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def bucket_links(
    rows: DataFrame, verify: Callable[[list, list | None], np.ndarray], block: int = BLOCK, sizes: DataFrame | None = None
) -> DataFrame:
    """(node, links, root) for rows (bucket: bigint, node: bigint, weight: bigint,
    payload: binary). ``verify(a, b)`` gives the boolean matrix of links between
    two lists of payloads, or within one when b is None. ``links`` adds up the
    weights of a row's links in one unit, ``root`` is the smallest node it reaches
    there: a row without links gives nothing. Sum links over units to count each
    link once, provided a pair shares one bucket at most."""
    sizes = rows.groupBy("bucket").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")) if sizes is None else sizes
    large = checked_broadcast(sizes.where("blocks > 1"))
    rows = rows.join(large, "bucket", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = rows.withColumn("mine", mine).withColumn("other", other).select(
        "bucket", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine",
        "node", "weight", "payload",
    )
    # in unit (i, j), block i comes first
    dealt = dealt.select("bucket", "i", "j", (F.col("mine") != F.col("i")).alias("second"), "node", "weight", "payload")
    return unit_links(dealt, verify)


def unit_links(dealt: DataFrame, verify: Callable[[list, list | None], np.ndarray]) -> DataFrame:
    """``bucket_links`` of rows already dealt to units (bucket, i, j), each row
    ``second`` or not: i = j compares the rows of a unit with each other, else the
    first ones with the second ones."""
    units = dealt.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "second", "node")

    def run(batches):
        key, held = None, []
        out: list[tuple] = []

        def batch():
            made = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["node", "links", "root"])
            out.clear()
            return made

        for b in batches:
            for bucket, i, j, second, node, weight, payload in zip(*(c.to_pylist() for c in b.columns)):
                if (bucket, i, j) != key:
                    _unit(held, key, verify, out)
                    key, held = (bucket, i, j), []
                held.append((second, node, weight, payload))
            if len(out) > 10_000:
                yield batch()
        _unit(held, key, verify, out)
        if out:
            yield batch()
        release_memory()

    return units.mapInArrow(run, "node long, links long, root long")


def _unit(held: list, key, verify, out: list) -> None:
    """Append (node, links, root) of the linked rows of one unit."""
    if len(held) < 2:
        return
    split = next((k for k, row in enumerate(held) if row[0]), len(held))
    within = key[1] == key[2]
    if not within and split in (0, len(held)):
        return
    nodes = np.array([r[1] for r in held], np.int64)
    weights = np.array([r[2] for r in held], np.int64)
    payloads = [r[3] for r in held]
    linked = np.zeros((len(held), len(held)), bool)
    if within:
        linked[:] = verify(payloads, None)
    else:
        linked[:split, split:] = verify(payloads[:split], payloads[split:])
        linked[split:, :split] = linked[:split, split:].T
    linked &= nodes[:, None] != nodes[None, :]
    some = np.flatnonzero(linked.any(1))
    if not len(some):
        return
    linked, nodes, weights = linked[np.ix_(some, some)], nodes[some], weights[some]
    rank = np.argsort(np.argsort(nodes))  # labels by node order
    label = rank.copy()
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], len(some)).min(1))
        if (new == label).all():
            break
        label = new
    root = np.sort(nodes)[label]
    out += zip(nodes.tolist(), (linked @ weights).tolist(), root.tolist())
