"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

Components become integers. A block of rows is indexed by dimension: its rows in
order of the component, cut into segments of equal quantised impact (component
divided by SEGMENT, rounded down). A query processes all segments of a block in
descending order of |query component x segment impact|, in ROUNDS of falling
impact, adding exact products to accumulators. After each round the segments not
yet processed bound what any row can still gain or lose. A query stops when its
k-th best guaranteed score shows that at most RESCORE rows can be among the best;
these are then scored exactly. Without that proof every segment is processed.

Blocks of queries meet blocks of rows on a key of their own each, so the work is
dealt evenly whatever the numbers of either; a unit returns at most k rows a
query, and those are ranked in the end.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import prepare, store

SCALE = 1024
SEGMENT = 64
QUERY_BLOCK, ROW_BLOCK = 1024, 4096
TILE = 256  # queries whose accumulators are held at once
# Rounds process segments down to these shares of a query's greatest impact.
ROUNDS = (0.5, 0.125, 0.0)
RESCORE = 256


class ImpactIndex:
    """Segments of one block of integer vectors (rows x dimensions)."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.segments = []  # (dimension, rows, components, lowest, highest)
        for d in range(x.shape[1]):
            order = np.argsort(x[:, d], kind="stable")
            values = x[order, d]
            cuts = np.flatnonzero(np.diff(values // SEGMENT)) + 1
            for rows, part in zip(np.split(order, cuts), np.split(values, cuts)):
                self.segments.append((d, rows, part, int(part[0]), int(part[-1])))
        self.dims = np.array([s[0] for s in self.segments])
        self.low = np.array([s[3] for s in self.segments], np.float64)
        self.high = np.array([s[4] for s in self.segments], np.float64)

    def search(self, queries: np.ndarray, names: np.ndarray, k: int, ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query its k best rows by (score, smaller id) and their exact scores.
        Rows whose id is the query's name are left out."""
        q = queries.astype(np.float64)
        n = len(self.x)
        scores = np.zeros((n, len(q)))  # accumulators: a row's are side by side
        per = q[:, self.dims]
        top, bottom = np.maximum(per * self.low, per * self.high), np.minimum(per * self.low, per * self.high)
        impact = np.maximum(top, -bottom)
        ceiling = impact.max(1, initial=0)
        done = np.zeros(impact.shape, bool)
        starts = np.flatnonzero(np.concatenate([[True], np.diff(self.dims) != 0])) if len(self.dims) else np.empty(0, int)
        open_queries = np.arange(len(q))
        out: list = [None] * len(q)
        for level in ROUNDS:
            now = np.zeros(impact.shape, bool)
            now[open_queries] = ~done[open_queries] & (impact[open_queries] >= ceiling[open_queries, None] * level)
            for s in np.flatnonzero(now.any(0)):
                d, rows, part, _, _ = self.segments[s]
                active = np.flatnonzero(now[:, s])
                if 2 * len(active) > len(q):
                    scores[rows] += part[:, None] * np.where(now[:, s], q[:, d], 0.0)[None, :]
                else:
                    scores[np.ix_(rows, active)] += part[:, None] * q[active, d][None, :]
            done |= now
            # per dimension, the most and the least an unprocessed posting can add
            gain, loss = np.zeros(len(q)), np.zeros(len(q))
            if len(starts):
                gain = np.maximum.reduceat(np.where(done, 0, np.maximum(top, 0)), starts, axis=1).sum(1)
                loss = np.minimum.reduceat(np.where(done, 0, np.minimum(bottom, 0)), starts, axis=1).sum(1)
            left = []
            for i in open_queries:
                held = scores[:, i].copy()
                held[ids == names[i]] = -np.inf
                best = np.partition(held, n - k)[n - k] if n > k else -np.inf
                possible = np.flatnonzero((held + gain[i] >= best + loss[i]) & (held > -np.inf))
                if level == 0 or len(possible) <= RESCORE:
                    exact = self.x[possible] @ queries[i]
                    order = np.lexsort((ids[possible], -exact))[:k]
                    out[i] = possible[order], exact[order]
                else:
                    left.append(i)
            open_queries = np.array(left, int)
            if not len(open_queries):
                break
        return out


def integers(embedding: str):
    """Components as floor(SCALE * x); null for vectors that take no part."""
    e = F.col(embedding)
    finite = F.coalesce(F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))), F.lit(False))
    return F.when(e.isNotNull() & finite, F.transform(e, lambda x: F.floor(x.cast("double") * SCALE)))


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` rows with the highest integer
    inner product for each row whose id is divisible by ``every``, ties to the
    smaller id; all rows, if fewer.

    Vectors that are null or hold null or non-finite components take no part, nor
    do null ids. Only vectors of one length meet. A repeated row is a candidate
    like any other, but not for the query of its own id; each query id answers
    once, with its smallest vector. Other columns are not read; an empty table gives
    an empty result."""
    prepare(vectors.sparkSession)
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), integers(embedding).alias("x")).where("id is not null and x is not null")
    rows = rows.withColumn("dims", F.size("x"))

    def blocks(size: int):
        def run(batches):
            held: dict[int, list] = {}
            number = 0

            def block(dims):
                nonlocal number
                from pyspark import TaskContext

                ids, xs = zip(*held.pop(dims))
                number += 1
                name = (TaskContext.get().partitionId() << 32) + number
                return pa.RecordBatch.from_pylist(
                    [{"block": name, "dims": dims, "ids": np.array(ids, "<i8").tobytes(), "x": np.array(xs, "<i8").tobytes()}],
                    pa.schema([("block", pa.int64()), ("dims", pa.int32()), ("ids", pa.binary()), ("x", pa.binary())]),
                )

            for batch in batches:
                for i, x, dims in zip(*(c.to_pylist() for c in batch.columns)):
                    held.setdefault(dims, []).append((i, x))
                    if len(held[dims]) >= size:
                        yield block(dims)
            for dims in sorted(held):
                yield block(dims)

        return run

    ddl = "block long, dims int, ids binary, x binary"
    asked = rows.where(F.col("id") % every == 0).groupBy("id").agg(F.min("x").alias("x")).withColumn("dims", F.size("x"))
    q = store(asked.repartition(F.floor(F.col("id") / (every * QUERY_BLOCK))).mapInArrow(blocks(QUERY_BLOCK), ddl), "query-blocks")
    r = store(rows.mapInArrow(blocks(ROW_BLOCK), ddl), "row-blocks")
    # each pair of blocks has a key of its own: both sides are dealt over it
    q_names, r_names = (df.select("block", "dims") for df in (q, r))
    pairs = q_names.select(F.col("block").alias("qb"), "dims").join(r_names.select(F.col("block").alias("rb"), "dims"), "dims")
    left = pairs.join(q.select(F.col("block").alias("qb"), F.col("ids").alias("qi"), F.col("x").alias("qx")), "qb")
    units = left.join(r.select(F.col("block").alias("rb"), F.col("ids").alias("ri"), F.col("x").alias("rx")), "rb")

    def run(batches):
        for batch in batches:
            for dims, qi, qx, ri, rx in zip(*(c.to_pylist() for c in batch.columns)):
                qi, ri = np.frombuffer(qi, "<i8"), np.frombuffer(ri, "<i8")
                qx, rx = np.frombuffer(qx, "<i8").reshape(len(qi), -1), np.frombuffer(rx, "<i8").reshape(len(ri), -1)
                index = ImpactIndex(rx)
                columns: list[list] = [[], [], []]
                for start in range(0, len(qi), TILE):
                    ids = qi[start : start + TILE]
                    for i, (found, score) in zip(ids, index.search(qx[start : start + TILE], ids, k, ri)):
                        columns[0] += [int(i)] * len(found)
                        columns[1] += ri[found].tolist()
                        columns[2] += score.tolist()
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])

    best = units.select("dims", "qi", "qx", "ri", "rx").mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
