"""Embedding near-duplicates by an inverted multi-index.

Vectors are scaled to length one and cut into halves; each half has a codebook of
its own, and the product of the two is a grid of cells. A vector belongs to the
cell of its nearest centroids and visits others in multi-sequence order (always
the next smallest sum of the two halves' bounds) until no vector of a further
cell is likely to be similar: the bound of a cell is the squared distance to the
border between a half's nearest centroid and the cell's. It stops at the reach
that a similar vector keeps within with probability TARGET_RECALL a half.

The codebooks are fitted on a bounded sample (SAMPLE_ROWS vectors, the first by
hash of their contents); every vector is indexed and visits. The members of a cell
are compared with its members and visitors, in blocks, so two vectors meet if either
visits the other's home; what this connects is then compared pair by pair in double
precision, so a link is counted once and none is below the threshold.
"""

from __future__ import annotations

import heapq
import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import connected_components, prepare, store
from strata.llm.groups import bucket_links, checked_broadcast, unit_links

THRESHOLD = 0.95
TARGET_RECALL = 0.995
SAMPLE_ROWS = 16_384
CELL_ROWS = 64  # rows a cell should have on average
MAX_CENTROIDS = 1024
HOME_BLOCK, VISIT_BLOCK = 256, 1024
_SEED = 11


def usable(embedding: str):
    """Not null, without null or non-finite components, and not all zero."""
    e = F.col(embedding)
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return e.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(e, lambda x: x != 0), F.lit(False))


def _unit(vectors: pa.Array) -> list[np.ndarray]:
    out = []
    for v in vectors:
        x = np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64)
        x = x / np.abs(x).max()  # keeps the squares of very large and small values finite
        out.append(x / np.sqrt(x @ x))
    return out


def kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(_SEED)
    centroids = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        nearest = np.argmin((centroids**2).sum(1)[None, :] - 2 * x @ centroids.T, 1)
        for c in range(len(centroids)):
            own = x[nearest == c]
            if len(own):
                centroids[c] = own.mean(0)
    return np.unique(centroids, axis=0)


def reach(threshold: float, dims: int, recall: float = TARGET_RECALL) -> float:
    """Squared reach of a half: a vector at the threshold differs by 2 - 2 *
    threshold in squared length, half of it in each half and spread over its
    dimensions; its part across a border is about normal."""
    spread = (1 - threshold) / max(dims // 2, 1)
    return NormalDist().inv_cdf(recall) ** 2 * spread


def visited_cells(half: tuple[np.ndarray, np.ndarray], books: tuple[np.ndarray, np.ndarray], gaps: tuple[np.ndarray, np.ndarray], limit: float) -> list[int]:
    """Cells in multi-sequence order, the home cell first."""
    order, bound = [], []
    for x, book, gap in zip(half, books, gaps):
        d = ((book - x) ** 2).sum(1)
        near = int(np.argmin(d))
        b = ((d - d[near]) / (2 * np.maximum(gap[near], 1e-12))) ** 2  # to the border with the nearest
        b[near] = 0
        # the home centroid first, then by bound
        o = np.lexsort((np.arange(len(b)) != near, b))
        order.append(o)
        bound.append(b[o])
    (o1, o2), (b1, b2) = order, bound
    cells, heap, seen = [], [(0.0, 0, 0)], {(0, 0)}
    while heap:
        total, i, j = heapq.heappop(heap)
        if total > limit:
            break
        cells.append(int(o1[i]) * len(b2) + int(o2[j]))
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(b1) and b < len(b2) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (b1[a] + b2[b], a, b))
    return cells


def _close(threshold: float, dtype=np.float64):
    def verify(a: list, b: list | None) -> np.ndarray:
        x = np.frombuffer(b"".join(a), dtype).reshape(len(a), -1)
        y = x if b is None else np.frombuffer(b"".join(b), dtype).reshape(len(b), -1)
        return x @ y.T >= threshold

    return verify


def embedding_classes(vectors: DataFrame, threshold: float = THRESHOLD, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links (other rows with cosine of at
    least ``threshold``), component_id (smallest vec_id reachable by links, itself
    included).

    Vectors that are null, zero or hold null or non-finite components link with
    nothing, and so do vectors of different lengths with each other. Repeated rows
    link like any equal vectors; a null id takes part, and names a component only
    if no member has an id. Other columns are not read."""
    spark = prepare(vectors.sparkSession)
    rows = store(
        vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("embedding"), usable(embedding).alias("usable"))
        .withColumn("node", F.monotonically_increasing_id()), "vectors",
    )
    good = rows.where("usable").select("node", F.size("embedding").alias("dims"), F.col("embedding").cast("array<double>").alias("embedding"))

    def scale(batches):
        for batch in batches:
            units = _unit(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([u.tobytes() for u in units], pa.binary())], ["node", "dims", "unit"])

    units = store(good.mapInArrow(scale, "node long, dims int, unit binary"), "units")
    counts = {r["dims"]: r["count"] for r in units.groupBy("dims").count().collect()}  # one row per length of vector
    edges = None
    for dims, n in sorted(counts.items()):
        own = units.where(F.col("dims") == dims)
        sample = own.orderBy(F.xxhash64("unit"), "node").limit(SAMPLE_ROWS).select("unit").toPandas()["unit"]
        x = np.frombuffer(b"".join(sample), np.float64).reshape(len(sample), -1)
        k = max(1, min(MAX_CENTROIDS, round(math.sqrt(n / CELL_ROWS)), len(x)))
        cut = dims // 2 if dims > 1 else 1
        books = (kmeans(x[:, :cut], k), kmeans(x[:, cut:], k) if dims > 1 else np.zeros((1, 0)))
        edge = _cell_links(own, books, cut, reach(threshold, dims), threshold)
        edges = edge if edges is None else edges.unionByName(edge)
    empty = spark.createDataFrame([], "node long, links long, root long")
    edges = store(edges, "cell-links") if edges is not None else empty
    groups = connected_components(edges.select(F.col("node").alias("a"), F.col("root").alias("b")), "vector-groups")
    members = units.join(groups, "node").select(
        F.xxhash64("component", "dims").alias("bucket"), "node", F.lit(1).cast("long").alias("weight"), F.col("unit").alias("payload")
    )
    links = store(bucket_links(members, _close(threshold)), "vector-links")
    components = connected_components(links.select(F.col("node").alias("a"), F.col("root").alias("b")), "vector-components")
    number = links.groupBy("node").agg(F.sum("links").alias("links"))
    joined = store(
        rows.select("vec_id", "node").join(components, "node", "left").join(number, "node", "left")
        .select("vec_id", F.coalesce("component", "node").alias("component"), F.coalesce("links", F.lit(0)).alias("n_links")), "vector-classes",
    )
    smallest = joined.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return joined.join(smallest, "component").select("vec_id", "n_links", "component_id")


def _cell_links(units: DataFrame, books: tuple[np.ndarray, np.ndarray], cut: int, limit: float, threshold: float) -> DataFrame:
    shared = units.sparkSession.sparkContext.broadcast(books)  # at most 2 * MAX_CENTROIDS half vectors
    dims = sum(b.shape[1] for b in books)

    def visit(batches):
        own = shared.value
        gaps = tuple(np.sqrt(((b[:, None, :] - b[None, :, :]) ** 2).sum(2)) if len(b) <= 256 else _distances(b) for b in own)
        for batch in batches:
            cells, take, home, small = [], [], [], []
            for r, raw in enumerate(batch.column(2).to_pylist()):
                x = np.frombuffer(raw, np.float64)
                found = visited_cells((x[:cut], x[cut:]), own, gaps, limit)
                cells += found
                take += [r] * len(found)
                home += [True] + [False] * (len(found) - 1)
                small.append(x.astype(np.float32).tobytes())  # single precision finds candidates
            at = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells, pa.int64()), pa.array(home, pa.bool_()), batch.column(0).take(at), pa.array(small, pa.binary()).take(at)],
                ["cell", "home", "node", "payload"],
            )

    visits = store(units.mapInArrow(visit, "cell long, home boolean, node long, payload binary"), "cells")
    blocks = lambda n, size: F.greatest(F.ceil(n / size), F.lit(1)).cast("int")
    sizes = store(
        visits.groupBy("cell").agg(
            blocks(F.count_if("home"), HOME_BLOCK).alias("homes"), blocks(F.count("*"), VISIT_BLOCK).alias("visitors"), F.count_if("home").alias("n")
        ).where("n > 0").drop("n"), "cell-sizes",
    )
    rows = visits.join(checked_broadcast(sizes), "cell").withColumn("h", F.xxhash64("node"))
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    member = F.pmod("h", F.col("homes")).cast("int")
    visitor = F.pmod("h", F.col("visitors")).cast("int")
    # units (i, j) with j below 0 never equal i: members i against visitors -1 - j
    first = rows.where("home").select("*", member.alias("i"), F.explode(F.transform(every("visitors"), lambda k: -1 - k)).alias("j"), F.lit(False).alias("second"))
    second = rows.select("*", F.explode(every("homes")).alias("i"), (-1 - visitor).alias("j"), F.lit(True).alias("second"))
    dealt = first.unionByName(second).select(
        F.xxhash64(F.lit(dims), "cell").alias("bucket"), "i", "j", "second", "node", F.lit(1).cast("long").alias("weight"), "payload"
    )
    return unit_links(dealt, _close(threshold - 1e-4, np.float32))


def _distances(b: np.ndarray) -> np.ndarray:
    square = (b**2).sum(1)
    return np.sqrt(np.maximum(square[:, None] + square[None, :] - 2 * b @ b.T, 0))
