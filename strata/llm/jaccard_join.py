"""Chosen-path similarity join on sets of word n-grams.

Documents of equal n-gram sets are one class. Each class has a MinHash signature;
sharing a value at a sampled position means sharing a sampled n-gram. A run puts
all classes at a root and splits a node's classes by the values at one or two
sampled positions (1 / threshold on average, so that a pair at the threshold is
expected to stay together in one child); small nodes are leaves, larger ones are
split again, DEPTH times at most. Runs repeat until a pair at the threshold meets
in some leaf with probability TARGET_RECALL.

Within a small leaf, signature sketches choose the classes that may be similar
(a margin of four standard deviations below the threshold); a leaf still large at
the last level is taken as a whole. What that connects is a candidate group, and
every pair of a group is then compared exactly, block by block.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import connected_components, prepare, store
from strata.llm.groups import bucket_links, checked_broadcast
from strata.llm.tokenization import release_memory, slices

WORDS = 5
THRESHOLD = Fraction(4, 5)
TARGET_RECALL = 0.9999
LEAF = 128
DEPTH = 3  # splits after the root's
SKETCH = 128
# Positions a level chooses from; each level has its own, so no path repeats one.
LEVEL_POSITIONS = 16

_MIX = np.uint64(0x9E3779B97F4A7C15)


def runs_needed(threshold: float, recall: float = TARGET_RECALL, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall``
    if every node it shares is split ``depth`` times. All runs choose from the same
    positions of a level, so they are independent only given how many of each
    level's positions agree; the miss is the sum over these numbers."""
    n, two = LEVEL_POSITIONS, 1 / threshold - 1  # two: share of nodes that split on two positions
    agree = np.arange(n + 1)
    chance = np.array([math.comb(n, k) * threshold**k * (1 - threshold) ** (n - k) for k in agree])
    both, one = agree * (agree - 1) / (n * (n - 1)), 2 * agree * (n - agree) / (n * (n - 1))
    meet, weight = np.ones(1), np.ones(1)  # below a shared node, for each choice of numbers
    for _ in range(depth):
        m = meet[:, None]
        meet = ((1 - two) * agree / n * m + two * (both * (1 - (1 - m) ** 2) + one * m)).ravel()
        weight = (weight[:, None] * chance).ravel()
    runs = 1
    while weight @ (1 - threshold * meet) ** _roots(runs, threshold) > 1 - recall:
        runs += 1
    return runs


def _roots(runs: int, threshold: float) -> int:
    """Roots of ``runs`` runs: some have two."""
    return runs + round(runs * (1 / threshold - 1))


def _multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(20240501).integers(1, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: pa.Array, words: int = WORDS):
    """Yields, per text, its sorted distinct n-gram hashes: words are runs of
    characters other than ASCII white space; a shorter text is one n-gram of all
    its words, one without words has none."""
    import xxhash

    for part in slices(texts):
        split = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(part.view(pa.large_string())))
        at = split.offsets.to_numpy()
        at = at - at[0]
        known = split.flatten().dictionary_encode()
        hashes = np.array([xxhash.xxh3_64_intdigest(w) if w else 0 for w in known.dictionary.to_pylist()], np.uint64)
        h = hashes[known.indices.to_numpy()] if len(known) else np.empty(0, np.uint64)
        for a, b in zip(at[:-1], at[1:]):
            own = h[a:b]
            if len(own) == 1 and own[0] == 0:
                own = own[:0]
            n = min(words, len(own))
            if n == 0:
                yield own
                continue
            grams = np.zeros(len(own) - n + 1, np.uint64)
            for k in range(n):
                grams = grams * _MIX + own[k : len(own) - n + 1 + k]
            grams ^= grams >> np.uint64(29)
            grams *= np.uint64(0xBF58476D1CE4E5B9)
            yield np.unique(grams ^ (grams >> np.uint64(32)))


def signature(grams: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    out = np.full(len(multipliers), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(grams), 256):
        np.minimum(out, (grams[i : i + 256, None] * multipliers[None, :]).min(0), out)
    return out


def _digest(grams: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(grams.tobytes())


def _describe(words: int, paths: int):
    """(doc_id, th, key, n, path values of 32 bits, sketch) of each row."""

    def run(batches):
        multipliers = _multipliers(max(SKETCH, paths))
        for batch in batches:
            rows = []
            for grams in shingle_sets(batch.column(2), words):
                s = signature(grams, multipliers) if len(grams) else None
                rows.append(
                    (None, 0, None, None) if s is None
                    else (_digest(grams), len(grams), ((s[:paths] * _MIX) >> np.uint64(32)).astype(np.uint32).view(np.int32).tolist(), ((s[:SKETCH] * _MIX) >> np.uint64(48)).astype("<u2").tobytes())
                )
            key, n, path, sketch = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(key, pa.binary()), pa.array(n, pa.int64()), pa.array(path, pa.list_(pa.int32())), pa.array(sketch, pa.binary())],
                ["doc_id", "th", "key", "n", "path", "sketch"],
            )
        release_memory()

    return run


def _may_be_similar(least: float):
    """Links by sketches: the share of equal 16-bit values is at least ``least``."""

    def verify(a: list, b: list | None) -> np.ndarray:
        x = np.stack([np.frombuffer(v, "<u2") for v in a])
        y = x if b is None else np.stack([np.frombuffer(v, "<u2") for v in b])
        out = np.empty((len(x), len(y)), bool)
        for i in range(len(x)):
            out[i] = (x[i] == y).sum(1) >= least * x.shape[1]
        return out

    return verify


def _similar(threshold: Fraction):
    """Links by exact Jaccard similarity of n-gram sets."""
    up, down = threshold.numerator, threshold.denominator

    def verify(a: list, b: list | None) -> np.ndarray:
        x = [np.frombuffer(v, np.uint64) for v in a]
        y = x if b is None else [np.frombuffer(v, np.uint64) for v in b]
        nx, ny = np.array([len(v) for v in x]), np.array([len(v) for v in y])
        if len(x) * len(y) <= 16:
            common = np.array([[len(np.intersect1d(p, q, assume_unique=True)) for q in y] for p in x])
        else:
            every = x if b is None else x + y
            row = np.repeat(np.arange(len(every)), [len(v) for v in every])
            _, which, count = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
            shared = count > 1
            column = (np.cumsum(shared) - 1)[which]
            keep = shared[which]
            row, column = row[keep], column[keep]
            order = np.argsort(column, kind="stable")
            row, column = row[order], column[order]
            common = np.zeros((len(x), len(y)))
            width = 4096
            for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
                lo, hi = np.searchsorted(column, [start, start + width])
                m = np.zeros((len(every), width), np.float32)
                m[row[lo:hi], column[lo:hi] - start] = 1
                common += m[: len(x)] @ (m if b is None else m[len(x) :]).T
        return common * (up + down) >= up * (nx[:, None] + ny[None, :])

    return verify


def _leaves(classes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame | None]:
    """(bucket, node) of the small leaves, and of the leaves still large at the end."""
    two = 1 / threshold - 1
    roots = list(range(_roots(runs_needed(threshold), threshold)))  # root positions of all runs, each its own
    value = lambda p: F.element_at("path", (p + 1).cast("int"))
    level = classes.select("node", F.explode(F.transform(F.array(*map(F.lit, roots)), lambda p: F.xxhash64(F.lit(0), p, value(p)))).alias("bucket"))
    small, big = None, None
    for depth in range(DEPTH + 1):
        level = store(level, "paths")
        sizes = store(level.groupBy("bucket").count().where("count > 1"), "path-sizes")
        sized = level.join(checked_broadcast(sizes), "bucket")
        found = sized.where(F.col("count") <= LEAF).select("bucket", "node")
        small = found if small is None else small.unionByName(found)
        big = sized.where(F.col("count") > LEAF).select("bucket", "node")
        if depth == DEPTH:
            break
        base = len(roots) + depth * LEVEL_POSITIONS
        h = F.pmod(F.xxhash64("bucket", F.lit(depth)), F.lit(1 << 30))
        first = F.pmod(h, F.lit(LEVEL_POSITIONS))
        second = F.pmod(first + 1 + F.pmod(F.floor(h / LEVEL_POSITIONS), F.lit(LEVEL_POSITIONS - 1)), F.lit(LEVEL_POSITIONS))
        twice = F.pmod(F.xxhash64("bucket", F.lit(-1 - depth)), F.lit(1000)) < int(1000 * two)
        chosen = F.when(twice, F.array(first, second)).otherwise(F.array(first))
        level = (
            big.join(classes.select("node", "path"), "node")
            .select("node", F.explode(F.transform(chosen, lambda p: F.xxhash64("bucket", p, value(p + base)))).alias("bucket"))
        )
    return small, big


def jaccard_classes(docs: DataFrame, words: int = WORDS, threshold: Fraction = THRESHOLD, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, th (xxhash64 of the text), class_id
    (smallest doc_id reachable by links, itself included), n_links (other rows
    linked directly, copies included) and representative (the smallest doc_id of
    equal n-gram sets).

    Two rows are linked when the Jaccard similarity of their sets is at least
    ``threshold``. Null and empty texts have no n-grams and no links; their class
    is their own id. Repeated rows are copies and linked. A null id takes part,
    and is a class's id only if no member has one. Other columns are not read."""
    spark = prepare(docs.sparkSession)
    t = float(threshold)
    paths = _roots(runs_needed(t), t) + DEPTH * LEVEL_POSITIONS
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    rows = store(texts.mapInArrow(_describe(words, paths), "doc_id long, th long, key binary, n long, path array<int>, sketch binary"), "sets")
    classes = store(
        rows.where("key is not null").groupBy("key").agg(
            F.min_by(F.struct("doc_id", "th"), F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("th"))).alias("rep"),
            F.count("*").alias("copies"), F.first("path").alias("path"), F.first("sketch").alias("sketch"),
        ).withColumn("node", F.monotonically_increasing_id()), "classes",
    )
    small, big = _leaves(classes.select("node", "path"), t)
    least = t - 4 * math.sqrt(t * (1 - t) / SKETCH)
    leaves = small.join(classes.select("node", F.lit(1).cast("long").alias("weight"), F.col("sketch").alias("payload")), "node")
    near = bucket_links(leaves, _may_be_similar(least), block=2 * LEAF, sizes=spark.createDataFrame([], "bucket long, blocks int"))
    whole = big.join(big.groupBy("bucket").agg(F.min("node").alias("root")), "bucket")
    edges = near.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(whole.select(F.col("node").alias("a"), F.col("root").alias("b")))
    groups = connected_components(edges, "candidates")
    # the texts of the candidates, and their sets again
    wanted = store(groups.join(classes, "node").select("node", F.col("component").alias("bucket"), "copies", "key", "rep.doc_id", "rep.th"), "candidates")
    ids = checked_broadcast(wanted.select(F.col("doc_id").alias("d"), F.col("th").alias("h"), "node", "bucket", "copies", "key"))
    found = texts.join(ids, (F.col("th") == F.col("h")) & F.col("doc_id").eqNullSafe(F.col("d"))).select("node", "bucket", "copies", "key", "text")

    def sets_of(batches):
        for batch in batches:
            node, bucket, copies, key, text_column = batch.columns
            sets = list(shingle_sets(text_column, words))
            same = pa.array([_digest(s) == k for s, k in zip(sets, key.to_pylist())], pa.bool_())
            made = pa.RecordBatch.from_arrays([bucket, node, copies, pa.array([s.tobytes() for s in sets], pa.binary())], ["bucket", "node", "weight", "payload"])
            yield made.filter(same)
        release_memory()

    members = store(found.mapInArrow(sets_of, "bucket long, node long, weight long, payload binary").dropDuplicates(["node"]), "members")
    links = store(bucket_links(members, _similar(threshold)), "links")
    components = connected_components(links.select(F.col("node").alias("a"), F.col("root").alias("b")), "components")
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    classed = classes.select("node", "key", "copies", F.col("rep.doc_id").alias("representative")).join(components, "node", "left").join(counts, "node", "left")
    classed = store(classed.withColumn("component", F.coalesce("component", "node")), "classed")
    smallest = classed.groupBy("component").agg(F.min("representative").alias("class_id"))
    result = store(
        classed.join(smallest, "component").select("key", "class_id", "representative", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")), "result"
    )
    out = rows.select("doc_id", "th", "key").join(checked_broadcast(result), "key", "left")
    return out.select(
        "doc_id", "th", F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("representative")).alias("representative"),
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near-duplicates, all columns: of each class the
    row of the smallest doc_id stays, one row if that id repeats. Rows of null id
    stay only if their class has no id, one for each text."""
    found = store(jaccard_classes(docs), "classes-of-rows")
    gone = store(found.where(~F.col("doc_id").eqNullSafe(F.col("class_id"))).select(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).distinct(), "gone")
    again = store(
        found.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy(F.col("doc_id").alias("_id")).agg(F.count("*").alias("n")).where("n > 1").select("_id"), "again"
    )
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows = docs.select(*(F.col(c).alias(n) for c, n in zip(docs.columns, names)), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("th"))
    same = (F.col("th") == F.col("_th")) & F.col("id").eqNullSafe(F.col("_id"))
    rows = rows.join(checked_broadcast(gone), same, "left_anti")
    if again.isEmpty():
        return rows.select(*names).toDF(*docs.columns)
    repeated = F.col("id").eqNullSafe(F.col("_id"))
    single = rows.join(checked_broadcast(again), repeated, "left_anti")
    first = rows.join(checked_broadcast(again), repeated, "left_semi")
    # one row of each repeated id; null ids differ by their text
    first = first.dropDuplicates(["id", "th"]).withColumn("by", F.when(F.col("id").isNull(), F.col("th"))).dropDuplicates(["id", "by"])
    return single.select(*names).unionByName(first.select(*names)).toDF(*docs.columns)
