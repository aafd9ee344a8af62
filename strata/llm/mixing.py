"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is wanted target / source size times: a whole number
of copies and a fraction. Documents are paired; of a pair, one gives mass to the
other until one fraction is 0 or 1, in the direction drawn so that each keeps its
expected number of copies. Mass is counted in words (fraction x size), so the
words a source gives stay what was wanted until a single fraction is left.

Documents are dealt to buckets of BUCKET on average by a hash of id, size, text
and their place among equal rows, so neither null nor repeated ids fill one bucket.
Within a bucket a fold over its array pairs each document with the one still open. What stays open, one document a bucket, goes to the next
level of the tree, BUCKET buckets to one, until one document a source is left; it
is drawn by its fraction alone. All draws are hashes of these hashes and a seed,
so a rerun takes the same copies.

Everything here is DataFrame functions; only ids and sizes are shuffled. The rows
themselves meet their decisions as bits, 64 rows to a word, broadcast while there
are at most BROADCAST_ROWS words; beyond that the join shuffles the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import prepare, store
from strata.llm.groups import checked_broadcast

BUCKET = 64
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2


def words(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) of each source of ``sizes`` (source, size).

    Sources in code point order, null last, weigh ``weights`` in turn and share
    ``share`` times all words. A target above ``most`` times its source's words
    stops there; the excess is shared among the others by weight, again until none
    is above. Sources stop in order of size per weight, so who stops follows from
    running sums. One row per source; the windows over them are small."""
    # code point order: Spark compares strings by their UTF-8 bytes
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = totals.withColumn("place", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("limit", F.col("source_size").cast("double") * most)
    order = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    all_rows = Window.partitionBy()
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    later = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    ranked = (
        ranked.withColumn("budget", F.sum(F.col("source_size")).over(all_rows) * F.lit(share))
        .withColumn("stopped", F.coalesce(F.sum("limit").over(earlier), F.lit(0.0)))
        .withColumn("open_weight", F.sum("weight").over(later))
        # words a unit of weight gets if all before this source have stopped
        .withColumn("level", (F.col("budget") - F.col("stopped")) / F.col("open_weight"))
        .withColumn("stops", F.col("level") * F.col("weight") >= F.col("limit"))
    )
    # the first that does not stop fixes the level of all that follow
    level = F.first(F.when(~F.col("stops"), F.col("level")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return ranked.select(
        "source", "source_size", F.when(F.col("stops"), F.col("limit")).otherwise(F.least(level * F.col("weight"), F.col("limit"))).alias("target")
    )


def _uniform(*columns) -> Column:
    """In [0, 1), from a hash."""
    return (F.xxhash64(*columns).bitwiseAND(F.lit((1 << 52) - 1))).cast("double") / F.lit(float(1 << 52))


_SAME = ["source", "id", "size", "th"]


def _draw_keys(rows: DataFrame, seed: int) -> DataFrame:
    """(u, source, size, h) of ``rows`` (source, id, size, th, u): h is a hash of
    what a row holds and of its place among equal rows.

    Places are counted by the task that wrote the row (the high bits of u), with
    totals over the tasks before it, so a window holds one task's equal rows at
    most. Equal rows are interchangeable: which of them has which place does not
    matter, and the places taken are the same however rows are partitioned."""
    rows = rows.select(*_SAME, "u", F.shiftright("u", 33).alias("task"))
    inner = F.row_number().over(Window.partitionBy(*_SAME, "task").orderBy("u"))
    earlier = Window.partitionBy(*_SAME).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = rows.groupBy(*_SAME, "task").agg(F.count("*").alias("n"))
    before = store(tasks.withColumn("before", F.sum("n").over(earlier)).where("before > 0").drop("n"), "equal-rows")
    keys = [*_SAME, "task"]
    other = before.select(*(F.col(k).alias(f"_{k}") for k in keys), "before")
    met = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    place = F.col("inner") + F.coalesce("before", F.lit(0))
    placed = rows.withColumn("inner", inner).join(other, met, "left")
    return placed.select("u", "source", "size", F.xxhash64(F.lit(seed), "id", "size", "th", place).alias("h"))


_UNIT = "struct<h:bigint,size:double,p:double,u:bigint>"


def _settle(units: DataFrame, seed: int, level: int) -> DataFrame:
    """One level of the tree: (source, group, done, open), the units that became
    whole and the one left. A unit is (h: order, size, p: fraction, u: row)."""
    none = F.array().cast(f"array<{_UNIT}>")
    start = F.struct(none.alias("done"), F.lit(None).cast(_UNIT).alias("open"))

    def with_p(unit, p):
        return F.struct(unit["h"].alias("h"), unit["size"].alias("size"), p.alias("p"), unit["u"].alias("u"))

    def pair(state, b):
        a = state["open"]
        ma, mb = a["p"] * a["size"], b["p"] * b["size"]  # masses in words
        ra, rb = a["size"] - ma, b["size"] - mb  # and what is missing to a whole
        up, down = F.least(ra, mb), F.least(ma, rb)  # what a could gain or lose
        gains = _uniform(F.lit(seed), F.lit(level), a["h"], b["h"]) * (up + down) < down
        # whoever reaches its bound gets it exactly
        pa = F.when(gains, F.when(ra <= mb, 1.0).otherwise((ma + mb) / a["size"])).otherwise(F.when(ma <= rb, 0.0).otherwise((ma - rb) / a["size"]))
        pb = F.when(gains, F.when(mb <= ra, 0.0).otherwise((mb - ra) / b["size"])).otherwise(F.when(rb <= ma, 1.0).otherwise((mb + ma) / b["size"]))
        both = F.array(with_p(a, pa), with_p(b, pb))
        whole = lambda x: (x["p"] <= 1e-12) | (x["p"] >= 1 - 1e-12)
        after = F.transform(
            F.array(both),  # binds the pair once
            lambda two: F.struct(
                F.concat(state["done"], F.filter(two, whole)).alias("done"), F.get(F.filter(two, lambda x: ~whole(x)), F.lit(0)).alias("open")
            ),
        )
        return F.when(a.isNull(), F.struct(state["done"].alias("done"), b.alias("open"))).otherwise(F.get(after, F.lit(0)))

    folded = units.groupBy("source", "group").agg(F.sort_array(F.collect_list("unit")).alias("units"))
    state = F.aggregate("units", start, pair)
    return folded.select("source", "group", state.alias("s")).select("source", "group", "s.done", "s.open")


def _decisions(rows: DataFrame, seed: int) -> DataFrame:
    """(u, extra): 1 or 0 for each row of ``rows`` (source, size, frac, h, u)."""
    buckets = F.ceil(F.count("*") / BUCKET)
    counts = store(rows.groupBy("source").agg(buckets.alias("n")), "buckets")
    level, n = 0, counts.agg(F.max("n")).first()[0] or 0
    keyed = few_rows(rows, counts, "source").select(
        "source", F.pmod("h", F.col("n")).alias("group"),
        F.struct("h", F.col("size").cast("double").alias("size"), F.col("frac").alias("p"), "u").alias("unit"),
    )
    out = None
    while True:
        settled = store(_settle(keyed, seed, level), "pivotal")
        done = settled.select(F.explode("done").alias("x")).select("x.u", F.round("x.p").cast("int").alias("extra"))
        out = done if out is None else out.unionByName(done)
        left = settled.where(F.col("open").isNotNull())
        if n <= 1:
            drawn = _uniform(F.lit(seed), F.lit("last"), F.col("open.h")) < F.col("open.p")
            return out.unionByName(left.select("open.u", drawn.cast("int").alias("extra")))
        level, n = level + 1, -(-n // BUCKET)
        keyed = left.select("source", F.floor(F.col("group") / BUCKET).alias("group"), F.col("open").alias("unit"))


def _as_bits(extra: DataFrame) -> DataFrame:
    """(word, bits), stored: bit u modulo 64 of word u / 64 for each row u of
    ``extra`` (u, extra) that is 1."""
    bit = F.expr("shiftleft(1L, cast(u & 63 AS int))")
    return store(extra.where("extra = 1").groupBy(F.shiftright("u", 6).alias("word")).agg(F.bit_or(bit).alias("bits")), "extra-copies")


def few_rows(rows: DataFrame, sources: DataFrame, key: str, most: int = 200_000) -> DataFrame:
    """``rows`` with the columns of ``sources`` (one row per source), broadcast
    while their number is small; null sources match each other."""
    small = sources.withColumnRenamed(key, "_key")
    if small.limit(most + 1).count() <= most:
        small = F.broadcast(small)
    return rows.join(small, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")


def mixing_copies(docs: DataFrame, columns: list[str], seed: int = 7) -> DataFrame:
    """``columns`` of ``docs`` with size, source_size, target and copies (0 to 2).

    Null texts have size 0; a null source is a source of its own, the last. Rows
    of size 0 are wanted like their source's others, rounded by hash alone, as they
    weigh nothing. Repeated rows are rounded one by one, null ids like any other; a
    third of all rows may be equal or have null ids.
    An empty table gives an empty result. A rerun takes the same copies."""
    return _mixed(docs, columns, seed).toDF(*columns, "size", "source_size", "target", "copies")


def _mixed(docs: DataFrame, columns: list[str], seed: int, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The result with ``columns`` renamed c0, c1, ..., so that no name clashes."""
    prepare(docs.sparkSession)
    names = [f"c{i}" for i in range(len(columns))]
    sized = store(
        docs.select(
            *(F.col(c).alias(n) for c, n in zip(columns, names)),
            F.col(source).cast("string").alias("source"), F.col(doc_id).cast("long").alias("id"), words(F.col(text)).alias("size"),
            F.xxhash64(F.col(text)).alias("th"),
        ).withColumn("u", F.monotonically_increasing_id()), "sizes",
    )
    targets = store(source_targets(sized), "targets")
    rate = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    narrow = few_rows(_draw_keys(sized, seed), targets, "source").withColumn("frac", rate - F.floor(rate))
    drawn = store(narrow.where("frac > 0").select("u", "source", "size", "frac", "h"), "draw-keys")
    # rows without words weigh nothing and are drawn alone
    alone = drawn.where("size = 0").select("u", (_uniform(F.lit(seed), F.lit("empty"), F.col("h")) < F.col("frac")).cast("int").alias("extra"))
    bits = _as_bits(_decisions(drawn.where("size > 0"), seed).unionByName(alone))
    extra = F.coalesce(F.getbit("bits", F.col("u").bitwiseAND(63).cast("int")).cast("int"), F.lit(0))
    rows = few_rows(sized, targets, "source").withColumn("word", F.shiftright("u", 6))
    out = rows.join(checked_broadcast(bits), "word", "left").withColumn("copies", (F.floor(rate) + extra).cast("int"))
    return out.select(*names, "size", "source_size", "target", "copies")


def mixture(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The mix itself: each document's row as many times as it is taken."""
    taken = _mixed(docs, docs.columns, seed).where("copies > 0")
    copy = F.explode(F.array_repeat(F.lit(0), F.col("copies")))
    return taken.withColumn("copy", copy).select(*(f"c{i}" for i in range(len(docs.columns)))).toDF(*docs.columns)
