"""Merkle manifest of a table: a tree per group, a tree of trees, and proofs.

A digest H is the lowercase hex sha256 of its inputs concatenated, digests as hex
text. Each row is a leaf. The leaves of a group stand in the order of their keys;
while several nodes remain, every eight consecutive ones become their H, so the
last one is the group's subroot. The subroots, by group, likewise give the root.

Levels are built bottom up by grouping on (tree, place div 8) and stored as
parent-linked rows: a node, its parent, and its siblings left and right of it. A
recursive query then climbs from the leaves to the root: each step joins the
node's row, appends its siblings to the proof and folds the hash of the (possibly
tampered) leaf with them. The eight leaves of a run share all that lies above it,
so they climb as one row, each with its own hash.

Tables are dealt by parts of 4,096 consecutive leaves. A node above several parts
has a row for each, so no join key of the climb serves more than one part's runs,
and a group that holds most rows is spread like any other.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import prepare, running_totals, store

FAN = 8
# A part is the 8 ** PART_LEVEL consecutive leaves below one node of that level.
PART_LEVEL = 4
TOP = -1  # the tree of subroots; group trees are numbered from 0
_POSITION_BITS = 33  # of monotonically_increasing_id within a partition


def field(column: Column) -> Column:
    """A value's part of a leaf: ``-`` if null, else its UTF-8 length, ``:``, itself."""
    value = column.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def digest(fields: list[Column]) -> Column:
    """H of texts, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*fields), 256))


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and nothing else changed."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


_HEX = "lower(hex({}))"
_JOINED = "array_join(transform({}, d -> lower(hex(d))), '')"


def _height(n: Column) -> Column:
    """Levels above the leaves until one node is left: how many powers of 8 are below n."""
    below = F.lit(0)
    for k in range(21):
        below = below + (n > F.lit(FAN**k)).cast("int")
    return below


def numbered_leaves(leaves: DataFrame) -> DataFrame:
    """``leaves`` (grp, key, leaf, ...) with lt, its group's number in order (null
    first, then bytewise), idx, its place in the group by key (nulls first; equal
    keys by leaf), n and ``groups``. Rows are range-partitioned, so a group of any
    size is spread; offsets come from counts per partition and group."""
    order = [F.col("grp").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("leaf").asc(), F.col("salt").asc()]
    at = F.monotonically_increasing_id()
    ranged = leaves.withColumn("salt", at).repartitionByRange(*order).sortWithinPartitions(*order).drop("salt")
    ranged = store(ranged.withColumn("pid", F.shiftright(at, _POSITION_BITS)).withColumn("at", at.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))), "leaves")
    counts = ranged.groupBy("pid", "grp").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    group = Window.partitionBy("grp")
    earlier = group.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    counts = store(
        counts.select(
            "pid", "grp", "first", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
            F.sum("rows").over(group).alias("n"), F.min("pid").over(group).alias("home"),
        ),
        "leaf-counts",
    )
    begun = counts.where(F.col("pid") == F.col("home"))  # one row per group, where it begins
    ordinal = begun.join(running_totals(begun.groupBy("pid").agg(F.count("*").alias("begun")), "pid", "begun"), "pid")
    ordinal = ordinal.select("grp", (F.col("base") + F.row_number().over(Window.partitionBy("pid").orderBy("first")) - 1).alias("lt"))
    here = counts.alias("c").join(ordinal.alias("o"), F.expr("c.grp <=> o.grp")).select("c.*", "o.lt")
    here = here.select(F.col("pid").alias("cpid"), F.col("grp").alias("cgrp"), "first", "before", "n", "lt")
    joined = ranged.join(here, (F.col("pid") == F.col("cpid")) & F.col("grp").eqNullSafe(F.col("cgrp")))
    return joined.withColumn("idx", F.col("before") + F.col("at") - F.col("first")).drop("pid", "cpid", "cgrp", "at", "first", "before")


def _grouped(nodes: DataFrame, level: int) -> DataFrame:
    """Level ``level`` from the nodes (t, idx, height, digest) of the level below."""
    runs = nodes.groupBy("t", F.expr(f"idx div {FAN}").alias("idx")).agg(
        F.first("height").alias("height"), F.transform(F.array_sort(F.collect_list(F.struct("idx", "digest"))), lambda s: s["digest"]).alias("children")
    )
    return store(runs.withColumn("digest", F.expr(f"unhex(sha2({_JOINED.format('children')}, 256))")).withColumn("level", F.lit(level)), "merkle-level")


def _tree(nodes: DataFrame, level: int, height: int) -> list[DataFrame]:
    """Stored levels above the nodes of ``level`` up to ``height``."""
    levels = []
    for above in range(level + 1, height + 1):
        levels.append(_grouped(nodes.where(F.col("height") >= above), above))
        nodes = levels[-1].select("t", "idx", "height", "digest")
    return levels


def _links(levels: list[DataFrame]) -> DataFrame | None:
    """Parent-linked rows of the children of ``levels``: (t, level, idx), its parent
    (pt, plevel, pidx), and the digests left and right of it, joined."""
    out = None
    for groups in levels:
        child = groups.select("t", "level", "idx", "children", F.posexplode("children").alias("place", "own"))
        rows = child.select(
            "t", (F.col("level") - 1).alias("level"), (F.col("idx") * FAN + F.col("place")).alias("idx"),
            F.col("t").alias("pt"), F.col("level").alias("plevel"), F.col("idx").alias("pidx"),
            _bytes("slice(children, 1, place)").alias("low"), _bytes(f"slice(children, place + 2, {FAN})").alias("high"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def _bytes(digests: str) -> Column:
    return F.expr(f"unhex(array_join(transform({digests}, d -> hex(d)), ''))")


_CLIMB = f"""
WITH RECURSIVE climb (lt, part, t, level, idx, proof, subroot, leaves) AS (
  SELECT lt, part, t, level, idx, proof, subroot, leaves FROM {{runs}}
  UNION ALL
  SELECT c.lt, c.part, l.pt, l.plevel, l.pidx, concat(c.proof, l.low, l.high), coalesce(c.subroot, l.subroot),
         transform(c.leaves, x -> named_struct('key', x.key, 'leaf', x.leaf,
           'folded', unhex(sha2(concat({_HEX.format('l.low')}, {_HEX.format('x.folded')}, {_HEX.format('l.high')}), 256))))
  FROM climb c JOIN {{links}} l ON c.lt = l.lt AND c.part = l.part AND c.t = l.t AND c.level = l.level AND c.idx = l.idx
)
SELECT proof, coalesce(subroot, {{root}}) AS subroot, leaves FROM climb WHERE t = {{t}} AND level = {{level}} AND idx = 0"""


def climb(spark: SparkSession, runs: DataFrame, links: DataFrame, root: tuple[int, int, str]) -> DataFrame:
    """(proof, subroot, leaves) of every run, climbed to the root (tree, level,
    digest in hex) by a recursive query; each leaf with its folded hash."""
    prepare(spark)
    names = [f"merkle_{kind}_{uuid.uuid4().hex}" for kind in ("runs", "links")]
    key = "spark.sql.cteRecursionRowLimit"  # a guard of 1M rows by default
    before = spark.conf.get(key, None)
    for name, table in zip(names, (runs, links)):
        table.createOrReplaceTempView(name)
    try:
        spark.conf.set(key, "-1")
        sql = _CLIMB.format(runs=names[0], links=names[1], t=root[0], level=root[1], root=f"X'{root[2]}'")
        return store(spark.sql(sql), "merkle-climb")  # the recursion runs here
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
        for name in names:
            spark.catalog.dropTempView(name)


def merkle_proofs(leaves: DataFrame) -> DataFrame:
    """``leaves``: (grp, key, leaf, tampered), digests as 32 bytes. Per row: key,
    leaf, subroot, root, proof_sha256 (H of the siblings, level by level up to the
    root, left to right), folded_root (from the tampered leaf and the siblings)
    and verified (it equals the root), digests in hex.

    A null group is a group of its own and comes first; null keys come first in
    their group; equal keys stand by leaf, and equal rows in any order. A group of
    one row is its own subroot. An empty table gives an empty result."""
    spark = prepare(leaves.sparkSession)
    result = "key bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    placed = numbered_leaves(store(leaves.select("grp", "key", "leaf", "tampered"), "leaf-digests"))
    placed = placed.withColumn("height", _height(F.col("n")))
    # the leaves of one run, together from here on; a lone leaf is a run of its own
    runs = placed.groupBy("lt", F.expr(f"idx div {FAN}").alias("run")).agg(
        F.first("height").alias("height"), F.array_sort(F.collect_list(F.struct("idx", "key", "leaf", "tampered"))).alias("members")
    )
    runs = store(runs.withColumn("digest", F.when(F.col("height") == 0, F.expr("members[0].leaf")).otherwise(F.expr(f"unhex(sha2({_JOINED.format('members.leaf')}, 256))"))), "merkle-runs")
    bounds = runs.agg(F.max("height").alias("height"), F.max("lt").alias("lt")).first()
    if bounds["height"] is None:
        return spark.createDataFrame([], result)

    level = F.least(F.col("height"), F.lit(1))  # of the node a run stands for
    first = runs.select(F.col("lt").alias("t"), F.col("run").alias("idx"), "height", "digest")
    levels = _tree(first.where("height > 1"), 1, bounds["height"])
    tops = first.where("height <= 1")
    for groups in levels:
        tops = tops.unionByName(groups.where(F.col("height") == F.col("level")).select("t", "idx", "height", "digest"))
    tops = store(tops.select(F.col("t").alias("lt"), "height", "digest"), "subroots")
    trees = bounds["lt"] + 1
    top_height = spark.range(1).select(_height(F.lit(trees)).alias("h")).first()["h"]
    above = _tree(tops.select(F.lit(TOP).cast("long").alias("t"), F.col("lt").alias("idx"), F.lit(top_height).alias("height"), "digest"), 0, top_height)
    peak = (above[-1] if above else tops).select(F.expr("lower(hex(digest))").alias("d")).first()["d"]
    root = (TOP, top_height, peak) if above else (0, bounds["height"], peak)

    links = _part_links(runs, levels, above, tops)
    tampered = "transform(members, (m, i) -> named_struct('key', m.key, 'leaf', m.leaf, 'folded', IF(height = 0, m.tampered, unhex(sha2(concat({low}, {own}, {high}), 256)))))"
    base = runs.select(
        "lt", F.expr(f"run div {FAN ** (PART_LEVEL - 1)}").alias("part"), F.col("lt").alias("t"), level.alias("level"), F.col("run").alias("idx"),
        F.expr("X''").alias("proof"), F.expr("CAST(NULL AS BINARY)").alias("subroot"),
        F.expr(tampered.format(low=_JOINED.format("slice(members.leaf, 1, i)"), own=_HEX.format("m.tampered"), high=_JOINED.format(f"slice(members.leaf, i + 2, {FAN})"))).alias("leaves"),
    )
    ended = climb(spark, base, links, root)
    others = "concat({}, {})".format(_JOINED.format("slice(leaves.leaf, 1, place)"), _JOINED.format(f"slice(leaves.leaf, place + 2, {FAN})"))
    return (
        ended.select("proof", "subroot", "leaves", F.posexplode("leaves").alias("place", "x"))
        .select(
            F.expr("x.key").alias("key"), F.expr(_HEX.format("x.leaf")).alias("leaf"), F.expr(_HEX.format("subroot")).alias("subroot"),
            F.lit(peak).alias("root"), F.sha2(F.concat(F.expr(others), F.expr(_HEX.format("proof"))), 256).alias("proof_sha256"),
            F.expr(_HEX.format("x.folded")).alias("folded_root"),
        )
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )


def _part_links(runs: DataFrame, levels: list[DataFrame], above: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The link rows, with lt and part: a node up to PART_LEVEL belongs to one
    part; what lies above has a row for each part below it."""
    part = F.expr(f"run div {FAN ** (PART_LEVEL - 1)}").alias("part")
    parts = runs.where(F.col("run") % FAN ** (PART_LEVEL - 1) == 0).select("lt", part, "height")
    ups = "transform(sequence({low}, {high}), v -> named_struct('t', {t}, 'level', v, 'idx', CAST({idx} AS BIGINT)))"
    # nodes of the group's tree from the level above a part's own, then of the top tree
    own = F.expr(ups.format(low=PART_LEVEL + 1, high="height", t="lt", idx=f"part div CAST(power({FAN}, v - {PART_LEVEL}) AS BIGINT)"))
    own = F.when(F.col("height") > PART_LEVEL, own).otherwise(F.expr("CAST(array() AS ARRAY<STRUCT<t: BIGINT, level: INT, idx: BIGINT>>)"))
    high = F.expr(ups.format(low=1, high=len(above) - 1, t=f"CAST({TOP} AS BIGINT)", idx=f"lt div CAST(power({FAN}, v) AS BIGINT)")) if len(above) > 1 else F.expr("CAST(array() AS ARRAY<STRUCT<t: BIGINT, level: INT, idx: BIGINT>>)")
    wanted = parts.select("lt", "part", F.explode(F.concat(own, high)).alias("k")).select("lt", "part", "k.*")

    inner = _links(levels)
    upper = _links(above)
    seats = None
    if upper is not None:  # a subroot's link leads into the top tree; it also names the subroot
        seat = upper.where("level = 0").join(tops.select(F.col("lt").alias("idx"), "height", F.col("digest").alias("subroot")), "idx")
        seats = seat.select(F.col("idx").alias("t"), F.col("height").alias("level"), F.lit(0).cast("long").alias("idx"), "pt", "plevel", "pidx", "low", "high", "subroot")
    nothing = F.expr("CAST(NULL AS BINARY)").alias("subroot")
    found = [x for x in (inner and inner.select("*", nothing), upper and upper.where("level > 0").select("*", nothing), seats) if x is not None]
    if not found:
        return runs.sparkSession.createDataFrame([], "lt long, part long, t long, level int, idx long, pt long, plevel int, pidx long, low binary, high binary, subroot binary")
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    links = store(links, "merkle-links")
    low = links.where((F.col("t") >= 0) & (F.col("level") <= PART_LEVEL)).select(
        F.col("t").alias("lt"), F.expr(f"idx div CAST(power({FAN}, {PART_LEVEL} - level) AS BIGINT)").alias("part"), "*"
    )
    rest = links.where((F.col("t") < 0) | (F.col("level") > PART_LEVEL)).join(wanted, ["t", "level", "idx"])
    return store(low.unionByName(rest), "merkle-part-links")


def document_manifest(docs: DataFrame) -> DataFrame:
    """The manifest of a documents table: leaves of doc_id, source, lang, n_chars
    and text, a tree per lang by doc_id. Where 3 divides the crc32 of the decimal
    doc_id (a null id counts as empty text), the tampered leaf has the text's A-Z
    in lower case. Null and empty values are distinct leaves; texts count whole;
    other columns are not read."""
    fields = {c: field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars", "text")}
    changed = {**fields, "text": field(lower_ascii(F.col("text")))}
    hit = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 0
    leaf = digest(list(fields.values()))
    rows = docs.select(
        F.col("lang").cast("string").alias("grp"), F.col("doc_id").cast("long").alias("key"), leaf.alias("leaf"),
        F.when(hit, digest(list(changed.values()))).alias("changed"),
    )
    return merkle_proofs(rows.select("grp", "key", "leaf", F.coalesce("changed", "leaf").alias("tampered"))).withColumnRenamed("key", "doc_id")
