"""Archives, source mixing and the pipeline."""

import base64
import gzip
import hashlib
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import mixing, warc
from strata.llm.common import new_path, prepare, store, table
from strata.llm.mixing import WEIGHTS, mixing_copies, mixture, source_targets
from strata.llm.toxicity import toxicity_scores
from strata.llm.quality import quality_scores
from tests.conftest import SF_SMALL

PAGES = [(5, "http://a/ x", "<p>same</p>"), (2, None, "<p>same</p>"), (9, "u", None), (3, "u", ""), (None, "u", "<p>same</p>"), (4, "é\n", "ñ" * 50_000), (4, "é", "other"), (None, "v", "alone\r\n\r\nWARC/1.1")]


def test_archive_round_trip(spark):
    prepare(spark)
    pages = spark.createDataFrame([(*p, 1) for p in PAGES], "page_id long, url string, html string, payload int").repartition(3)
    got = sorted((tuple(r)[:5] for r in warc.archive_round_trip(pages).collect()), key=str)
    first = {"<p>same</p>": 2, "": 3}
    want = []
    for i, _, html in PAGES:
        raw = (html or "").encode()
        refers = first.get(html or "") if first.get(html or "") not in (None, i) else None
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if refers else "response", refers))
    assert got == sorted(want, key=str)
    assert warc.archive_round_trip(pages.limit(0)).count() == 0
    least = {r["page_id"]: r["record_type"] for r in warc.archive_round_trip(pages.where("page_id is not null"), 5).collect()}
    assert least[9] == least[3] == "response" and least[5] == "revisit"


def test_normaliser_gives_members_and_offsets(spark):
    prepare(spark)
    raw, target = new_path(spark, "raw"), new_path(spark, "normal")
    pages = spark.createDataFrame(PAGES[:4], "page_id long, url string, html string").coalesce(1)
    warc.write_monolithic(warc.plan_revisits(pages).coalesce(1), raw)
    (whole,) = [bytes(r["content"]) for r in spark.read.format("binaryFile").load(raw).collect()]
    d = zlib.decompressobj(31)
    d.decompress(whole)
    assert d.eof and not d.unused_data.strip(b"\0")  # one stream over the whole file
    index = warc.normalise(spark, raw, target).collect()
    (file,) = [bytes(r["content"]) for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(target).where("kind = 'warc'").collect()]
    assert gzip.decompress(file) == gzip.decompress(whole)
    assert len(index) == 4
    for e in index:
        member = zlib.decompressobj(31)
        fields, _ = warc.parse_record(member.decompress(file[e["offset"] : e["offset"] + e["length"]]))
        assert member.eof and not member.unused_data and fields["warc-record-id"] == e["record_id"]


def test_records_over_any_pieces():
    records = [warc.make_record(i, "u", b"x" * i * 100 + b"\r\n\r\n", None) for i in range(5)]
    whole = b"".join(records)
    for step in (1, 7, 10_000):
        assert list(warc.records_of(whole[i : i + step] for i in range(0, len(whole), step))) == records
    with pytest.raises(ValueError):
        list(warc.records_of([whole[:-3]]))
    two = gzip.compress(records[0]) + gzip.compress(records[1]) + b"\0\0"
    assert b"".join(warc.inflate(two)) == records[0] + records[1]
    with pytest.raises(ValueError):
        list(warc.inflate(gzip.compress(whole)[:-20]))


def _targets(sizes):
    """Water filling, round by round."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(order)}
    left, stopped = 1.5 * sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in stopped]
        if not open_:
            return stopped
        level = (left - sum(stopped.values())) / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] >= 2 * sizes[s]]
        if not over:
            return stopped | {s: level * weight[s] for s in open_}
        stopped |= {s: 2.0 * sizes[s] for s in over}


def test_targets_equal_water_filling(spark):
    prepare(spark)
    rng = np.random.default_rng(2)
    for n in (1, 2, 7, 20):
        sizes = {f"s{i}": int(rng.integers(1, 10) ** 4) for i in range(n)} | {None: 50, "ñ": 7, "Z": 0}
        df = spark.createDataFrame(list(sizes.items()), "source string, size long")
        got = {r["source"]: r["target"] for r in source_targets(df).collect()}
        assert got == pytest.approx(_targets(sizes))


def _documents(spark, n=1500):
    rng = np.random.default_rng(4)
    rows = [(i, None if i % 97 == 0 else " ".join(["w"] * int(rng.integers(1, 60))), None if i % 50 == 3 else f"s{int(rng.integers(0, 9)) if i % 3 else 0}", "x") for i in range(n)]
    rows += [rows[5]] * 3 + [(None, "a b", "s1", "x")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, copies string")


def test_mix_meets_its_targets_and_reruns_agree(spark):
    prepare(spark)
    rows, df = _documents(spark)
    got = mixing_copies(df.repartition(7), ["doc_id", "source"]).toDF("doc_id", "source", "size", "total", "target", "times").collect()
    assert len(got) == len(rows)
    taken, target, largest = Counter(), {}, Counter()
    for r in got:
        assert 0 <= r["times"] <= 2
        taken[r["source"]] += r["times"] * r["size"]
        target[r["source"]] = r["target"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in target:  # a single fraction is left to chance
        assert abs(taken[s] - target[s]) <= largest[s] + 1e-6
    again = mixing_copies(df.repartition(3), ["doc_id", "source"]).toDF("doc_id", "source", "size", "total", "target", "times").collect()
    key = lambda rs: sorted(map(str, ((r["doc_id"], r["size"], r["times"]) for r in rs)))
    assert key(got) == key(again)
    mixed = mixture(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r["times"] for r in got)
    assert mixture(df.limit(0)).count() == 0


def test_null_ids_and_equal_rows_fill_no_bucket(spark):
    prepare(spark)
    rows = [(i, "a b c", "s") for i in range(1000)] + [(None, "a b c", "s")] * 1000 + [(None, f"w{i} b c", "s") for i in range(500)] + [(7, "", "s")] * 500
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")

    def keys(n):
        sized = df.repartition(n).select("source", F.col("doc_id").alias("id"), mixing.words(F.col("text")).alias("size"), F.xxhash64("text").alias("th"))
        return [r["h"] for r in mixing._draw_keys(store(sized.withColumn("u", F.monotonically_increasing_id()), "t"), 7).collect()]

    one, other = keys(1), keys(5)
    assert len(set(one)) == len(rows) and sorted(one) == sorted(other)
    assert max(Counter(h % 40 for h in one).values()) <= 130
    outcomes = [Counter(map(tuple, mixing_copies(df.repartition(n), ["doc_id", "text"]).collect())) for n in (2, 6)]
    assert outcomes[0] == outcomes[1] and sum(outcomes[0].values()) == len(rows)
    empty = sum(n * r[-1] for r, n in outcomes[0].items() if r[1] == "")
    assert 500 < empty < 1000  # equal rows without words are drawn one by one


def _spark_hash(*parts):
    seed = 42
    for kind, value in parts:
        seed = xxhash.xxh64_intdigest(struct.pack("<" + kind, value), seed)
    return (seed & ((1 << 52) - 1)) / (1 << 52)


def _rounded(units, seed):
    """Pivotal rounding in word mass of units (h, size, p, u), one after the other."""
    out, level = {}, 0
    n = -(-len(units) // mixing.BUCKET)
    groups = {}
    for unit in units:
        groups.setdefault(unit[0] % n, []).append(unit)
    while True:
        left = {}
        for g, members in groups.items():
            a = None
            for b in sorted(members):
                if a is None:
                    a = b
                    continue
                (ha, sa, pa, ua), (hb, sb, pb, ub) = a, b
                ma, mb = pa * sa, pb * sb
                up, down = min(sa - ma, mb), min(ma, sb - mb)
                if _spark_hash(("i", seed), ("i", level), ("q", ha), ("q", hb)) * (up + down) < down:
                    pa, pb = (1.0 if sa - ma <= mb else (ma + mb) / sa), (0.0 if mb <= sa - ma else (mb - (sa - ma)) / sb)
                else:
                    pa, pb = (0.0 if ma <= sb - mb else (ma - (sb - mb)) / sa), (1.0 if sb - mb <= ma else (mb + ma) / sb)
                still = []
                for unit in ((ha, sa, pa, ua), (hb, sb, pb, ub)):
                    if 1e-12 < unit[2] < 1 - 1e-12:
                        still.append(unit)
                    else:
                        out[unit[3]] = round(unit[2])
                a = still[0] if still else None
            if a is not None:
                left[g] = a
        if n <= 1:
            return out | {unit[3]: None for unit in left.values()}  # left to a draw
        level, n, groups = level + 1, -(-n // mixing.BUCKET), {}
        for g, unit in left.items():
            groups.setdefault(g // mixing.BUCKET, []).append(unit)


def test_rounding_equals_brute_force(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(mixing, "BUCKET", 8)  # several levels
    rng = np.random.default_rng(2)
    units = [(int(rng.integers(-(2**63), 2**63)), float(rng.integers(1, 40)), float(rng.uniform(0.05, 0.95)), u) for u in range(300)]
    rows = spark.createDataFrame([("s", s, p, h, u) for h, s, p, u in units], "source string, size double, frac double, h long, u long")
    got = {r["u"]: r["extra"] for r in mixing._decisions(rows, 7).collect()}
    want = _rounded(units, 7)
    last = [u for u, extra in want.items() if extra is None]
    assert len(got) == len(units) == len(want) and len(last) <= 1
    assert {u: e for u, e in got.items() if u not in last} == {u: e for u, e in want.items() if u not in last}


def test_copies_keep_their_expectation(spark):
    prepare(spark)
    df = spark.createDataFrame([(i, "w " * (i % 7 + 1), "a" if i % 2 else "b") for i in range(300)], "doc_id long, text string, source string")
    total, wanted = Counter(), {}
    for seed in range(6):
        for r in mixing_copies(df, ["doc_id"], seed).collect():
            total[r["doc_id"]] += r["copies"]
            wanted[r["doc_id"]] = r["target"] / r["source_size"]
    small = [i for i in wanted if i % 7 < 3]  # no size is preferred
    assert abs(np.mean([total[i] / 6 - wanted[i] for i in small])) < 0.1


def test_texts_of_the_mix_are_not_shuffled(spark):
    prepare(spark)
    rows, df = _documents(spark)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")  # as if the decisions were many
    try:
        mixed = mixture(df.repartition(5))
        plan = mixed._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
        copies = mixing_copies(df.repartition(5), df.columns).collect()
    finally:
        spark.conf.set(key, before)
    want = Counter()
    for r in copies:
        want[tuple(r[:4])] += r[-1]
    assert Counter(map(tuple, mixed.collect())) == +want


def test_decisions_as_bits(spark):
    prepare(spark)
    taken = {0, 1, 62, 63, 64, 127, (5 << 33) + 63, (5 << 33) + 64}
    every = taken | {2, 65, (5 << 33) + 1, (6 << 33)}
    bits = mixing._as_bits(spark.createDataFrame([(u, int(u in taken)) for u in every], "u long, extra int"))
    got = {r["word"]: r["bits"] & (2**64 - 1) for r in bits.collect()}
    assert {(w << 6) + i for w, b in got.items() for i in range(64) if b >> i & 1} == taken


def test_pipeline_equals_its_parts(spark):
    prepare(spark)
    docs, labels = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "mixing", "packing"]
    at, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        at = seen[name] = store(stage(spark, at, SF_SMALL), name)
        if name != "packing":
            assert at.columns == docs.columns
    ids = {k: Counter(r["doc_id"] for r in df.select("doc_id").collect()) for k, df in seen.items()}
    good = Counter(r["doc_id"] for r in quality_scores(docs, labels).where("predicted = 1").collect())
    assert ids["quality"] == good
    ordinary = Counter(r["doc_id"] for r in toxicity_scores(seen["quality"], labels).where("predicted = 0").collect())
    assert ids["toxicity"] == ordinary
    # near-duplicates by brute force
    sets = {}
    for r in seen["toxicity"].collect():
        w = (r["text"] or "").split()
        sets[r["doc_id"]] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    links = {i: {j for j in sets if j != i and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) and sets[i]} for i in sets}
    first, kept = set(), []
    for i in sorted(sets):
        if i not in first:
            kept.append(i)
            stack = [i]
            while stack:
                x = stack.pop()
                if x not in first:
                    first.add(x)
                    stack += links[x]
    assert ids["near_duplicates"] == Counter(kept)
    assert set(ids["mixing"]) <= set(kept) and max(ids["mixing"].values()) <= 2
    whole = Counter()
    for r in seen["packing"].select("doc_id", "row_key", "doc_tokens", "length").collect():
        whole[(r["doc_id"], r["row_key"], r["doc_tokens"])] += r["length"]
    assert all(n == tokens for (_, _, tokens), n in whole.items())
    assert Counter(d for d, _, _ in whole) == ids["mixing"]
    assert corpus_pipeline.run(spark, SF_SMALL).count() == seen["packing"].count()
