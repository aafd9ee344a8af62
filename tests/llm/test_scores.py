"""Quality and toxicity: held-out accuracy, brute-force model, edge cases."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import quality, toxicity
from strata.llm.common import prepare, table
from strata.llm.labels import fit_logistic, remainder, sigmoid
from strata.llm.quality import keep_quality, quality_scores
from strata.llm.toxicity import KeyTable, evidence, fit_counts, keep_ordinary, toxicity_scores, word_keys
from tests.conftest import SF_ORACLE

EDGE = [(10, None), (11, ""), (None, "a null id"), (12, "same"), (12, "same"), (13, "very long " * 20_000), (14, "%%% ### !!")]


@pytest.fixture(scope="module")
def tables(spark):
    return prepare(spark) and table(spark, SF_ORACLE, "documents"), table(spark, SF_ORACLE, "labels")


def _edge(spark):
    return spark.createDataFrame([(i, t, "c") for i, t in EDGE], "doc_id long, text string, score string")


def test_quality_on_held_out_rows(spark, tables):
    docs, labels = tables
    scored = quality_scores(docs, labels).join(labels.select("doc_id", "quality"), "doc_id").where("held_out")
    rows = scored.collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.9
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_one_class_or_no_labels_give_a_constant(spark, tables):
    docs, labels = tables
    edge = _edge(spark)
    for scores in (quality_scores, toxicity_scores):
        none = scores(edge, labels.limit(0)).collect()
        assert len(none) == len(EDGE) and len({r["score"] for r in none}) == 1
    assert {r["predicted"] for r in quality_scores(edge, labels.where("quality = 1")).collect()} == {1}


def test_nulls_empty_repeated_and_clashing_columns(spark, tables):
    docs, labels = tables
    edge = docs.select("doc_id", "text").withColumn("score", remainder("doc_id").cast("string")).unionByName(_edge(spark))
    for scores, keep in ((quality_scores, keep_quality), (toxicity_scores, keep_ordinary)):
        rows = scores(edge, labels).collect()
        assert len(rows) == 1000 + len(EDGE) and all(0 <= r["score"] <= 1 for r in rows)
        assert scores(docs, labels).count() == 1000
        kept = keep(edge, labels)
        assert kept.columns == edge.columns and 0 < kept.count() < 1000 + len(EDGE)
        limit = 0.3 if scores is quality_scores else 0.5
        want = sum(r["score"] >= limit if scores is quality_scores else r["score"] < limit for r in rows)
        assert kept.count() == want


@pytest.mark.parametrize("size", [7 << 20, (6 << 20) - 100])
def test_one_long_text_leaves_the_dictionary_to_the_others(spark, tables, monkeypatch, size):
    docs, labels = tables
    ids = spark.range(10**6, 2 * 10**6).withColumnRenamed("id", "doc_id").where((remainder("doc_id") != 0) & (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)) == 0))
    first = ids.orderBy(F.xxhash64("doc_id")).first()[0]  # before all others of its class
    long = spark.createDataFrame([(first, 0)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "_dictionary", lambda texts, made=quality._dictionary: seen.append(texts) or made(texts))
    quality.fit_quality(docs, labels)
    plain = [sorted(t) for t in seen]
    seen.clear()
    known = labels.select("doc_id", "quality").unionByName(long)
    edge = docs.select("doc_id", "text").unionByName(long.select("doc_id", F.repeat(F.lit("Q"), F.lit(size)).alias("text")))
    model = quality.fit_quality(edge, known)
    assert all(len(raw) > 1000 for raw in model["dictionaries"].values())
    given = [t for t in seen[0] if not t.strip(b"Q")]
    assert 0 < sum(map(len, given)) <= 1 << 14
    assert [sorted(t for t in texts if t not in given) for texts in seen] == plain


def test_a_repeated_id_calibrates_once(spark, tables, monkeypatch):
    docs, labels = tables
    counts = []
    monkeypatch.setattr(quality, "fit_logistic", lambda x, y, w, made=quality.fit_logistic: counts.append(len(y)) or made(x, y, w))
    half = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)) == 0
    known = docs.join(labels, "doc_id").where(~half & (F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) != 0))
    one = known.select(*docs.columns).orderBy("doc_id").limit(1)
    more = docs.unionByName(one.select(*docs.columns).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(2000)))).drop("n"))
    plain, repeated = quality.fit_quality(docs, labels), quality.fit_quality(more, labels)
    assert counts[0] == counts[1] < 2000
    assert plain["dictionaries"] == repeated["dictionaries"]


def test_blocks_come_from_all_over_a_long_text(spark):
    text = "".join(chr(0x61 + k // 10_000) for k in range(260_000))
    pieces = spark.createDataFrame([(text, 5), ("short é", 5), ("", 5)], "t string, h long").select(quality._pieces(F.col("t"), F.col("h"))).collect()
    assert len(pieces[0][0]) == quality.DOCUMENT_BLOCKS and {len(p) for p in pieces[0][0]} == {quality.SAMPLE_BYTES}
    assert len(set(b"".join(pieces[0][0]))) >= quality.DOCUMENT_BLOCKS
    assert [bytes(p) for r in pieces[1:] for p in r[0]] == ["short é".encode(), b""]


def test_a_class_without_text_in_its_half_still_has_a_dictionary(spark, tables):
    docs, labels = tables
    half = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)) == 0
    emptied = docs.join(labels.select("doc_id", "quality"), "doc_id").withColumn("text", F.when(half & (F.col("quality") == 0), "").otherwise(F.col("text")))
    assert all(raw.strip() for raw in quality.fit_quality(emptied, labels)["dictionaries"].values())


def test_toxic_rows_score_higher(spark, tables):
    docs, labels = tables
    rows = toxicity_scores(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").collect()
    toxic, ordinary = ([r["score"] for r in rows if r["toxic"] == x] for x in (1, 0))
    # chance that a toxic row scores above an ordinary one
    assert np.mean([a > b for a in toxic for b in ordinary]) >= 0.9


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (table(prepare(spark), "/root/testdata/sf0.1", name) for name in ("documents", "labels"))
    rows = toxicity_scores(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out").collect()
    found, flagged = (sum(r["predicted"] for r in rows if r["toxic"] == x) for x in (1, 0))
    assert found >= 0.85 * sum(r["toxic"] for r in rows) and flagged <= 5


TRAIN = [(1, "you idiot moron", 1), (2, "the cat sat on the mat", 0), (3, "a cat and a dog", 0), (4, "idiot Idiot the moron", 1), (6, "dogs sat, a moron", 0), (8, "you idiot moron", 1)]


def _words(text):
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def _brute(rows, d):
    """The evidence of a text, straight from the docstring."""
    before = {1: {}, 0: {}}
    for _, text, label in rows:
        words = _words(text)
        for v, w in zip([None, *words], words):
            before[label].setdefault(w, set()).add(v)
    both = {w: before[0].get(w, set()) | before[1].get(w, set()) for w in {*before[0], *before[1]}}
    n, sd = sum(map(len, both.values())), toxicity.SHARED_DISCOUNT
    total = {c: sum(map(len, before[c].values())) for c in (0, 1)}
    keep = lambda k: max(k - d, toxicity.LEAST_SHARE * k)
    left = {c: 1 - sum(keep(len(v)) for v in before[c].values()) / total[c] for c in (0, 1)}

    def e(w):
        if w not in both:
            return 0.0
        shared = (len(both[w]) - sd) / n + sd * len(both) / n / (len(both) + 1)
        p = {c: keep(len(before[c].get(w, ()))) / total[c] + left[c] * shared for c in (0, 1)}
        return max(math.log(p[1] / p[0]) - math.log(left[1] / left[0]), 0.0)

    def evidences(text):
        words = _words(text)
        best = sorted((e(w) for w in set(words)), reverse=True)[: toxicity.TELLING]
        return sum(best) / toxicity.TELLING, sum(map(e, words)) / max(len(words), 1)

    return evidences


@pytest.mark.parametrize("entries", [1_000_000, 1])
def test_evidence_equals_brute_force_by_broadcast_or_join(spark, entries):
    prepare(spark)
    docs = spark.createDataFrame([(i, t) for i, t, _ in TRAIN], "doc_id long, text string")
    known = spark.createDataFrame([(i, y) for i, _, y in TRAIN], "doc_id long, label int")
    folds = {r[0]: r[1] for r in docs.select("doc_id", remainder("doc_id")).collect()}
    used = [t for t in TRAIN if folds[t[0]] != toxicity.CALIBRATION_FOLD]
    assert {y for _, _, y in used} == {0, 1}
    model = {"table": fit_counts(docs, known, 0.5), "entries": entries}
    texts = ["idiot", "the cat", "a moron sat, on a dog", "Zzz 9", "cat idiot moron idiot you you", "", None, "x " * 3000 + "moron"]
    scored = evidence(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model, ["doc_id"]).collect()
    assert len(scored) == len(texts) and model["few"] == (entries > 1)
    brute = _brute(used, 0.5)
    for r in scored:
        assert (r["peak"], r["mean"]) == pytest.approx(brute(texts[r["c0"]] or ""), rel=1e-9, abs=1e-12)
    assert max(r["peak"] for r in scored) > 0


def _brute_mean(rows, d):
    """The mean evidence with the word before, straight from the docstring."""
    before, pairs, after = {1: {}, 0: {}}, {1: Counter(), 0: Counter()}, {}
    for _, text, label in rows:
        words = _words(text)
        for v, w in zip([None, *words], words):
            before[label].setdefault(w, set()).add(v)
            pairs[label][v, w] += 1
            after.setdefault(v, set()).add(w)
    every = pairs[0] + pairs[1]
    both = {w: before[0].get(w, set()) | before[1].get(w, set()) for w in {*before[0], *before[1]}}
    n, sd = sum(map(len, both.values())), toxicity.SHARED_DISCOUNT
    total = {c: sum(map(len, before[c].values())) for c in (0, 1)}
    keep = lambda k: max(k - d, toxicity.LEAST_SHARE * k)
    left = {c: 1 - sum(keep(len(v)) for v in before[c].values()) / total[c] for c in (0, 1)}

    def order(counts, v, w):
        """What the discount leaves of a pair, and what it takes after v."""
        c = sum(counts[v, x] for x in after.get(v, ()))
        return (max(counts[v, w] - d, 0) / c, sum(min(counts[v, x], d) for x in after[v]) / c) if c else (0, 1)

    def e(v, w):
        if w not in before[1]:
            return 0.0
        shared = (len(both[w]) - sd) / n + sd * len(both) / n / (len(both) + 1)
        p = {}
        for c in (0, 1):
            low = (keep(len(before[c].get(w, ()))) / total[c] + left[c] * shared) * left[1] / left[c]
            seen, rest = order(every, v, w)
            own, own_rest = order(pairs[c], v, w)
            p[c] = own / own_rest + seen + rest * low
        return max(math.log(p[1] / p[0]), 0.0)

    def mean(text):
        words = _words(text)
        return sum(e(v, w) for v, w in zip([None, *words], words)) / max(len(words), 1)

    return mean


@pytest.mark.parametrize("entries", [1_000_000, 1])
def test_the_word_before_counts_as_by_brute_force(spark, entries):
    prepare(spark)
    more = [(201, "you idiot dog", 1), (202, "the idiot sat. You dog", 0), (203, "dog you idiot", 1), (204, "a dog sat on you", 0), (206, "the dog you moron", 1)]
    docs = spark.createDataFrame([r[:2] for r in TRAIN + more], "doc_id long, text string")
    known = spark.createDataFrame([(i, y) for i, _, y in TRAIN + more], "doc_id long, label int")
    folds = {r[0]: r[1] for r in docs.select("doc_id", remainder("doc_id")).collect()}
    counts = toxicity.count_words(docs, known, 0.5)
    lower = toxicity.lower_order(counts, 0.5)
    model = {"table": lower.where("e > 0").select("w", "e"), "pairs": toxicity.higher_order(counts, lower, 0.5), "entries": entries}
    texts = ["you idiot", "idiot you", "the dog, you dog", "dog you moron", "on the idiot sat you idiot a dog", "Zzz you 9 idiot", "", None, "a dog " * 2000 + "idiot moron"]
    scored = evidence(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model, ["doc_id"]).collect()
    assert len(scored) == len(texts) and model["few"] == (entries > 1)
    used = [r for r in TRAIN + more if folds[r[0]] != toxicity.CALIBRATION_FOLD]
    peak, mean = _brute(used, 0.5), _brute_mean(used, 0.5)
    got = {r["c0"]: (r["peak"], r["mean"]) for r in scored}
    for i, text in enumerate(texts):
        assert got[i] == pytest.approx((peak(text or "")[0], mean(text or "")), rel=1e-9, abs=1e-12)
    assert got[0][1] != pytest.approx(got[1][1])  # the order of words matters


def test_copies_add_no_contexts(spark):
    prepare(spark)
    rows = [(i, t, y) for i, t, y in TRAIN] + [(100 + i, "the cat sat on a moron", 1) for i in range(50)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    known = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, label int")
    once = spark.createDataFrame([r for r in known.collect() if r[0] <= 100], known.schema)
    fold = remainder("doc_id") != toxicity.CALIBRATION_FOLD
    if known.where(fold & (F.col("doc_id") > 100)).isEmpty() or once.where(fold & (F.col("doc_id") == 100)).isEmpty():
        once = known
    assert sorted(map(tuple, fit_counts(docs, known, 0.5).collect())) == sorted(map(tuple, fit_counts(docs, once, 0.5).collect()))


def test_word_keys_and_key_table():
    long = "Ab, c!! " + "word é " * 500_000
    keys, at = word_keys(pa.array(["Ab, c!!", None, long, "ab c ab"], pa.large_string()))
    assert at.tolist() == [0, 2, 2, 1_000_004, 1_000_007]
    assert keys[at[2] - 2 :][:2].tolist() == keys[:2].tolist() == keys[-3:-1].tolist() and keys[-1] == keys[0]
    assert len(np.unique(keys)) == 4
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 63, 5000, dtype=np.uint64))
    t = KeyTable(keys)
    assert (t.find(keys) == np.arange(len(keys))).all() and (t.find(keys + np.uint64(1)) < 0).mean() > 0.99
    assert (KeyTable(keys[:0]).find(keys) == -1).all()


def test_logistic_finds_known_weights():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(20_000, 2))
    y = (rng.random(20_000) < sigmoid(0.5 + x @ [2.0, -1.0])).astype(float)
    m = fit_logistic(x, y, np.ones(len(y)))
    assert np.allclose(m["w"][1:] / m["spread"], [2, -1], atol=0.1)


def _scored_rows(spark, entries):
    docs = spark.createDataFrame([(i, t) for i, t, _ in TRAIN], "doc_id long, text string")
    known = spark.createDataFrame([(i, y) for i, _, y in TRAIN], "doc_id long, label int")
    counts = toxicity.count_words(docs, known, 0.5)
    lower = toxicity.lower_order(counts, 0.5)
    model = {"table": lower.where("e > 0").select("w", "e"), "pairs": toxicity.higher_order(counts, lower, 0.5), "entries": entries}
    texts = ["you idiot", "", None, "a dog sat on the moron cat idiot", "a dog " * 2000 + "idiot moron idiot"]
    rows = evidence(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model, ["doc_id"]).collect()
    return model, {r["c0"]: (r["peak"], r["mean"]) for r in rows}


def test_a_model_beyond_one_broadcast_moves_no_texts(spark, monkeypatch):
    prepare(spark)
    model, whole = _scored_rows(spark, 1_000_000)
    stored, real = [], toxicity.store
    monkeypatch.setattr(toxicity, "store", lambda df, label: stored.append(label) or real(df, label))
    parted, rows = _scored_rows(spark, 3)
    assert model["few"] and not parted["few"] and parted["shards"] > 1
    assert "toxicity-texts" not in stored
    assert rows.keys() == whole.keys() and all(rows[i] == pytest.approx(whole[i], rel=1e-12) for i in rows)
    monkeypatch.setattr(toxicity, "MAX_SHARDS", 1)
    joined, rows = _scored_rows(spark, 3)
    assert joined["shards"] == 1 and "toxicity-texts" in stored
    assert rows.keys() == whole.keys() and all(rows[i] == pytest.approx(whole[i], rel=1e-9) for i in rows)


def test_pairs_are_sent_in_few_bytes_and_counted_whole(monkeypatch):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(words[k] for k in np.minimum(rng.zipf(1.3, 400), 2999)) for _ in range(60)] + ["", None, "one"]
    labels = [i % 3 == 0 for i in range(len(texts))]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array([int(x) for x in labels])], ["text", "label"])
    pairs, befores = {True: Counter(), False: Counter()}, Counter()
    for text, toxic in zip(texts, labels):
        keys = word_keys(pa.array([text or ""]))[0].tolist()
        for v, w in zip([0, *(k >> 32 for k in keys)], keys):
            pairs[toxic][w, v] += 1
            befores[v] += 1
    both = pairs[True] + pairs[False]
    for bands, salts, held in ((1, 1, 1 << 20), (4, 3, 1 << 20), (2, 5, 700)):
        monkeypatch.setattr(toxicity, "HELD_PAIRS", held)
        monkeypatch.setattr(toxicity, "SLICE_BYTES", 2000)
        sent = [r for b in toxicity._blocks(bands, salts)([batch]) for r in b.to_pylist()]
        assert {r["cell"] for r in sent} == set(range(bands * salts))
        if bands == 1:  # 24 bytes each as rows
            assert sum(len(r["block"]) for r in sent) < 9 * sum(r["pairs"] for r in sent)
        sent.sort(key=lambda r: r["cell"])
        got = [r for b in toxicity._counted(2.0)([pa.RecordBatch.from_pylist(sent)]) for r in b.to_pylist()]
        often = {(r["w"] % 2**64, r["v"]): (r["t"], r["o"]) for r in got if r["kind"] == toxicity._OFTEN}
        assert often == {k: (pairs[True][k], pairs[False][k]) for k, c in both.items() if c > 2}
        distinct, before = Counter(), Counter()
        for r in got:
            if r["kind"] != toxicity._OFTEN:
                before[(r["w"] % 2**64) >> 32] += r["ct"] + r["co"]
            if r["kind"] == toxicity._WORD:
                for c in "ton":
                    distinct[c, r["w"] % 2**64] += r[c]
        assert +before == befores
        for c, of in (("t", pairs[True]), ("o", pairs[False]), ("n", both)):
            assert {w: k for (name, w), k in distinct.items() if name == c and k} == Counter(w for w, _ in of)


def test_counts_in_many_cells_equal_those_in_one(spark, monkeypatch):
    prepare(spark)
    docs = spark.createDataFrame([(i, t) for i, t, _ in TRAIN], "doc_id long, text string")
    known = spark.createDataFrame([(i, y) for i, _, y in TRAIN], "doc_id long, label int")
    one = sorted(map(tuple, toxicity.count_words(docs, known, 0.5).collect()))
    monkeypatch.setattr(toxicity, "CELL_BYTES", 20)
    monkeypatch.setattr(toxicity, "MAX_BANDS", 2)
    assert one and sorted(map(tuple, toxicity.count_words(docs, known, 0.5).collect())) == one
