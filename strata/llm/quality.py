"""Compression classifier of text quality.

Two zstandard dictionaries are built from good and from bad labelled texts. A
text is compressed block by block with each; the difference of the two sizes,
divided by the larger, tells which kind it resembles. A logistic calibration on
labelled texts that built no dictionary turns it, with the compression ratio and
the length that qualify it, into a score.

The fit uses a bounded sample of labelled rows (SAMPLE_ROWS of each class, the
first by hash of the id, half for the dictionaries and half for calibration, and
DICTIONARY_TEXT bytes of text a dictionary, of which one document gives at most
DOCUMENT_BLOCKS blocks from all over its text); every whole text is scored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import prepare
from strata.llm.labels import apply_logistic, fit_logistic, remainder, training_labels
from strata.llm.tokenization import release_memory

SAMPLE_ROWS = 8000
DICTIONARY_TEXT = 6 << 20
DICTIONARY_BYTES = 1 << 18
LEVEL = 3
# A dictionary helps most where a block begins, so long texts are cut into blocks.
BLOCK_BYTES = 8192
SAMPLE_BYTES = BLOCK_BYTES // 4
DOCUMENT_BLOCKS = 8  # of SAMPLE_BYTES each, from one document


def _pieces(text: Column, h: Column) -> Column:
    """What a document gives to a dictionary: its text, or of a longer one a block
    from each of DOCUMENT_BLOCKS equal parts, its place there chosen by hash."""
    part = F.floor(F.octet_length(text) / DOCUMENT_BLOCKS)

    def block(whole, k):
        return F.substring(whole, (k * part + F.pmod(F.xxhash64(h, k), part - SAMPLE_BYTES + 1) + 1).cast("int"), F.lit(SAMPLE_BYTES))

    whole = F.array(text.cast("binary"))
    spread = F.transform(whole, lambda t: F.transform(F.sequence(F.lit(0), F.lit(DOCUMENT_BLOCKS - 1)), lambda k: block(t, k)))
    return F.when(part < SAMPLE_BYTES, whole).otherwise(F.get(spread, F.lit(0)))


def _fitting(lengths: pd.DataFrame) -> list[int]:
    """Ids of the rows (h, doc_id, n) that fit into DICTIONARY_TEXT, in hash order;
    one that does not is skipped."""
    chosen, total = [], 0
    for i, n in lengths.sort_values(["h", "doc_id"])[["doc_id", "n"]].itertuples(index=False):
        if total + n <= DICTIONARY_TEXT:
            chosen.append(int(i))
            total += n
    return chosen


def _dictionary(texts: list[bytes]):
    import xxhash
    import zstandard

    # Distinct and mixed by hash: the trainer gives up after a run of samples alike.
    samples = sorted({t[i : i + SAMPLE_BYTES] for t in texts for i in range(0, len(t), SAMPLE_BYTES)}, key=lambda t: (xxhash.xxh3_64_intdigest(t), t))
    total = sum(map(len, samples))
    try:
        raw = zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, total // 4)), samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few samples to train on: their text itself
        raw = b"\n".join(texts)[-DICTIONARY_BYTES:]
    return raw


def _compressor(raw: bytes):
    import zstandard

    d = zstandard.ZstdCompressionDict(raw)
    d.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=d, level=LEVEL, write_content_size=False, write_dict_id=False, write_checksum=False)


def _features(good, bad, texts: pa.Array) -> np.ndarray:
    """Per text: normalised difference, ratio, log length, and their products."""
    rows = []
    for t in texts.cast(pa.large_binary()):
        buffer = t.as_buffer() if t.is_valid else b""
        n = len(buffer)
        view = memoryview(buffer)
        blocks = [view[i : i + BLOCK_BYTES] for i in range(0, n, BLOCK_BYTES)] or [view]
        g = sum(len(good.compress(b)) for b in blocks)
        b = sum(len(bad.compress(b)) for b in blocks)
        rows.append(((g - b) / max(g, b), g / max(n, 1), np.log(n + 1)))
    d, r, n = np.array(rows, np.float64).reshape(-1, 3).T
    return np.stack([d, r, n, d * r, r * r, d * d, n * r, n * n, n * d], 1)


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality") -> dict:
    """The model: both dictionaries and the calibration. With only one class
    labelled, or none, scores are that class's label, or 0.5."""
    prepare(docs.sparkSession)
    known = training_labels(labels, label)
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if set(totals) != {0, 1}:
        return {"constant": float(next(iter(totals), 0.5))}
    # each class's rows of smallest hash: at most 2 * SAMPLE_ROWS ids to broadcast
    keyed = known.withColumn("h", F.xxhash64("doc_id"))
    picked = None
    for value in (0, 1):
        part = keyed.where(F.col("label") == value).orderBy("h", "doc_id").limit(SAMPLE_ROWS)
        picked = part if picked is None else picked.unionByName(part)
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")).join(
        F.broadcast(picked), "doc_id"
    )
    building = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)) == 0
    # lengths first, so that the texts to fetch are bounded in bytes too; a repeated id gives one text
    most = F.lit(DOCUMENT_BLOCKS * SAMPLE_BYTES)
    measured = sample.withColumn("building", building).withColumn("th", F.xxhash64("text")).withColumn("n", F.least(F.octet_length("text"), most))
    first = F.struct(F.col("n") == 0, F.col("th"))
    lengths = measured.groupBy("label", "building", "h", "doc_id").agg(F.min_by("th", first).alias("th"), F.min_by("n", first).alias("n")).toPandas()
    hashes = lengths.set_index("doc_id")["th"]
    lengths = lengths[lengths["n"] > 0]
    chosen = []
    for value in (0, 1):
        own = lengths[lengths["label"] == value]
        # a class without text in its half takes the texts that calibrate
        chosen += _fitting(own[own["building"]] if own["building"].any() else own)
    ids = docs.sparkSession.createDataFrame([(i, int(hashes[i])) for i in chosen], "doc_id long, th long")
    given = sample.withColumn("th", F.xxhash64("text")).join(F.broadcast(ids), ["doc_id", "th"])
    texts = given.select("label", "h", "doc_id", _pieces(F.col("text"), F.col("h")).alias("pieces")).dropDuplicates(["doc_id"]).toPandas().sort_values(["h", "doc_id"])
    raw = {v: _dictionary([bytes(t) for pieces in texts.loc[texts["label"] == v, "pieces"] for t in pieces]) for v in (0, 1)}
    shared = docs.sparkSession.sparkContext.broadcast(raw)

    def measure(batches):
        good, bad = _compressor(shared.value[1]), _compressor(shared.value[0])
        for batch in batches:
            x = _features(good, bad, batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float64()))], ["label", "doc_id", "x"])

    # a repeated id calibrates by the one text chosen for it: rows are bounded like ids
    calibrating = docs.sparkSession.createDataFrame([(int(i), int(hashes[i])) for i in hashes.index], "doc_id long, th long")
    one = sample.where(~building).withColumn("th", F.xxhash64("text")).join(F.broadcast(calibrating), ["doc_id", "th"])
    features = one.select(F.col("label").cast("long").alias("label"), "doc_id", "text").mapInArrow(measure, "label long, doc_id long, x array<double>")
    rows = features.groupBy("label", "doc_id").agg(F.first("x").alias("x")).toPandas().sort_values(["label", "doc_id"])
    if rows["label"].nunique() < 2:
        return {"constant": totals[1] / (totals[0] + totals[1])}
    y = rows["label"].to_numpy(np.float64)
    share = {v: totals[v] / (y == v).sum() for v in (0, 1)}  # back to the classes' true proportion
    model = fit_logistic(np.stack(rows["x"].to_numpy()), y, np.where(y == 1, share[1], share[0]))
    return {"dictionaries": raw, "calibration": model}


def _scored(docs: DataFrame, model: dict, columns: list[str]) -> DataFrame:
    """``columns`` renamed c0, c1, ..., so that no name clashes, and score."""
    spark = prepare(docs.sparkSession)
    names = [f"c{i}" for i in range(len(columns))]
    kept = docs.select(*(F.col(c).alias(n) for c, n in zip(columns, names)), *([] if "text" in columns else [F.col("text").alias("t")]))
    if "constant" in model:
        return kept.select(*names, F.lit(model["constant"]).alias("score"))
    shared = spark.sparkContext.broadcast(model)
    at = columns.index("text") if "text" in columns else len(names)

    def run(batches):
        m = shared.value
        good, bad = _compressor(m["dictionaries"][1]), _compressor(m["dictionaries"][0])
        for batch in batches:
            score = apply_logistic(m["calibration"], _features(good, bad, batch.column(at))) if batch.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(score, pa.float64())], [*names, "score"])
        release_memory()

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema.fields[: len(names)]) + ", score double"
    return kept.mapInArrow(run, ddl)


def score_quality(docs: DataFrame, model: dict, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` with ``score``, the probability of label 1, computed
    from the whole text alone. Null texts count as empty; every row, repeated or
    of null id, gets its own score; an empty table gives an empty result."""
    return _scored(docs, model, columns).toDF(*columns, "score")


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, all columns."""
    scored = _scored(docs, fit_quality(docs, labels), docs.columns).where(F.col("score") >= threshold)
    return scored.drop("score").toDF(*docs.columns)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    scored = score_quality(docs, fit_quality(docs, labels), ["doc_id"])
    return scored.select("doc_id", (remainder("doc_id") == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
