"""Token ids of a corpus in bit-packed binary files.

A file holds one segment: a run of documents in ascending doc_id order. Each id
takes the fewest bits that hold the vocabulary. Ids are packed in blocks of
BLOCK ids, so that every block begins at a whole 64-bit word and numpy unpacks
any range of blocks at once; the offsets of the blocks stand in the segment.

Layout, little-endian: MAGIC; eight int64 (task, part, documents, ids, bits,
block ids, blocks, packed words); doc_id int64 per document; present flag uint8
per document (0: the doc_id was null); ids before each document and in all,
int64; first word of each block and their number, int64; packed words uint64.
One zero byte follows, which the writer puts after each record.

Spark's text writer stores each segment as one file with its usual task commit,
so a lost executor leaves no half-written file, on any storage Spark writes to;
its binary reader reads them back.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import new_path, prepare, running_totals, store
from strata.llm.tokenization import WordEncoder, release_memory

MAGIC = b"IDSEG001"
BLOCK = 1024
# Ids of a segment; a document stays whole, so one longer than this fills a segment alone.
SEGMENT_IDS = 2 << 20


def bits_for(vocab_size: int) -> int:
    return max(1, int(vocab_size - 1).bit_length())


def pack_ids(ids: np.ndarray, bits: int) -> np.ndarray:
    """Blocks of BLOCK ids as uint64 words; the last block is filled with zeros."""
    blocks = -(-len(ids) // BLOCK)
    lanes = np.zeros((blocks * BLOCK // 64, 64), np.uint64)
    lanes.reshape(-1)[: len(ids)] = ids
    words = np.zeros((len(lanes), bits), np.uint64)
    for lane in range(64):  # 64 ids fill exactly ``bits`` words
        word, shift = divmod(lane * bits, 64)
        words[:, word] |= lanes[:, lane] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= lanes[:, lane] >> np.uint64(64 - shift)
    return words.reshape(-1)


def unpack_ids(words: np.ndarray, bits: int) -> np.ndarray:
    """All ids of whole blocks, as uint32."""
    words = words.reshape(-1, bits)
    lanes = np.empty((len(words), 64), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for lane in range(64):
        word, shift = divmod(lane * bits, 64)
        value = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            value = value | (words[:, word + 1] << np.uint64(64 - shift))
        lanes[:, lane] = value & mask
    return lanes.reshape(-1)


def write_segment(task: int, part: int, doc_ids: list, starts: np.ndarray, ids: np.ndarray, bits: int) -> bytes:
    words = pack_ids(ids, bits)
    blocks = -(-len(ids) // BLOCK)
    head = np.array([task, part, len(doc_ids), len(ids), bits, BLOCK, blocks, len(words)], "<i8")
    known = np.array([d is not None for d in doc_ids], np.uint8)
    numbers = np.array([0 if d is None else d for d in doc_ids], "<i8")
    block_at = np.arange(blocks + 1, dtype="<i8") * (BLOCK // 64 * bits)
    return b"".join([MAGIC, head.tobytes(), numbers.tobytes(), known.tobytes(), starts.astype("<i8").tobytes(), block_at.tobytes(), words.astype("<u8").tobytes()])


class Segment:
    """Random access to one packed segment."""

    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC:
            raise ValueError("not a token id segment")
        self.task, self.part, docs, self.n_ids, self.bits, self.block, blocks, words = np.frombuffer(raw, "<i8", 8, 8).tolist()
        at = 72
        self.doc_ids = np.frombuffer(raw, "<i8", docs, at)
        at += 8 * docs
        self.known = np.frombuffer(raw, np.uint8, docs, at).astype(bool)
        at += docs
        self.starts = np.frombuffer(raw, "<i8", docs + 1, at)
        at += 8 * (docs + 1)
        self.block_at = np.frombuffer(raw, "<i8", blocks + 1, at)
        at += 8 * (blocks + 1)
        self.words = np.frombuffer(raw, "<u8", words, at)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop``, unpacking only the blocks that hold them."""
        if stop <= start:
            return np.empty(0, np.uint32)
        first, last = start // self.block, -(-stop // self.block)
        out = unpack_ids(self.words[self.block_at[first] : self.block_at[last]], self.bits)
        return out[start - first * self.block : stop - first * self.block]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))


def write_token_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> None:
    """Encode every whole text, append ``end_id`` to each, and write the ids under
    ``path`` in ascending doc_id order (null ids first, equal ids by a hash of their text).
    Null texts count as empty; other columns are not read; an empty table writes
    no segment. The rows are range-partitioned on doc_id and that hash before encoding, so each
    text moves once, each task writes its own files, and rows of one id (or of none) are
    split over tasks, all but those of one text."""
    prepare(docs.sparkSession)

    def run(batches):
        from pyspark import TaskContext

        task, part, width = TaskContext.get().partitionId(), 0, None
        doc_ids, held, lengths = [], [], []

        def segment():
            nonlocal part
            starts = np.concatenate([[0], np.cumsum(lengths)])
            raw = write_segment(task, part, doc_ids, starts, np.concatenate(held), width)
            part += 1
            return pa.RecordBatch.from_arrays([pa.array([raw], pa.binary())], ["segment"])

        for batch in batches:
            encoder = WordEncoder.shared(tokenizer_path)
            width = bits_for(max(encoder.vocab_size, end_id + 1))
            keys, row = batch.column(0).to_pylist(), 0
            for ids, at in encoder.encode(batch.column(1)):
                # the end id goes after each document
                full = np.insert(ids, at[1:], end_id)
                at = at + np.arange(len(at))
                begin = 0
                while begin < len(at) - 1:
                    room = SEGMENT_IDS - sum(lengths)
                    stop = int(np.searchsorted(at, at[begin] + max(room, 0), side="right")) - 1
                    if stop <= begin:
                        if lengths:
                            yield segment()
                            doc_ids, held, lengths = [], [], []
                            continue
                        stop = begin + 1
                    doc_ids += keys[row + begin : row + stop]
                    held.append(full[at[begin] : at[stop]])
                    lengths += np.diff(at[begin : stop + 1]).tolist()
                    begin = stop
                row += len(at) - 1
        if lengths:
            yield segment()
        release_memory(encoders=False)

    (
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .withColumn("th", F.xxhash64("text"))
        .repartitionByRange("doc_id", "th")
        .sortWithinPartitions("doc_id", "th")
        .select("doc_id", "text")
        .mapInArrow(run, "segment binary")
        .select(F.col("segment").cast("string").alias("value"))
        .write.option("lineSep", "\x00").option("maxRecordsPerFile", 1).text(path)
    )


def read_token_ids(spark: SparkSession, path: str, digest_only: bool = False) -> DataFrame:
    """Documents of the files under ``path``: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32 (of the ids as little-endian uint32), and
    unless ``digest_only`` the ids themselves."""
    prepare(spark)
    fields = [("task", "long"), ("part", "long"), ("position", "long"), ("doc_id", "long"), ("local", "long"), ("n_tokens", "long"), ("ids_crc32", "long")]
    kinds = {"long": pa.int64()}
    schema = pa.schema([(n, kinds[k]) for n, k in fields] + ([] if digest_only else [("ids", pa.list_(pa.int32()))]))

    def run(batches):
        release_memory()  # of the encoders that wrote the files
        for batch in batches:
            for raw in batch.column(0):
                s = Segment(memoryview(raw.as_buffer()).cast("B"))
                ids = s.ids(0, s.n_ids).astype("<u4", copy=False)
                spans = list(zip(s.starts[:-1].tolist(), s.starts[1:].tolist()))
                n = len(spans)
                columns = [
                    pa.array([s.task] * n, pa.int64()), pa.array([s.part] * n, pa.int64()), pa.array(range(n), pa.int64()),
                    pa.array([d if k else None for d, k in zip(s.doc_ids.tolist(), s.known)], pa.int64()),
                    pa.array(s.starts[:-1], pa.int64()), pa.array(np.diff(s.starts), pa.int64()),
                    pa.array([zlib.crc32(ids[a:b]) for a, b in spans], pa.int64()),
                ]
                if not digest_only:
                    columns.append(pa.array([ids[a:b] for a, b in spans], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
        release_memory()

    ddl = ", ".join(f"{n} {k}" for n, k in fields) + ("" if digest_only else ", ids array<int>")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    docs = store(files.select("content").mapInArrow(run, ddl), "token-docs")
    segments = docs.groupBy("task", "part").agg(F.sum("n_tokens").alias("n"))
    tasks = running_totals(segments.groupBy("task").agg(F.sum("n").alias("n")), "task", "n")
    from pyspark.sql import Window

    w = Window.partitionBy("task").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = segments.select("task", "part", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("inner")).join(tasks, "task")
    return docs.join(before, ["task", "part"]).select(
        "doc_id", (F.col("base") + F.col("inner") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", *([] if digest_only else ["ids"])
    )


def encode_to_files(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write the ids of ``docs`` to fresh files on shared storage and read them back."""
    spark = docs.sparkSession
    path = new_path(spark, "token-ids")
    write_token_ids(docs, path, tokenizer_path, end_id)
    return read_token_ids(spark, path, digest_only=True)
