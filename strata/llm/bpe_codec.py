"""Byte-level BPE encoding by a table of distinct words, and decoding by a join.

Texts are cut into words where a pre-token of the vocabulary's pattern begins
whatever surrounds it: before a space that something visible follows, between
letters and ASCII signs, around a single line feed. So the ids of a text are those
of its words in order. Characters that engines may class differently allow no cut,
and texts with special strings are cut at spaces only, which those do not hold.

1. The corpus's most frequent words, a bounded number, are encoded and broadcast.
2. Blocks of documents (8 MB of text) number the words they hold: frequent ones
   by their place in that table, others by their own. Stored are the codes of the
   block in text order and, by hash bucket, the other words with their codes.
3. The other words are dealt by bucket, each distinct one is encoded once, and its
   ids go back to every (block, code).
4. The blocks are a table bucketed by block, so only ids move to them; each block
   lays them at the positions of its codes.
5. Decoding joins ids with the vocabulary's table of ids and byte pieces, which is
   broadcast: ``decode_ids`` for rows of ids, and for the words of a block the same
   join within its task, once for each distinct word.

Texts never move, and no row per word of text is made.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import new_path, prepare
from strata.llm.token_counts import frequent_pieces
from strata.llm.tokenization import _byte_letters, _load, release_memory

BLOCK_BYTES = 8 << 20
# Words of the broadcast table, at most: it saves moving them. A piece has at most
# 64 bytes, so the table is bounded by 64 MB and is some 8 MB in practice.
FREQUENT_WORDS = 1 << 18

# One meaning in every engine: ASCII signs and digits, letters of Latin-1 and Latin
# Extended-A. A space allows a cut unless what follows may count as white space.
_LETTER = r"A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{148}\x{14a}-\x{17e}"
_SIGN = r"!-&(-@\[-`{-~"
_SPACE = r"(?= [^\x00-\x20\x7f-\xa0\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}\x{205f}-\x{206f}\x{3000}\x{feff}])"
_FINE = "|".join([
    _SPACE,
    rf"(?<=[{_LETTER}])(?=[{_SIGN}'\n])", rf"(?<=[{_SIGN}])(?=[{_LETTER}])",
    rf"(?<=[{_SIGN}'])(?=\n)", rf"(?<=[{_LETTER}!-~]\n)(?=[{_LETTER}!-~])",
])

_CODEC = "zstd"


def words_of(text: Column, tokenizer_path: str) -> Column:
    """The words of ``text``, in order; together they are the text."""
    special = [t.content for t in _load(tokenizer_path).get_added_tokens_decoder().values()]
    fine = F.split(text, _FINE)
    if not special:
        return fine
    held = F.lit(False)
    for string in special:
        held = held | F.contains(text, F.lit(string))
    return F.when(held, F.split(text, _SPACE)).otherwise(fine)


def _squeeze(data, level: int = 9) -> bytes:
    return pa.Codec(_CODEC, compression_level=level).compress(data, asbytes=True)


def _inflate(raw: pa.Scalar) -> bytes:
    return pa.CompressedInputStream(pa.BufferReader(raw.as_buffer()), _CODEC).read()


def _pack(codes: np.ndarray) -> bytes:
    """Numbers below 2^32, byte plane by byte plane, compressed."""
    planes = np.asarray(codes).astype("<u4").view(np.uint8).reshape(-1, 4).T
    return _squeeze(np.ascontiguousarray(planes).tobytes())


def _unpack(raw: pa.Scalar) -> np.ndarray:
    planes = np.frombuffer(_inflate(raw), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").reshape(-1)


def _ends_of(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def _binaries(lengths: np.ndarray, data: bytes) -> pa.Array:
    ends = _ends_of(lengths)
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _block_rows(shared, buckets: int):
    """Rows (block, bucket, own, sizes, words) of what the frequent words lack: their
    codes, their lengths and themselves, packed; and one row a block with the ids of
    its documents, their numbers of words, and its codes."""

    def run(batches):
        from pyspark import TaskContext

        frequent = pa.array(shared.value, pa.large_string())
        block = TaskContext.get().partitionId() << 32
        held, size = [], 0

        def flush():
            nonlocal block
            ids = pa.concat_arrays([h[0] for h in held])
            lists = pa.chunked_array([h[1] for h in held]).combine_chunks()
            words = lists.flatten().dictionary_encode()
            known = pc.index_in(words.dictionary, value_set=frequent).to_numpy(zero_copy_only=False)
            other = np.flatnonzero(np.isnan(known)) if known.dtype.kind == "f" else np.empty(0, np.int64)
            code = np.nan_to_num(known).astype(np.int64)
            code[other] = len(frequent) + np.arange(len(other))
            rest = words.dictionary.take(pa.array(other))
            bucket = np.fromiter((zlib.crc32(w) % buckets for w in rest.cast(pa.large_binary()).to_pylist()), np.int64, len(rest))
            order = np.argsort(bucket, kind="stable")
            held_in, first = np.unique(bucket[order], return_index=True)
            rest = rest.take(pa.array(order)).cast(pa.large_binary())
            rows: dict[str, list] = {"own": [], "sizes": [], "words": []}
            for start, stop in zip(first, [*first[1:], len(order)]):
                part = rest.slice(start, stop - start)
                rows["own"].append(_pack(code[other[order[start:stop]]]))
                rows["sizes"].append(_pack(pc.binary_length(part).to_numpy(zero_copy_only=False)))
                rows["words"].append(_squeeze(b"".join(part.to_pylist())))
            if len(order):
                yield _rows(block, len(held_in), bucket=pa.array(held_in, pa.int32()), **{k: pa.array(v, pa.binary()) for k, v in rows.items()})
            codes = code[words.indices.to_numpy(zero_copy_only=False)]
            counts = np.diff(lists.offsets.to_numpy())
            yield _rows(block, 1, doc_ids=pa.array([ids.to_pylist()], pa.list_(pa.int64())), counts=pa.array([_pack(counts)]), codes=pa.array([_pack(codes)]))
            block += 1
            held.clear()

        for batch in batches:
            sizes, start = batch.column(2).to_numpy(), 0
            while start < len(batch):
                total = np.cumsum(sizes[start:]) + size
                stop = start + max(int(np.searchsorted(total, BLOCK_BYTES, side="right")), 0 if held else 1)
                if stop > start:
                    held.append((batch.column(0).slice(start, stop - start), batch.column(1).slice(start, stop - start).cast(pa.large_list(pa.large_string()))))
                    size = int(total[stop - start - 1])
                if stop < len(batch) or size >= BLOCK_BYTES:
                    yield from flush()
                    size = 0
                start = stop
        if held:
            yield from flush()
        release_memory()

    return run


_BLOCK_DDL = "block long, bucket int, own binary, sizes binary, words binary, doc_ids array<long>, counts binary, codes binary"
_BLOCK_SCHEMA = pa.schema([
    ("block", pa.int64()), ("bucket", pa.int32()), ("own", pa.binary()), ("sizes", pa.binary()), ("words", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.binary()), ("codes", pa.binary()),
])


def _rows(block: int, n: int, **columns) -> pa.RecordBatch:
    columns["block"] = pa.array([block] * n, pa.int64())
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in _BLOCK_SCHEMA], schema=_BLOCK_SCHEMA)


def split_into_blocks(docs: DataFrame, tokenizer_path: str, frequent: list[str], doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(words, blocks) of ``docs``: (bucket, block, own, sizes, words), the distinct
    words of a block that ``frequent`` lacks and their codes, by hash bucket; and
    (block, doc_ids, counts, codes). Both are in one stored table bucketed by block. Null
    texts count as empty."""
    spark = prepare(docs.sparkSession)
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    split = docs.select(F.col(doc_id).cast("long").alias("doc_id"), words_of(whole, tokenizer_path).alias("words"), F.octet_length(whole).alias("n"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = split.mapInArrow(_block_rows(spark.sparkContext.broadcast(frequent), partitions), _BLOCK_DDL)
    name, path = f"bpe_blocks_{uuid.uuid4().hex}", new_path(spark, "bpe-blocks")
    rows.write.bucketBy(partitions, "block").option("path", path).option("compression", "zstd").saveAsTable(name)
    stored = spark.table(name)
    words = stored.where("bucket IS NOT NULL").select("bucket", "block", "own", "sizes", "words")
    blocks = stored.where("codes IS NOT NULL").select("block", "doc_ids", "counts", "codes")
    return words, blocks


def encode_words(words: DataFrame, tokenizer_path: str) -> DataFrame:
    """``words`` (bucket, block, own, sizes, words) as (block, own, lengths, ids): the
    numbers of ids and the ids of each word, packed. A word is in one bucket only;
    the rows of a bucket come together, and each of its distinct words is encoded
    once, by the library, however many blocks hold it."""

    def encoded(rows: list[pa.RecordBatch], tokenizer) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        sizes = [_unpack(x) for x in table["sizes"]]
        data = b"".join(_inflate(x) for x in table["words"])
        flat = _binaries(np.concatenate(sizes), data).dictionary_encode()
        found = tokenizer.encode_batch_fast([w.decode("utf-8") for w in flat.dictionary.to_pylist()], add_special_tokens=False)
        ids = pa.array([e.ids for e in found], pa.large_list(pa.int32())).take(flat.indices)
        at, ends = _ends_of([len(x) for x in sizes]), ids.offsets.to_numpy()
        lengths, values = np.diff(ends), ids.values.to_numpy()
        spans = list(zip(at[:-1], at[1:]))
        return pa.RecordBatch.from_arrays(
            [
                table["block"].combine_chunks(), table["own"].combine_chunks(),
                pa.array([_pack(lengths[a:b]) for a, b in spans], pa.binary()), pa.array([_pack(values[ends[a] : ends[b]]) for a, b in spans], pa.binary()),
            ],
            ["block", "own", "lengths", "ids"],
        )

    def run(batches):
        tokenizer = _load(tokenizer_path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        held: list[pa.RecordBatch] = []
        for batch in batches:
            buckets = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(buckets)) + 1).tolist(), len(batch)]
            for start, stop in zip(cuts[:-1], cuts[1:]):
                if held and stop > start and held[0]["bucket"][0].as_py() != buckets[start]:
                    yield encoded(held, tokenizer)
                    held = []
                if stop > start:
                    held.append(batch.slice(start, stop - start))
        if held:
            yield encoded(held, tokenizer)
        release_memory()

    return words.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "block long, own binary, lengths binary, ids binary")


def _word_ids(rows: pa.Table) -> pa.Array:
    """Lists of ids by code, from the rows of ``encode_words`` of one block."""
    own = np.concatenate([_unpack(x) for x in rows["own"]])
    ends = _ends_of(np.concatenate([_unpack(x) for x in rows["lengths"]]))
    ids = np.concatenate([_unpack(x) for x in rows["ids"]]).astype(np.int32)
    return pa.LargeListArray.from_arrays(ends, ids).take(pa.array(np.argsort(own)))


def _join_pieces(ids: pa.Array, pieces: pa.Array) -> pa.Array:
    """The bytes of every list of ids, ``pieces`` being the vocabulary's by id."""
    found = pieces.take(ids.flatten())
    ends = np.frombuffer(found.buffers()[1], np.int64)[found.offset :] if len(found) else np.zeros(1, np.int64)
    at = ids.offsets.to_numpy() - ids.offsets[0].as_py()
    return pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(np.ascontiguousarray(ends[at])), found.buffers()[2]])


def frequent_table(docs: DataFrame, tokenizer_path: str, entries: int, doc_id: str = "doc_id", text: str = "text") -> list[str]:
    """The frequent words: what stands between single spaces, with the space before
    it, by falling frequency (from bounded summaries of every task)."""
    pieces = frequent_pieces(docs.select(F.col(text).cast("string").alias("text")), "text", entries) if entries else {}
    return [f" {p.decode('utf-8')}" for p, _ in sorted(pieces.items(), key=lambda kv: (-kv[1], kv[0]))]


def vocabulary_pieces(spark: SparkSession, tokenizer_path: str) -> DataFrame:
    """(id, piece): the bytes of every id, special ones included; as many rows as
    the vocabulary has."""
    letters = {ord(c): b for b, c in _byte_letters().items()}
    rows = []
    for token, i in _load(tokenizer_path).get_vocab(with_added_tokens=True).items():
        known = all(ord(c) in letters for c in token)
        rows.append((i, bytearray(letters[ord(c)] for c in token) if known else bytearray(token.encode("utf-8"))))
    return spark.createDataFrame(rows, "id int, piece binary")


def decode_ids(sequences: DataFrame, tokenizer_path: str, keys: list[str], ids: str = "ids") -> DataFrame:
    """``keys``, ``ids`` and ``raw`` per row of ``sequences``: the bytes that the ids
    stand for, through a join of every id with the vocabulary's pieces. Ids that the
    vocabulary lacks give nothing; null and empty sequences give no bytes. Keys must
    be distinct. Rows that are dealt by one of the keys are not moved again."""
    pieces = F.broadcast(vocabulary_pieces(sequences.sparkSession, tokenizer_path))  # bounded by the vocabulary
    exploded = sequences.select(*keys, F.posexplode_outer(ids).alias("position", "id"))
    joined = exploded.join(pieces, "id", "left").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("position", "id", F.hex("piece").alias("hex")))).alias("found"))
    held = F.filter("found", lambda x: x["id"].isNotNull())
    return joined.select(*keys, F.transform(held, lambda x: x["id"]).alias(ids), F.unhex(F.array_join(held["hex"], "")).alias("raw"))


def _packed(words: list[str], step: int = 4096) -> list[tuple]:
    """Rows (bucket, block, own, sizes, words) of a list of words, as of one block."""
    rows = []
    for i in range(0, len(words), step):
        raw = [w.encode("utf-8") for w in words[i : i + step]]
        rows.append((i // step, 0, _pack(np.arange(i, i + len(raw))), _pack([len(w) for w in raw]), _squeeze(b"".join(raw))))
    return rows


def _lay_out(docs: DataFrame, tokenizer_path: str, doc_id: str, text: str, frequent_words: int, finish, ddl: str) -> DataFrame:
    """``finish(block row, codes, ids by code, raw by code)`` of every block."""
    spark = prepare(docs.sparkSession)
    frequent = frequent_table(docs, tokenizer_path, frequent_words, doc_id, text)
    words, blocks = split_into_blocks(docs, tokenizer_path, frequent, doc_id, text)
    # as many rows as there are frequent words, and as the vocabulary has ids
    known = encode_words(spark.createDataFrame(_packed(frequent), "bucket int, block long, own binary, sizes binary, words binary"), tokenizer_path).toArrow()
    ids = _word_ids(known) if len(known) else pa.array([], pa.large_list(pa.int32()))
    table = vocabulary_pieces(spark, tokenizer_path).toArrow().sort_by("id")
    pieces = np.full(table["id"][-1].as_py() + 1, -1)
    pieces[table["id"].to_numpy()] = np.arange(len(table))
    pieces = pc.fill_null(table["piece"].combine_chunks().cast(pa.large_binary()).take(pa.array(pieces, mask=pieces < 0)), b"")
    shared = spark.sparkContext.broadcast((ids, _join_pieces(ids, pieces), pieces))
    others = encode_words(words, tokenizer_path)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, raw, pieces = shared.value
        if len(right):
            own = _word_ids(right)
            ids, raw = pa.concat_arrays([ids, own]), pa.concat_arrays([raw, _join_pieces(own, pieces)])
        row = left.to_batches()[0]
        out = finish(row, _unpack(row["codes"][0]), ids, raw)
        release_memory()
        return pa.Table.from_batches([out])

    return blocks.groupBy("block").cogroup(others.groupBy("block")).applyInArrow(run, ddl)


def _ends(row: pa.RecordBatch) -> np.ndarray:
    return _ends_of(_unpack(row["counts"][0]))


def _laid(values: pa.Array, codes: np.ndarray, at: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(values by position, offsets of the documents in their flat content)."""
    laid = values.take(pa.array(codes))
    return laid, np.frombuffer(laid.buffers()[1], np.int64)[laid.offset :][at] if len(laid) else np.zeros(len(at), np.int64)


def _id_lists(row: pa.RecordBatch, codes: np.ndarray, ids: pa.Array, raw: pa.Array) -> pa.RecordBatch:
    laid, ends = _laid(ids, codes, _ends(row))
    lists = pa.LargeListArray.from_arrays(ends - ends[0], laid.flatten())
    text, at = _laid(raw, codes, _ends(row))
    data = memoryview(text.buffers()[2] or b"")
    decoded = [str(data[a:b], "utf-8", "replace") for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
    return pa.RecordBatch.from_arrays([row["doc_ids"].flatten(), lists.cast(pa.list_(pa.int32())), pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])


def _digests(row: pa.RecordBatch, codes: np.ndarray, ids: pa.Array, raw: pa.Array) -> pa.RecordBatch:
    at = _ends(row)
    # each word's ids in decimal, every id followed by a comma
    comma, nothing = (pa.scalar(c, pa.large_string()) for c in (",", ""))
    decimals = pc.binary_join(ids.cast(pa.large_list(pa.large_string())), comma)
    decimals = pc.if_else(pc.not_equal(decimals, nothing), pc.binary_join_element_wise(decimals, nothing, comma), decimals)
    sha = lambda data: hashlib.sha256(data).hexdigest()
    columns = []
    for values, tail in ((decimals, 1), (raw, 0)):
        laid, ends = _laid(values, codes, at)
        data = memoryview(laid.buffers()[2] or b"")
        spans = zip(ends[:-1].tolist(), ends[1:].tolist())
        if tail:
            columns.append([sha(data[a : max(b - 1, a)]) for a, b in spans])
        else:
            columns.append([sha(str(data[a:b], "utf-8", "replace").encode("utf-8")) for a, b in spans])
    lengths = pc.list_value_length(ids).to_numpy(zero_copy_only=False)
    total = np.concatenate([[0], np.cumsum(lengths[codes])])
    return pa.RecordBatch.from_arrays(
        [row["doc_ids"].flatten(), pa.array(total[at[1:]] - total[at[:-1]], pa.int64()), *(pa.array(c, pa.string()) for c in columns)],
        ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    )


def codec_digests(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", frequent_words: int = FREQUENT_WORDS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids_sha256 (of the decimal ids joined by
    commas) and decoded_sha256 (of the text that the ids decode to, in UTF-8, bytes
    that form no character replaced).

    Null and empty texts: no ids, digests of the empty string. Null and repeated ids
    give one row each. Special strings within texts become their ids, as the library
    does by default. Only the two named columns are read, so others may have any
    name. An empty table gives an empty result. A text of any length is encoded
    whole; a text longer than a block is a block of its own."""
    return _lay_out(docs, tokenizer_path, doc_id, text, frequent_words, _digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_documents(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", frequent_words: int = FREQUENT_WORDS) -> DataFrame:
    """(doc_id, ids, decoded) per row of ``docs``, in the same way and with the same
    results in the same odd cases as ``codec_digests``."""
    return _lay_out(docs, tokenizer_path, doc_id, text, frequent_words, _id_lists, "doc_id long, ids array<int>, decoded string")
