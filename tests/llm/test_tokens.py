"""Encoders, token counts, token files and packing against the tokenizers library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from strata.llm import packing, token_output
from strata.llm.common import new_path, prepare
from strata.llm.packing import LevelArray, Piece, pack_sequences, pour
from strata.llm.token_counts import token_counts
from strata.llm.token_output import Segment, encode_to_files, pack_ids, read_token_ids, unpack_ids, write_segment, write_token_ids
from strata.llm.tokenization import SpaceCounter, WordEncoder, _Cache, slices

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    "'s", "'RE", "don't", " ", "  ", "\n", "\n\n", "\t", " ", " ", "\x1c", "\x85", "a", "Éé", "ß", "İ", "ſ", "ﬁ", "Σ", "12", "²", "½", "_", "__",
    "-", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "é", "日本", "한글", "😀", "ª", "×", "–", "’s", "…", "\x00", "\x7f", "\r\n", "x'll", "​", " a ",
]
DOCS = [(3, "Of in anedly reed.", "x"), (1, None, "x"), (2, "", "x"), (None, "a null id", None), (3, "Of in anedly reed.", "x"), (7, "long " * 3000, "y"), (5, "two  spaces\n<|endoftext|> é", "z")]


def _texts(n=3000):
    rng = random.Random(5)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 9))) for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return spark.createDataFrame(DOCS, "doc_id long, text string, ids string")


def _ids(text):
    return Tokenizer.from_file(WORD).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("entries", [50, 100_000])
def test_word_ids_equal_the_library(entries):
    texts, encoder, out = _texts(), WordEncoder(WORD, entries), []
    for ids, at in encoder.encode(pa.array([*texts, None])):
        out += [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
    assert out == [e.ids for e in Tokenizer.from_file(WORD).encode_batch(texts, add_special_tokens=False)] + [[]]


def test_words_of_simple_bytes_are_split_within_their_text():
    rng = random.Random(6)
    texts = ["".join(rng.choice("aBz019_-.,(<'s \t\n\x0b\x1f\x7fé") for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    out = []
    for run in (pa.array(texts[:1], pa.string()), pa.array(["x", *texts])[2:]):  # a sliced array too
        for ids, at in WordEncoder(WORD).encode(run):
            out += [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
    assert out == [e.ids for e in Tokenizer.from_file(WORD).encode_batch(texts, add_special_tokens=False)]
    assert sum(map(len, slices(pa.array(["ab", None, "", "cdefg"]), 3))) == 4


def test_an_encoder_holds_two_generations_and_no_more():
    encoder = WordEncoder(WORD, 1000)
    for n in range(0, 20_000, 100):  # 100 new words a slice, one in three with a sign
        words = ["".join(chr(97 + int(d)) for d in str(i)) + "," * (i % 3 == 0) for i in range(10_000 + n, 10_100 + n)]
        list(encoder.encode(pa.array([" ".join(words)])))
    held = sum(len(c.young) + len(c.old) for c in vars(encoder).values() if isinstance(c, _Cache))
    assert held <= 2 * (1000 + 101)


@pytest.mark.parametrize("entries", [50, 100_000])
def test_byte_counts_equal_the_library(entries):
    texts = _texts()
    counter = SpaceCounter(BYTE, {b"a": 1}, entries)
    out = np.concatenate(list(counter.count(pa.array([*texts, None])))).tolist()
    assert out == [len(e.ids) for e in Tokenizer.from_file(BYTE).encode_batch(texts, add_special_tokens=False)] + [0]


def test_token_counts(spark, docs):
    library = Tokenizer.from_file(BYTE)
    got = sorted(map(tuple, token_counts(docs, BYTE).collect()), key=str)
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in DOCS]
    assert got == sorted(want, key=str)
    assert token_counts(docs.limit(0), BYTE).count() == 0


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 31, 32])
@pytest.mark.parametrize("n", [0, 1, 1023, 1024, 1025, 5000])
def test_bit_packing_round_trip(bits, n):
    ids = np.random.default_rng(n).integers(0, 1 << bits, n, dtype=np.uint64)
    words = pack_ids(ids, bits)
    assert len(words) == -(-n // token_output.BLOCK) * token_output.BLOCK * bits // 64
    assert (unpack_ids(words, bits)[:n] == ids).all()


def test_segment_gives_random_access():
    lengths = [0, 3, 2000, 1, 1500]
    ids = np.random.default_rng(1).integers(0, 49408, sum(lengths), dtype=np.uint64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    s = Segment(write_segment(4, 2, [None, 5, 6, 7, 8], starts, ids, 16) + b"\x00")
    assert (s.task, s.part, s.n_ids) == (4, 2, sum(lengths)) and s.known.tolist() == [False, True, True, True, True]
    for i, (a, b) in enumerate(zip(starts, starts[1:])):
        assert s.document(i).tolist() == ids[a:b].tolist()


def test_files_hold_ids_in_order(spark, docs):
    got = {(r["doc_id"], r["start"]): (r["n_tokens"], r["ids_crc32"]) for r in encode_to_files(docs, WORD, 2).collect()}
    want, start = {}, 0
    for i, t, _ in sorted(DOCS, key=lambda d: (d[0] is not None, d[0] or 0, d[1] or "")):
        ids = np.array([*_ids(t), 2], "<u4")
        want[(i, start)] = (len(ids), zlib.crc32(ids))
        start += len(ids)
    assert got == want


def test_files_of_an_empty_table_and_ids_read_back(spark, docs):
    assert encode_to_files(docs.limit(0), WORD, 2).count() == 0
    path = new_path(spark, "t")
    write_token_ids(docs.where("doc_id = 5"), path, WORD, 2)
    (row,) = read_token_ids(spark, path).collect()
    assert row["ids"] == [*_ids(DOCS[6][1]), 2]


def test_best_level_minimises_the_sum_of_squares():
    rng, levels = np.random.default_rng(3), LevelArray(32, 10_000)
    for size in rng.integers(1, 32, 400):
        before, costs = levels.counts.copy(), {}
        for h in range(0, 32 - size + 1):
            if h and not before[h]:
                continue
            n = before.copy()
            n[h] -= h > 0
            n[h + size] += h + size < 32
            costs[h] = int((n[1:32] ** 2).sum())
        assert costs[levels.best_level(int(size))] == min(costs.values())
        levels.add([Piece(0, 0, 0, np.zeros(size, "<u2"), int(size))])
        assert levels.counts[32] == 0 and levels.held == levels.counts.sum()


def test_open_windows_are_bounded_and_nothing_is_lost():
    levels, done = LevelArray(64, 8), []
    for i in range(500):
        done += levels.add([Piece(i, i, 0, np.full(40, i, "<u2"), 40)])
        assert levels.held <= 8
    assert all(sum(len(p.ids) for p in w) == 64 for w in done)
    tail = pour(levels.rest(), 64)
    sizes = [sum(len(p.ids) for p in w) for w in tail]
    assert all(s == 64 or s & (s - 1) == 0 for s in sizes)
    assert sum(map(len, (p.ids for w in done + tail for p in w))) == 500 * 40


def _check_packing(rows, texts, end):
    sequences, documents = {}, {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"], r["sequence_tokens"]))
        documents.setdefault((r["doc_id"], r["row_key"]), []).append(r)
    for pieces in sequences.values():
        at = 0
        for offset, length, total in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at == total and (at == packing.WINDOW or at & (at - 1) == 0)
    found = []
    for (doc_id, _), pieces in documents.items():
        pieces.sort(key=lambda r: r["start"])
        ids = np.concatenate([np.frombuffer(r["ids"], "<u2") for r in pieces])
        assert [r["start"] for r in pieces] == [0, *np.cumsum([r["length"] for r in pieces])[:-1]] and len(ids) == pieces[0]["doc_tokens"]
        assert all(zlib.crc32(np.frombuffer(r["ids"], "<u2").astype("<u4")) == r["ids_crc32"] for r in pieces)
        found.append((doc_id, ids.tolist()))
    assert sorted(found, key=str) == sorted(((i, [*_ids(t), end]) for i, t in texts), key=str)


def test_packing_holds_every_id_once(spark, docs):
    _check_packing(pack_sequences(docs.repartition(3), WORD, 1).collect(), [(i, t) for i, t, _ in DOCS], 1)
    assert pack_sequences(docs.limit(0), WORD, 1).count() == 0


def test_packing_merges_many_tasks(spark):
    prepare(spark)
    rows = [(i, "word " * (i % 37 + 1)) for i in range(600)]
    many = spark.createDataFrame(rows, "doc_id long, text string").repartition(70)
    _check_packing(pack_sequences(many, WORD, 1).collect(), rows, 1)


def test_packing_merges_as_a_stream(spark, monkeypatch):
    prepare(spark)
    (word,) = _ids("word")
    plans, store = [], packing.store
    monkeypatch.setattr(packing, "store", lambda df, label: plans.append(df._jdf.queryExecution().toString()) or store(df, label))
    monkeypatch.setitem(globals(), "_ids", lambda text: [word] * len(text.split()))
    rows = [(i, "word " * (1400 + i % 90)) for i in range(1200)]  # open windows of 3.5 MB in all
    found = pack_sequences(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), WORD, 1).collect()
    _check_packing(found, rows, 1)
    assert len(plans) == 2 and "MapInArrow" in plans[1] and not any("Pandas" in p for p in plans)
