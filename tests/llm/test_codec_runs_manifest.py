"""Distinct-word BPE codec, periodic runs and Merkle manifest against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from strata.llm import bpe_codec, merkle_manifest, periodic_runs
from strata.llm.bpe_codec import codec_digests, decode_ids, encode_documents
from strata.llm.common import prepare, table
from strata.llm.merkle_manifest import document_manifest
from strata.llm.periodic_runs import OrderedPositions, made_periodic, run_digests
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.test_tokens import BYTE, _texts

LIBRARY = Tokenizer.from_file(BYTE)


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- codec ---------------------------------------------------------------

ODD = [
    "  a   b    c  \n  d   e ", "a " * 5000, " ", " x", "a\nb", "a\n\nb", "a.\nB", "1\n2\n\n 3", "it's 's !'s x'tis", "a,b;c1d2 e", "x\r\ny", "é\nÉ,ß",
    "a <|endoftext|>b<|endoftext|>", "<|endoftext", "q" * 3000, "日本 語\n한글 a",
]


def _coded(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


@pytest.fixture(scope="module")
def odd(spark):
    prepare(spark)
    rows = [(i if i % 7 else None, t) for i, t in enumerate(_texts(1500) + ODD)] + [(3, None), (3, ""), (3, "same"), (3, "same")]
    return rows, spark.createDataFrame([(i, t, "c", "d") for i, t in rows], "doc_id long, text string, ids string, block string").repartition(5)


@pytest.mark.parametrize("block,frequent", [(bpe_codec.BLOCK_BYTES, 1000), (500, 3), (2000, 0)])
def test_codec_equals_the_library(odd, monkeypatch, block, frequent):
    rows, docs = odd
    monkeypatch.setattr(bpe_codec, "BLOCK_BYTES", block)
    want = [(i, *_coded(t)) for i, t in rows]
    got = codec_digests(docs, BYTE, frequent_words=frequent)
    assert _rows(got) == sorted(((i, len(ids), _sha(",".join(map(str, ids))), _sha(text)) for i, ids, text in want), key=str)
    if block == 500:
        assert sorted(((r[0], r[1], r[2]) for r in encode_documents(docs, BYTE, frequent_words=frequent).collect()), key=str) == sorted(want, key=str)


def test_codec_of_an_empty_table(odd):
    assert codec_digests(odd[1].limit(0), BYTE).collect() == []


def test_decode_joins_pieces(spark):
    prepare(spark)
    rows = [(1, LIBRARY.encode("é日本 a", add_special_tokens=False).ids), (2, []), (3, None), (4, [50256, 64, 64]), (5, [10**6, 64])]
    got = {r["k"]: (r["ids"], bytes(r["raw"]).decode()) for r in decode_ids(spark.createDataFrame(rows, "k int, ids array<int>"), BYTE, ["k"]).collect()}
    assert {k: t for k, (_, t) in got.items()} == {1: "é日本 a", 2: "", 3: "", 4: "<|endoftext|>aa", 5: "a"}
    assert got[1][0] == rows[0][1]


# --- runs ----------------------------------------------------------------


def _brute_runs(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            length = i + q - s
            if length >= max(6, 4 * q) and not any(all(w[x] == w[x + r] for x in range(s, s + length - r)) for r in range(1, q)):
                out.append((s, length, q))
    return sorted(out)


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for _ in range(600):
        docs = []
        for _ in range(rng.randint(0, 4)):
            w = [rng.choice("ab" if rng.random() < 0.5 else "abc") for _ in range(rng.randint(0, 25))]
            if w and rng.random() < 0.6:
                a, p = rng.randrange(len(w)), rng.randint(1, 5)
                w = w[:a] + [w[min(a + i % p, len(w) - 1)] for i in range(rng.randint(0, 40))]
            docs.append(w)
        at = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype(np.int64)
        runs, kept = periodic_runs._documents(pa.array([x for d in docs for x in d], pa.large_string()), at)
        assert runs == [_brute_runs(d) for d in docs]
        for d, own, begin in zip(docs, runs, at):
            drop = {k for s, length, q in own for k in range(s + q, s + length)}
            assert [k for k in range(len(d)) if not kept[begin + k]] == sorted(drop)


@pytest.mark.parametrize("word,period", [(lambda i: "a", 1), (lambda i: str(i % 997), 997)])
def test_runs_of_a_very_long_text(word, period):
    w = [word(i) for i in range(100_000)]
    runs, kept = periodic_runs._documents(pa.array(w, pa.large_string()), np.array([0, len(w)]))
    assert runs == [[(0, len(w), period)]] and kept.sum() == period


def test_ordered_positions():
    rng = random.Random(2)
    order = rng.sample(range(10_000), 5000)
    held, plain = OrderedPositions(order[0]), [order[0]]
    for x in order[1:]:
        want = (max((p for p in plain if p < x), default=-1), min((p for p in plain if p > x), default=-1)) if x % 50 == 0 else None
        got = held.insert(x)
        assert want is None or got == want
        plain.append(x)
    assert list(held) == sorted(plain)


def _digested(doc_id, text):
    w = list(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
    runs = _brute_runs(w)
    drop = {k for s, n, q in runs for k in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    named = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *named, _sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), _sha(" ".join(x for k, x in enumerate(w) if k not in drop)))


def test_run_query_equals_brute_force(spark):
    prepare(spark)
    texts = [None, "", " \t\x0b", "a" * 50, "a b " * 9 + "c", "x x x x x x y y y y y", "\x1ca a\x85a a a a a", "la " * 40, "é É é É é É é É"]
    rows = [(i if i % 5 else None, t) for i, t in enumerate(texts * 6)]
    rows += [tuple(r) for r in table(spark, SF_SMALL, "documents").where("length(text) < 1500").select("doc_id", "text").collect()]
    docs = spark.createDataFrame([(i, t, 1, "z") for i, t in rows], "doc_id long, text string, start int, h string")
    assert _rows(run_digests(docs)) == sorted((_digested(*r) for r in rows), key=str)
    assert run_digests(docs.limit(0)).collect() == []
    found = periodic_runs.periodic_runs(made_periodic(docs)).where("n_runs > 0").first()
    assert found["runs"][0].asDict().keys() == {"start", "length", "period"} and isinstance(found["collapsed"], str)


# --- manifest ------------------------------------------------------------


def _tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([_sha("".join(levels[-1][i : i + 8])) for i in range(0, len(levels[-1]), 8)])
    return levels


def _siblings(levels, i):
    for level in levels[:-1]:
        first = i // 8 * 8
        yield level[first:i], level[i + 1 : first + 8]
        i //= 8


def _manifest(rows):
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, t: _sha("".join(map(part, (r["doc_id"], r["source"], r["lang"], r["n_chars"], t))))
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for x in langs:
        groups[x].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
    trees = [_tree([leaf(r, r["text"]) for r in groups[x]]) for x in langs]
    top = _tree([t[-1][0] for t in trees]) if trees else []
    out = []
    for k, x in enumerate(langs):
        for i, r in enumerate(groups[x]):
            path = [*_siblings(trees[k], i), *_siblings(top, k)]
            text = r["text"]
            if text is not None and zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 3 == 0:
                text = text.translate({c: c + 32 for c in range(65, 91)})
            h = leaf(r, text)
            for a, b in path:
                h = _sha("".join([*a, h, *b]))
            root = top[-1][0]
            out.append((r["doc_id"], trees[k][0][i], trees[k][-1][0], root, _sha("".join(d for a, b in path for d in a + b)), h, h == root))
    return sorted(out, key=str)


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


@pytest.mark.parametrize("n,langs", [(0, "a"), (1, "a"), (9, "a"), (40, "abcdefghijklmnopqrst"), (70, ["a", None, ""]), (1300, "a"), (600, ["en", "fr", None])])
def test_manifest_equals_brute_force(spark, monkeypatch, n, langs):
    prepare(spark)
    monkeypatch.setattr(merkle_manifest, "PART_LEVEL", 2)  # several parts, with few rows
    rng = random.Random(n)
    rows = [
        dict(zip(COLUMNS, (rng.choice([None, rng.randrange(50), i]), rng.choice([None, "", "AbC É", "x" * 20, str(i)]), rng.choice(langs), rng.choice([None, "a"]), rng.choice([None, 3]))))
        for i in range(n)
    ]
    docs = spark.createDataFrame([(*(r[c] for c in COLUMNS), "x", "y") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, leaf string, idx string")
    got = document_manifest(docs).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert _rows(got) == _manifest(rows)


def test_manifest_of_the_documents(spark):
    docs = table(prepare(spark), SF_ORACLE, "documents")
    got = document_manifest(docs).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert _rows(got) == _manifest([r.asDict() for r in docs.collect()])
    assert spark.conf.get("spark.sql.cteRecursionRowLimit", None) in (None, "1000000")
