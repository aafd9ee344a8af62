"""Joins, searches and components against brute force."""

import math
import random
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.llm import embedding_dedup, jaccard_join
from strata.llm.common import connected_components, prepare, store
from strata.llm.embedding_dedup import embedding_classes, visited_cells
from strata.llm.groups import bucket_links
from strata.llm.jaccard_join import _similar, jaccard_classes, keep_one_of_each, runs_needed
from strata.llm.topk import ImpactIndex, top_k


def _components(nodes, links):
    out = {}
    for n in sorted(nodes, key=lambda x: (x is None, x)):
        if n in out:
            continue
        stack, out[n] = [n], n
        while stack:
            for m in links.get(stack.pop(), ()):
                if m not in out:
                    out[m] = n
                    stack.append(m)
    return out


def test_connected_components(spark):
    prepare(spark)
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(220)] + [(1000, k) for k in range(1001, 1300)] + [(k, k + 1) for k in range(2000, 2100)] + [(5, 5)]
    links = {}
    for a, b in edges:
        if a != b:
            links.setdefault(a, set()).add(b)
            links.setdefault(b, set()).add(a)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == _components(links, links)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("block", [4, 100])
def test_bucket_links_are_counted_once_in_any_blocks(spark, block):
    prepare(spark)
    values = [(n % 3, n, n % 2 + 1, bytes([n % 5])) for n in range(60)]

    def verify(a, b):
        return np.array([[x == y for y in (a if b is None else b)] for x in a])

    rows = bucket_links(spark.createDataFrame(values, "bucket long, node long, weight long, payload binary"), verify, block).collect()
    got = {}
    for r in rows:
        got[r["node"]] = got.get(r["node"], 0) + r["links"]
    want = {n: sum(w2 for b2, m, w2, p2 in values if b2 == b and m != n and p2 == p) for b, n, w, p in values}
    assert got == {n: v for n, v in want.items() if v}


def _corpus():
    rng = random.Random(9)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for _ in range(30):
        base = [rng.choice(words) for _ in range(rng.randint(8, 120))]
        for _ in range(rng.choice([1, 1, 2, 5])):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            docs.append(" ".join(copy))
    docs += [docs[0]] * 4 + ["", None, "   ", "one two", "one two", "one  two\n", "one three", None]
    near = [rng.choice(words) for _ in range(100)]
    for k in range(40):  # a group that is alike all round
        docs.append(" ".join([*near, f"end{k}"]))
    rng.shuffle(docs)
    return docs


def _sets(text):
    w = (text or "").split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def test_jaccard_classes_equal_brute_force(spark):
    prepare(spark)
    texts = dict(enumerate(_corpus(), 100))
    sets = {i: _sets(t) for i, t in texts.items()}
    links = {i: {j for j in sets if j != i and sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])} for i in sets}
    component = _components(sets, links)
    df = spark.createDataFrame([(i, t, "c") for i, t in texts.items()], "doc_id long, text string, class_id string").repartition(5)
    got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_classes(df).collect()}
    assert got == {i: (component[i], len(links[i])) for i in sets}
    kept = keep_one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(component.values()))


def test_jaccard_edge_cases(spark):
    prepare(spark)
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, "x y"), (None, "x y"), (2, None), (3, "very long " * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in jaccard_classes(df).collect()), key=str)
    assert got == sorted([(1, 1, 2), (1, 1, 2), (None, 1, 2), (None, None, 1), (None, None, 1), (2, 2, 0), (3, 3, 0)], key=str)
    assert sorted((tuple(r)[0] for r in keep_one_of_each(df).collect()), key=str) == [1, 2, 3, None]
    assert jaccard_classes(df.limit(0)).count() == 0 and keep_one_of_each(df.limit(0)).count() == 0


def test_runs_reach_the_recall():
    assert runs_needed(0.8, 0.9999) > runs_needed(0.8, 0.9) >= 1


def test_pairs_at_the_threshold_meet_after_all_splits(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(jaccard_join, "LEAF", 1)  # every shared node is split to the last level
    rng, pairs, width = np.random.default_rng(17), 20_000, 128
    a = rng.integers(-(1 << 31), 1 << 31, (pairs, width))
    b = np.where(rng.random(a.shape) < 0.8, a, rng.integers(-(1 << 31), 1 << 31, a.shape))
    nodes = pa.table({"node": np.arange(2 * pairs), "path": pa.array(list(np.stack([a, b], 1).reshape(-1, width)))})
    small, big = jaccard_join._leaves(store(spark.createDataFrame(nodes), "classes"), 0.8)
    assert small.count() == 0
    met = big.select((F.col("node") / 2).cast("long").alias("pair")).distinct().count()
    assert met >= 0.9997 * pairs, met


def test_exact_comparison_in_both_ways():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, rng.integers(30, 60))).astype(np.uint64) for _ in range(30)]
    raw = [s.tobytes() for s in sets]
    want = np.array([[5 * len(np.intersect1d(a, b)) >= 4 * len(np.union1d(a, b)) for b in sets] for a in sets])
    assert (_similar(Fraction(4, 5))(raw, None) == want).all()
    assert (_similar(Fraction(4, 5))(raw[:3], raw[3:5]) == want[:3, 3:5]).all()
    assert (_similar(Fraction(4, 5))(raw[:9], raw[9:]) == want[:9, 9:]).all()


def _vectors():
    rng = np.random.default_rng(8)
    base = rng.normal(size=(120, 16))
    near = np.concatenate([base[:20] + rng.normal(size=(20, 16)) * s for s in (0.02, 0.08, 0.12)])
    hot = base[50] + rng.normal(size=(150, 16)) * 0.01
    rows = [[float(np.float32(x)) for x in v] for v in np.concatenate([base, near, hot])]
    odd = [None, [0.0] * 16, [1.0, None, *[0.0] * 14], [float("nan")] * 16, [float("inf"), *[1.0] * 15], [], [2.0, 1.0], [4.0, 2.0], rows[0], [x * 1e30 for x in rows[0]]]
    return list(enumerate(rows + odd, 7))


def test_embedding_classes_equal_brute_force(spark):
    prepare(spark)
    data = _vectors()
    df = spark.createDataFrame([(i, v, 1) for i, v in data], "vec_id long, embedding array<double>, n_links int").repartition(4)
    good = {i: np.array(v) for i, v in data if v and None not in v and np.isfinite(v).all() and any(v)}

    def cosine(a, b):
        a, b = a / np.abs(a).max(), b / np.abs(b).max()
        return a @ b / np.sqrt((a @ a) * (b @ b))

    links = {i: {j for j, w in good.items() if j != i and len(w) == len(v) and cosine(v, w) >= 0.95} for i, v in good.items()}
    component = _components([i for i, _ in data], links)
    rows = embedding_classes(df).collect()
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rows}
    assert len(rows) == len(data)
    total, found = sum(map(len, links.values())), sum(n for n, _ in got.values())
    assert found <= total and found >= 0.9 * total  # recall against brute force
    assert all(n <= len(links.get(i, ())) for i, (n, _) in got.items())
    assert found < total or got == {i: (len(links.get(i, ())), component[i]) for i, _ in data}


def test_isolated_pairs_near_the_threshold_are_found(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(embedding_dedup, "CELL_ROWS", 1)  # many cells for few rows
    rng = np.random.default_rng(21)
    a, b = rng.normal(size=(2, 1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(1, keepdims=True) * a
    b = 0.951 * a + math.sqrt(1 - 0.951**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    df = spark.createDataFrame(list(enumerate(np.concatenate([a, b]).tolist())), "vec_id long, embedding array<double>").repartition(4)
    found = embedding_classes(df).where("vec_id >= 1500 and component_id = vec_id - 1500").count()
    assert found >= 0.998 * 1500


def test_embedding_edge_tables(spark):
    prepare(spark)
    schema = "vec_id long, embedding array<float>"
    assert embedding_classes(spark.createDataFrame([], schema)).count() == 0
    rows = spark.createDataFrame([(None, [1.0, 0.0]), (4, [1.0, 0.0]), (4, [1.0, 0.0]), (9, None)], schema)
    got = sorted((tuple(r) for r in embedding_classes(rows).collect()), key=str)
    assert got == sorted([(None, 2, 4), (4, 2, 4), (4, 2, 4), (9, 0, 9)], key=str)


def test_multi_sequence_visits_in_order_of_the_bound():
    rng = np.random.default_rng(1)
    books = (rng.normal(size=(9, 4)), rng.normal(size=(7, 4)))
    gaps = tuple(np.sqrt(((b[:, None] - b[None]) ** 2).sum(2)) for b in books)
    x = (rng.normal(size=4), rng.normal(size=4))
    every = visited_cells(x, books, gaps, np.inf)
    assert sorted(every) == list(range(63))
    d = [((b - v) ** 2).sum(1) for v, b in zip(x, books)]
    assert every[0] == int(d[0].argmin()) * 7 + int(d[1].argmin())
    some = visited_cells(x, books, gaps, 0.5)
    assert every[: len(some)] == some


def _exact(rows, k, every):
    x = {i: np.floor(1024 * np.array(v, np.float64)).astype(int) for i, v in rows}
    out = set()
    for q in x:
        if q % every == 0:
            best = sorted((-int(x[q] @ x[i]), i) for i in x if i != q and len(x[i]) == len(x[q]))[:k]
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    return out


@pytest.mark.parametrize("n", [4, 700])
def test_top_k_equals_brute_force(spark, n):
    prepare(spark)
    rng = np.random.default_rng(n)
    rows = [(int(i), [float(np.float32(v)) for v in rng.normal(size=12) * 0.3]) for i in rng.permutation(n)]
    rows += [(n + 1, rows[0][1]), (n + 2, rows[0][1])]  # ties
    odd = [(n + 3, None), (n + 4, [float("nan")] * 12), (n + 5, [1.0, None]), (None, rows[1][1])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows + odd], "vec_id long, embedding array<float>, score int").repartition(3)
    got = {tuple(r) for r in top_k(df, 10, 50).collect()}
    assert got == _exact(rows, 10, 50)
    assert top_k(df.limit(0)).count() == 0


def test_index_stops_only_on_proof():
    rng = np.random.default_rng(6)
    x = rng.integers(-400, 400, (3000, 8))
    x[:20] = x[0] + rng.integers(-3, 3, (20, 8))  # a few clear winners
    index, ids = ImpactIndex(x), np.arange(len(x))
    for q in (x[0], x[100], np.zeros(8, int)):
        (rows, scores), = index.search(q[None], np.array([-1]), 10, ids)
        want = np.lexsort((ids, -(x @ q)))[:10]
        assert rows.tolist() == want.tolist() and scores.tolist() == (x @ q)[want].tolist()
