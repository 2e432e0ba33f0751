"""The inverted multi-index: exact parts, recall against brute force, edge cases."""

import math
import os

import numpy as np
import pytest

from lexloom.llm import annsearch


def brute(rows, every, k):
    good = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)})
    out = []
    for i, v in good:
        if i % every == 0:
            near = sorted(((-float((np.array(v) * np.array(w)).sum()), j) for j, w in good if j != i and len(w) == len(v)))[:k]
            out += [(i, r + 1, j, round(-s, 9)) for r, (s, j) in enumerate(near)]
    return sorted(out)


def test_whole_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(annsearch, "TILE", 50)
    monkeypatch.setattr(annsearch, "QUERIES", 7)
    monkeypatch.setattr(annsearch, "RECALL", 1.0)
    monkeypatch.setattr(annsearch.MultiIndex, "share", lambda *_: 1.0)
    rng = np.random.default_rng(1)
    rows = [(int(k), rng.integers(-3, 4, 6).astype(float).tolist()) for k in rng.permutation(900)[:400]]
    rows += [(1000 + k, [9.0] + [1.0] * 5) for k in range(60)] + [rows[0]]
    rows += [(2000, None), (2005, [0.0] * 6), (2010, [float("nan")] * 6), (2015, [None, 1.0]), (2020, []), (2025, [1.0, 2.0]), (2026, [3.0, 4.0]), (None, [1.0] * 6), (2030, [5.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, score string, rank int").repartition(4)
    got = annsearch.nearest(df, every=5, k=4).collect()
    assert sorted((r["query_id"], r["rank"], r["id"], round(r["score"], 9)) for r in got) == brute(rows, 5, 4)


def test_traversal_is_in_order():
    rng = np.random.default_rng(2)
    index = annsearch.MultiIndex(rng.normal(size=(9, 3)), rng.normal(size=(7, 5)), rng.integers(0, 5, 63).tolist())
    q = rng.normal(size=8)
    sums = ((index.first @ q[:3])[:, None] + index.second @ q[3:]).ravel()
    assert index.traverse(q, 10**9)[0].tolist() == np.argsort(-sums).tolist()
    part, last = index.traverse(q, 20)
    assert last == sums[part[-1]] and np.allclose(index.sums(q[None], np.arange(63))[0], sums)
    held = np.cumsum(np.array(index.counts)[part])
    assert held[-1] >= 20 > held[-2]


def recall(spark, x):
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {(r["query_id"], r["id"]) for r in annsearch.nearest(df).collect()}
    x = x.astype(np.float32).astype(float)
    asked = np.arange(0, len(x), 20)
    s = x[asked] @ x.T
    s[np.arange(len(asked)), asked] = -np.inf
    want = {(int(asked[q]), int(i)) for q, row in enumerate(np.argpartition(-s, 19, 1)[:, :20]) for i in row}
    assert len(got) == 20 * len(asked)
    return len(got & want) / len(want)


@pytest.mark.parametrize("n", [500, 6000])
def test_recall_on_isotropic_vectors(spark, n):
    x = np.random.default_rng(3).normal(size=(n, 64))
    assert recall(spark, x / np.linalg.norm(x, axis=1)[:, None]) >= 0.9


def test_recall_and_few_cells_on_clustered_vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(100, 64))[rng.integers(0, 100, 8000)] + 0.3 * rng.normal(size=(8000, 64))
    assert recall(spark, x) >= 0.9
    sample = x[:4000]
    index = annsearch.MultiIndex(annsearch.k_means(sample[:, :32], 45, False), annsearch.k_means(sample[:, 32:], 45, False))
    assert index.share(sample, 20, 8000) < 0.1


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_recall_on_the_tables(spark, folder):
    path = f"/root/testdata/{folder}/embeddings.parquet"
    if not os.path.exists(path):
        pytest.skip("needs the tables")
    rows = spark.read.parquet(path).select("vec_id", "embedding").collect()
    x = np.array([r["embedding"] for r in rows if r["embedding"] is not None and None not in r["embedding"]], np.float64)
    assert recall(spark, x) >= 0.9


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert annsearch.nearest(df).count() == 0
    assert annsearch.nearest(spark.createDataFrame([(20, [1.0])], df.schema)).count() == 0
