"""Embedding near-dedup against brute force."""

import math

import numpy as np
import pyarrow as pa
import pytest

from lexloom.llm import embdedup


def brute(rows, threshold=0.9):
    good = [k for k, (i, v) in enumerate(rows) if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)]
    unit = {k: np.array(rows[k][1], float) / np.linalg.norm(np.array(rows[k][1], float)) for k in good}
    root = {k: k for k in good}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    links = dict.fromkeys(good, 0)
    for a in good:
        for b in good:
            if a < b and len(rows[a][1]) == len(rows[b][1]) and unit[a] @ unit[b] >= threshold:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    lows = {}
    for k in good:
        lows[find(k)] = min(rows[k][0], lows.get(find(k), rows[k][0]))
    return sorted(((i, links.get(k, 0), lows[find(k)] if k in links else i, i is not None and (k not in links or lows[find(k)] == i)) for k, (i, _) in enumerate(rows)), key=str)


@pytest.mark.parametrize("block", [8192, 60])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embdedup, "BLOCK", block)
    rng = np.random.default_rng(6)
    base = rng.normal(size=(150, 16))
    near = [base[k % 30] + rng.normal(size=16) * rng.choice([0.05, 0.25, 0.4]) for k in range(250)]
    rows = [(int(i), [float(np.float32(c)) for c in v]) for i, v in zip(rng.permutation(5000)[:400], [*base, *near], strict=True)]
    rows += [(6000 + k, rows[7][1]) for k in range(5)] + [(6000, rows[7][1])]
    rows += [(7000, None), (7001, [0.0] * 16), (7002, [float("nan")] + [1.0] * 15), (7003, [None] + [1.0] * 15), (7004, []), (7005, [1.0, 2.0]), (7006, [2.0, 4.0]), (None, rows[7][1]), (None, None), (7007, [float("inf")] * 16)]
    rows += [(7008, [x * 1e30 for x in rows[3][1]]), (7009, [x * 1e-30 for x in rows[3][1]])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, label int, kept string").repartition(4)
    out = embdedup.near_vectors(df, guard=1.0).collect()
    assert sorted(((r["id"], r["n_links"], r["component_id"], r["kept"]) for r in out), key=str) == brute(rows)


def test_recall_of_the_default_guard(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(1500, 64))
    base /= np.linalg.norm(base, axis=1)[:, None]
    noise = rng.normal(size=base.shape)
    noise -= (noise * base).sum(1)[:, None] * base
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    cos = rng.uniform(0.9, 0.93, (1500, 1))
    every = np.concatenate([base, cos * base + np.sqrt(1 - cos**2) * noise])
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(every)], "vec_id long, embedding array<double>")
    got = sum(r["n_links"] for r in embdedup.near_vectors(df, cells=40).collect())
    want = int(((every @ every.T) >= 0.9).sum()) - len(every)
    assert 0.99 * want <= got <= want


def test_the_default_loses_no_link_between_cells(spark):
    """Pairs that differ along the line between two centres, about the plane between them."""
    rng = np.random.default_rng(9)
    axes = np.linalg.qr(rng.normal(size=(64, 64)))[0]
    rows = []
    for side in (1, -1):
        around = side * axes[0] + rng.normal(size=(300, 64)) @ axes * 0.02
        rows += list(around)
    for k in range(40):
        turn = math.acos(0.9) * 0.49
        rows += [math.cos(turn) * axes[2 + k] + s * math.sin(turn) * axes[0] for s in (1, -1)]
    every = np.array(rows) / np.linalg.norm(rows, axis=1)[:, None]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(every)], "vec_id long, embedding array<double>")
    got = {r["id"]: r["n_links"] for r in embdedup.near_vectors(df, cells=2).collect()}
    want = ((every @ every.T) >= 0.9).sum(1) - 1
    assert want[600:].min() == 1 and [got[k] for k in range(len(every))] == want.tolist()


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embdedup.near_vectors(df).count() == 0
    assert embdedup.near_vectors(spark.createDataFrame([(1, None)], df.schema)).collect()[0][:] == (1, 0, 1, True)


def test_routing_is_bounded(spark, monkeypatch):
    """However many bins there are, rows are routed in batches of bounded size and go to each bin at most once."""
    monkeypatch.setattr(embdedup, "BLOCK", 128)
    x = np.random.default_rng(10).normal(size=(4000, 32))
    rows = spark.createDataFrame([(v.tolist(), k, 1, k, k) for k, v in enumerate(x)], "_vec array<double>, low long, many long, _h long, _g long")
    made, plain = [], type(rows).mapInArrow
    monkeypatch.setattr(type(rows), "mapInArrow", lambda self, run, *rest: made.append(run) or plain(self, run, *rest))
    embdedup.of_length(rows, len(x), 32, 0.9, 16, 1.0)
    batch = pa.RecordBatch.from_arrays([pa.array(x.tolist()), *[pa.array(c) for c in (np.arange(len(x)), np.ones(len(x), np.int64), np.arange(len(x)), np.arange(len(x)))]], rows.columns)
    sent = [b.num_rows for b in made[-1](iter([batch]))]
    assert max(sent) <= 128 and sum(sent) <= 2 * len(x) * len(x) / 128
