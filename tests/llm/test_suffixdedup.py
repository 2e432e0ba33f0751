"""Repeated strings through the run-length index against brute force."""

import hashlib
import os
from collections import Counter

import numpy as np
import pytest

from lexloom.llm import suffixdedup


def brute(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        edge = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def corpus(rng):
    words = ["alpha", "bé", "gamma", "δ", "epsilon,", "z\n", "the", "of"]
    make = lambda n: " ".join(rng.choice(words, n))
    passage, common = make(130), make(60)
    texts = [make(int(rng.integers(20, 300))) for _ in range(25)]
    texts += [make(30) + passage[:k] + make(int(rng.integers(0, 60))) for k in (399, 410, 500, 600)]
    texts += [make(25) + common[:300] + make(25) for _ in range(8)]
    edited = list(texts[3] + make(300))
    for _ in range(6):
        variant = list(edited)
        for at in rng.integers(0, len(variant), 2):
            variant[at] = "X"
        texts.append("".join(variant))
    texts += ["ab" * 500, "ab" * 700, "word " * 200, texts[0], texts[0], "", "x" * 399, "y" * 400, "q" * 401]
    return texts


def spans_of(out):
    return sorted(((r["doc_id"], r["_bytes"], sum(s["last"] - s["first"] for s in r["_spans"]), len(r["_spans"]), hashlib.sha256(r["_kept"]).hexdigest()) for r in out), key=str)


@pytest.mark.parametrize(("crowd", "shard", "segment"), [(250_000, 1_000_000, 1 << 20), (1500, 3000, 150), (0, 3000, 1 << 20)])
def test_equals_brute_force(spark, monkeypatch, crowd, shard, segment):
    """Also with indexes so small that groups are cut finely (0: down to single windows) and with short segments."""
    monkeypatch.setattr(suffixdedup, "CROWD_BYTES", crowd)
    monkeypatch.setattr(suffixdedup, "SHARD_BYTES", shard)
    monkeypatch.setattr(suffixdedup, "SEGMENT", segment)
    texts = corpus(np.random.default_rng(4))
    rows = [*enumerate(texts), (None, None), (3, texts[3]), (7, None)]
    df = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], "doc_id long, text string, t1 string, _marks int, anchor int").repartition(4)
    out = suffixdedup.without_repeats(df).collect()
    want = brute([(t or "").encode() for _, t in rows], 400)
    assert spans_of(out) == sorted(((d, *w) for (d, _), w in zip(rows, want, strict=True)), key=str)
    assert all((r["t1"], r["_marks"], r["anchor"]) == ("x", 1, 2) for r in out)
    assert suffixdedup.without_repeats(df.limit(0)).count() == 0
    if segment == 150:
        out = suffixdedup.without_repeats(df.withColumnRenamed("t1", "_kept").withColumnRenamed("anchor", "c1"))
        assert spans_of(out.collect()) == sorted(((d, *w) for (d, _), w in zip(rows, want, strict=True)), key=str) and out.columns == ["doc_id", "text", "_marks", "c1", "_bytes", "_spans", "_kept"]


@pytest.mark.parametrize("segment", [1 << 20, 333])
def test_periodic_runs_equal_brute_force(spark, monkeypatch, segment):
    monkeypatch.setattr(suffixdedup, "SEGMENT", segment)
    rng = np.random.default_rng(8)
    letters = np.array(list("abcdefgh "))
    make = lambda n: "".join(rng.choice(letters, n))
    texts = []
    for period in (1, 2, 7, 63, 64, 65, 100, 200, 399, 400):
        unit = make(period)
        for n in (399, 400, 400 + period - 1, 400 + period, 700, 2000):
            run = (unit * (n // period + 1))[:n]
            texts.append(make(int(rng.integers(0, 40))) + run + make(int(rng.integers(0, 40))))
    texts += [make(50) + "z" * 900 + make(500) + "z" * 420 + make(30), "z" * 400, ("no " * 300 + "yes ") * 3]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert spans_of(suffixdedup.without_repeats(df).collect()) == sorted(((d, *w) for d, w in enumerate(brute([t.encode() for t in texts], 400))), key=str)


def test_very_long_periodic_texts_have_few_rows(spark):
    """20 MB of one letter, and of a short period: all goes, and no task holds a row for each byte."""
    texts = ["a" * 20_000_000, "word " * 4_000_000, "x" + "a" * 399, "b" + "a" * 400]
    assert sum(len(place) for text in texts[:2] for place, *_ in suffixdedup.segments(text.encode(), 400)) < 5_000
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (sum(s["last"] - s["first"] for s in r["_spans"]), len(r["_spans"])) for r in suffixdedup.without_repeats(df).collect()}
    assert got == {0: (20_000_000, 1), 1: (20_000_000, 1), 2: (0, 0), 3: (400, 1)}


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01", "sf0.1"])
def test_whole_tables_equal_brute_force(spark, folder):
    path = f"/root/testdata/{folder}/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("needs the tables")
    df = spark.read.parquet(path).select("doc_id", "text")
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in df.collect()}
    # Windows by a rolling hash: its equal values are compared byte by byte.
    base = 1_000_003
    every, owner, start = [], [], []
    for d, t in texts.items():
        x = np.frombuffer(t, np.uint8).astype(np.uint64) + np.uint64(1)
        if len(x) >= 400:
            with np.errstate(over="ignore"):
                power = np.cumprod(np.full(len(x), base, np.uint64))
                sums = np.concatenate([[np.uint64(0)], np.cumsum(x * power)])
                back = np.cumprod(np.full(len(x), pow(base, -1, 1 << 64), np.uint64))
                h = (sums[400:] - sums[:-400]) * back[: len(x) - 399]
            every.append(h)
            owner.append(np.full(len(h), d))
            start.append(np.arange(len(h)))
    every, owner, start = np.concatenate(every), np.concatenate(owner), np.concatenate(start)
    order = np.argsort(every, kind="stable")
    same = every[order][1:] == every[order][:-1]
    for k in np.flatnonzero(same)[:: max(1, int(same.sum()) // 2000)].tolist():
        (a, i), (b, j) = ((int(owner[order[k + e]]), int(start[order[k + e]])) for e in (0, 1))
        assert texts[a][i : i + 400] == texts[b][j : j + 400]
    twice = np.zeros(len(every), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    gone = {d: np.zeros(len(t) + 1, np.int64) for d, t in texts.items()}
    for d, i in zip(owner[twice].tolist(), start[twice].tolist(), strict=True):
        gone[d][i] += 1
        gone[d][i + 400 if i + 400 < len(gone[d]) else -1] -= 1
    want = []
    for d, t in texts.items():
        cover = np.cumsum(gone[d])[: len(t)] > 0
        edge = np.diff(np.concatenate([[0], cover.astype(int), [0]]))
        want.append((d, len(t), int(cover.sum()), int((edge == 1).sum()), hashlib.sha256(np.frombuffer(t, np.uint8)[~cover].tobytes()).hexdigest()))
    assert spans_of(suffixdedup.without_repeats(df).collect()) == sorted(want, key=str)


def test_suffix_array_and_statistics():
    rng = np.random.default_rng(0)
    for text in (b"banana", b"aaaaaaaaaaaaaaaaaaaaaaaaaaaa", b"a", bytes(rng.integers(97, 100, 3000, dtype=np.uint8)), b"abcabcabc" * 50 + b"x" + b"abcabcabc" * 50):
        t = np.frombuffer(text, np.uint8)
        sa = suffixdedup.suffix_array(t)
        assert sa.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
        lcp = lambda i, j: next((k for k in range(len(text)) if text[i + k : i + k + 1] != text[j + k : j + k + 1] or i + k >= len(text)), 0)
        index = suffixdedup.RunIndex(t)
        assert index.runs.sum() == len(text)
        got = index.matching()
        for row in rng.integers(0, len(text), 60):
            near = [lcp(int(sa[row]), int(sa[k])) for k in (row - 1, row + 1) if 0 <= k < len(sa)]
            assert got[sa[row]] == max(near, default=0)
