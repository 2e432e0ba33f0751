"""Packing: exact round trip, full sequences and little waste."""

import os
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from lexloom.llm import packing

TEXTS = ["", " a  b\n\n c", "ñandú über <|endoftext|> x", "don't  DON'T 123456 ", "中文字 🙂‍↔️", "a" * 3000, "\x00\x01﻿", "word " * 5000, "the quick brown fox " * 90]


def test_ids_are_those_of_tokenizers():
    encode = packing.encoding(packing.vocabulary_path())
    whole = Tokenizer.from_file(packing.vocabulary_path())
    for text in TEXTS:
        assert encode(text) == whole.encode(text, add_special_tokens=False).ids


def test_other_vocabularies_go_through_tokenizers():
    path = packing.vocabulary_path().replace("byte_bpe_50k", "word_bpe_49k")
    assert packing.encoding(path)("hello") == Tokenizer.from_file(path).encode("hello", add_special_tokens=False).ids


@pytest.mark.parametrize("n", [1, 2, 1023, 1024, 1025, 2047, 2048, 2049, 5000])
def test_cut(n):
    parts = packing.cut(n)
    assert sum(x for _, x in parts) == n and all(x == 1024 for _, x in parts[1:]) and all(s == sum(x for _, x in parts[:k]) for k, (s, _) in enumerate(parts))


def brute_place(sizes, capacity):
    """Try every open bin and a new one; take the smallest sum of squares, then the smallest gap."""
    gaps, out = [], []
    for size in sizes:
        best = None
        for at, gap in [*enumerate(gaps), (len(gaps), capacity)]:
            if gap >= size:
                after = [g for k, g in enumerate(gaps) if k != at] + [gap - size]
                score = sum(after.count(g) ** 2 for g in set(after) if g)
                if best is None or (score, gap) < best[:2]:
                    best = (score, gap, at)
        if best[2] == len(gaps):
            gaps.append(capacity)
        gaps[best[2]] -= size
        out.append(best[2])
    return sorted(gaps)


def test_rule_equals_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(20):
        sizes = rng.integers(1, 21, 40)
        bins = packing.place(sizes, 20)
        assert sorted(20 - np.bincount(bins, sizes).astype(int)) == brute_place(sizes.tolist(), 20)


def test_sparing_rule_equals_brute_force():
    """Among the open bins with room the smallest sum of squares, then the smallest gap; a new bin where none has room."""
    rng = np.random.default_rng(1)
    for _ in range(30):
        sizes = rng.integers(1, 21, 40)
        gaps: list[int] = []
        want = np.zeros(40, int)
        for k in np.argsort(-sizes, kind="stable").tolist():
            fits = []
            for at, gap in enumerate(gaps):
                if gap >= sizes[k]:
                    after = [g for j, g in enumerate(gaps) if j != at] + [gap - sizes[k]]
                    fits.append((sum(after.count(g) ** 2 for g in set(after) if g), gap, at))
            want[k] = min(fits)[2] if fits else len(gaps)
            if not fits:
                gaps.append(20)
            gaps[want[k]] -= sizes[k]
        assert sorted(20 - np.bincount(packing.pack(sizes, 20), sizes).astype(int)) == sorted(gaps)


def test_ids_of_whole_tables_and_odd_strings():
    encode = packing.encoding(packing.vocabulary_path())
    whole = Tokenizer.from_file(packing.vocabulary_path())
    rng = np.random.default_rng(5)
    texts = [bytes(rng.integers(0, 256, int(n), dtype=np.uint8)).decode("utf-8", "replace") for n in rng.integers(1, 400, 300)]
    texts += ["".join(chr(int(c)) for c in rng.integers(1, 0xD7FF, 60)) for _ in range(300)]
    texts += [c * n for c in ("a", " ", "\n", "é", "0", "<|endoftext|>", "🙂", "'s ") for n in (1, 2, 3, 127, 1000)]
    for folder in ("sf0.001", "sf0.01", "sf0.1"):
        if os.path.isdir(f"/root/testdata/{folder}"):
            texts += [t or "" for t in pq.read_table(f"/root/testdata/{folder}/documents.parquet", columns=["text"])["text"].to_pylist()]
    for text, want in zip(texts, whole.encode_batch(texts, add_special_tokens=False), strict=True):
        assert encode(text) == want.ids, text[:50]


def test_waste_on_whole_tables():
    path = "/root/testdata/sf0.1/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("needs the tables")
    encode = packing.encoding(packing.vocabulary_path())
    lengths = [packing.cut(len(encode(t or "")) + 1)[0][1] for t in pq.read_table(path, columns=["text"])["text"].to_pylist()]
    sizes = np.array([n for n in lengths if n < 1024])
    assert packing.pack(sizes).max() + 1 <= 1.005 * sizes.sum() / 1024


def test_little_waste():
    sizes = np.random.default_rng(0).integers(1, 1024, 5000)
    filled = np.bincount(packing.pack(sizes), sizes)
    assert filled.max() <= 1024 and len(filled) <= 1.02 * sizes.sum() / 1024
    assert len(packing.pack(np.zeros(0, np.int64))) == 0


def test_round_trip(spark):
    rows = [(k, t, "x", 7) for k, t in enumerate(TEXTS)] + [(1, TEXTS[1], None, 7), (1, "other", None, 7), (None, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string, length int").repartition(3)
    cut = packing.pieces(df, packing.vocabulary_path(), with_ids=True)
    want = sorted(((r["id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in cut.collect()), key=str)
    encode = packing.encoding(packing.vocabulary_path())
    for r in cut.collect():
        if r["id"] not in (1, None):
            assert r["ids"] == [*encode(TEXTS[r["id"]]), 2][r["start"] : r["start"] + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    out = packing.packed(cut, block_rows=4).collect()
    assert sorted(((r["id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out), key=str) == want
    sequences = {}
    for r in out:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.packed(packing.pieces(df.limit(0), packing.vocabulary_path())).count() == 0
