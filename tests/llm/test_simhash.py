"""SimHash groups against a brute-force version."""

import re

import numpy as np
import pytest
import xxhash

from lexloom.llm import simhash
from lexloom.llm.components import components


def brute_fingerprint(text, n=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)] if len(words) >= n else ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    lows = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            lows[find(i)] = min(d, lows.get(find(i), d))
    return sorted(((d, f, lows.get(find(i))) for i, ((d, _), f) in enumerate(zip(rows, fps, strict=True))), key=str)


def test_groups_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choice(words, n)) for n in rng.integers(30, 200, 60)]
    rows = list(enumerate(base, 10))
    for i, t in enumerate(base[:30]):
        w = t.split()
        for k in range(3):
            w2 = list(w)
            w2[int(rng.integers(len(w2)))] = f"x{k}"
            rows.append((1000 + 10 * i + k, " ".join(w2)))
    rows += [(5, None), (6, ""), (7, " \t\n"), (8, "One"), (9, "one"), (3, "two Words"), (None, "two words"), (None, "alone here null"), (10, base[0]), (10, base[1]), (4, "żółć x Ä " * 5000)]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, fp string, shard int").repartition(3)
    got = simhash.simhash_groups(df).collect()
    assert sorted(((r["id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in got), key=str) == brute_groups(rows)


def test_small_shards_lose_no_link(spark):
    rng = np.random.default_rng(5)
    fps = rng.integers(0, 1 << 63, 600, dtype=np.uint64)
    near = fps[:200] ^ (np.uint64(1) << rng.integers(0, 60, 200, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 60, 200, dtype=np.uint64))
    every = np.unique(np.concatenate([fps, near]))
    df = spark.createDataFrame([(int(x),) for x in every.view(np.int64)], "fp long")
    got = {r["node"]: r["root"] for r in components(simhash.near_links(df, 3, shard_rows=40)).collect()}
    order = np.sort(every.view(np.int64))
    links = np.argwhere(np.bitwise_count(order.view(np.uint64)[:, None] ^ order.view(np.uint64)[None]) <= 3)
    root = simhash.forest(len(order), links[:, 0], links[:, 1])
    assert [got.get(int(x), int(x)) for x in order] == order[root].tolist()


def test_local_tree_with_a_dense_ball():
    rng = np.random.default_rng(1)
    ball = np.unique(np.bitwise_xor(np.uint64(12345), np.uint64(1) << rng.integers(0, 64, (3000, 3), dtype=np.uint64)[:, 0]) ^ (np.uint64(1) << rng.integers(0, 64, 3000, dtype=np.uint64)))
    far = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    every = np.unique(np.concatenate([ball, far]))
    links = np.argwhere(np.bitwise_count(every[:, None] ^ every[None]) <= 3)
    assert (simhash.links_within(every, 3) == simhash.forest(len(every), links[:, 0], links[:, 1])).all()


def test_one_row_of_each_group_stays(spark):
    rows = [(2, "a b c d e f", "s"), (1, "a b c d e f", None), (1, "a b c d e f", None), (3, "something else entirely here now", "s"), (None, "a b c d e f", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = simhash.keep_one_per_group(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 3]


def test_empty_table(spark):
    assert simhash.simhash_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(5, 4), (4, 3), (3, 2), (2, 1), (9, 8), (8, 9)]])
def test_components(spark, edges):
    got = {(r["node"], r["root"]) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == ({(i, 1) for i in range(1, 6)} | {(8, 8), (9, 8)} if len(edges) > 1 else set())
