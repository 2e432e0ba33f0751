"""Near copies by exact Jaccard similarity against brute force."""

import numpy as np
import pytest

import corpus_pipeline
from lexloom.llm import jaccard, simhash


def brute_sets(text, n=5):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return frozenset(" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def brute_lows(rows, threshold=0.8):
    sets = [brute_sets(t) for _, t in rows]
    low = {k: d for k, (d, _) in enumerate(rows)}
    links = [(a, b) for a in range(len(rows)) for b in range(a) if sets[a] == sets[b] or len(sets[a] & sets[b]) / max(1, len(sets[a] | sets[b])) >= threshold]
    for _ in rows:
        before = dict(low)
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
        if low == before:
            break
    return {rows[k][0]: v for k, v in low.items()}


def edited(text, count, rng):
    words = text.split()
    for k in rng.choice(len(words), count, replace=False):
        words[k] = f"x{rng.integers(1 << 30)}"
    return " ".join(words)


@pytest.mark.parametrize("block", [512, 7])
def test_groups_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rng = np.random.default_rng(2)
    base = [" ".join(f"w{x}" for x in rng.integers(0, 3000, 300)) for _ in range(40)]
    texts = base + [edited(t, k % 9, rng) for k, t in enumerate(base)] + [edited(base[0], int(rng.integers(1, 6)), rng) for _ in range(40)]
    texts += ["one", "One ", "two words", "", None, " \t", "a b c d e f", "a b c d e g"]
    rows = [(int(i), t) for i, t in zip(rng.permutation(1000)[: len(texts)], texts, strict=True)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["id"]: r["component_id"] for r in jaccard.jaccard_groups(df).collect()}
    assert got == brute_lows(rows) and 40 < len(set(got.values())) < len(rows)


def test_the_stage_joins_edited_copies(spark):
    rng = np.random.default_rng(4)
    base = [" ".join(f"w{x}" for x in rng.integers(0, 3000, 400)) for _ in range(30)]
    rows = [(k, t) for k, t in enumerate(base)] + [(100 + k, edited(t, 2 + k % 6, rng)) for k, t in enumerate(base)]
    near = brute_lows(rows)
    assert all(near[100 + k] == k for k in range(30))  # 0.82 to 0.95
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"] for r in corpus_pipeline.keep_one_of_near_copies(spark, df, "").collect()} == set(range(30))


def test_repeated_and_missing_ids(spark):
    rows = [(2, "a b c d e f"), (1, "a b c d e f"), (1, "quite another text of this id"), (3, "something else entirely here now"), (None, "a b c d e f")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] or 0 for r in jaccard.keep_one_per_group(df).collect()) == [0, 1, 3]
    assert jaccard.keep_one_per_group(df.limit(0)).count() == 0


def test_the_stage_searches_by_fingerprints(spark, monkeypatch):
    """Where no band agrees, the trees over fingerprints find the near copies, and the sets decide."""

    def none_agree(sets):
        import os

        return np.frombuffer(os.urandom(8 * len(sets) * jaccard.BANDS), np.uint64).reshape(len(sets), jaccard.BANDS)

    monkeypatch.setattr(jaccard, "band_keys", none_agree)
    rng = np.random.default_rng(5)
    base = [" ".join(f"w{x}" for x in rng.integers(0, 3000, 3000)) for _ in range(20)]
    copies = [edited(t, 1, rng) for t in base]
    texts = [*base, *copies, *base[:3], "a b c d e f", "", None]
    fps = simhash.fingerprint([(t or "").encode() for t in texts], 5, 42)
    near = {k for k in range(20) if np.bitwise_count(fps[k] ^ fps[20 + k]) <= 3}
    assert len(near) > 8
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = {r["doc_id"] for r in corpus_pipeline.keep_one_of_near_copies(spark, df, "").collect()}
    assert kept == set(range(20)) | {20 + k for k in range(20) if k not in near} | {43, 44}
