"""Line dedup and mixing against brute-force versions and on edge cases."""

import hashlib
import math
import re

import numpy as np

from lexloom.llm import linededup, mixing


def brute_chunks(text):
    lines = text.split("\n")
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    hit = [((h[i - 1] if i else 0) * 1_000_003 % 2_147_483_647 + h[i]) % 2_147_483_647 % 2 == 0 for i in range(len(h))]
    out, now = [], []
    for i, line in enumerate(lines):
        now.append(line)
        if (hit[i] and not (i and hit[i - 1])) or i == len(lines) - 1:
            out.append(now)
            now = []
    return out


def brute_dedup(rows):
    order = sorted({(2**63 - 1 if d is None else d, t) for d, t in rows if t is not None})
    seen, kept = set(), {}
    for d, t in order:
        parts = []
        for c in brute_chunks(t):
            if len(c) > 1 and tuple(c) in seen:
                continue
            seen.add(tuple(c))
            parts += c
        kept[d, t] = "\n".join(parts)
    return sorted(((d, None if t is None else kept[2**63 - 1 if d is None else d, t]) for d, t in rows), key=str)


def test_line_dedup_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    passage = [f"shared line {k}" for k in range(12)]
    rows = []
    for d in range(40):
        lines = [f"own {d} {k}" for k in range(int(rng.integers(1, 15)))]
        if d % 2:
            at = int(rng.integers(0, len(lines) + 1))
            lines[at:at] = passage[int(rng.integers(0, 4)) :]
        rows.append((d, "\n".join(lines)))
    rows += [(50, None), (51, ""), (52, "\n\n\n"), (53, "\n\n\n"), (None, rows[1][1]), (None, None), (3, rows[3][1]), (60, "\n".join(passage * 300))]
    df = spark.createDataFrame([(d, t, "x", 5) for d, t in rows], "doc_id long, text string, _id string, _drop int").repartition(3)
    out = linededup.line_dedup(df)
    got = out.collect()
    assert out.columns == ["doc_id", "text", "_id", "_drop", "_lines", "_chunks", "_removed_chunks", "_removed_lines"] and {(r["_id"], r["_drop"]) for r in got} == {("x", 5)}
    assert linededup.line_dedup(df.withColumnRenamed("_id", "_lines")).columns == ["doc_id", "text", "_drop", "_lines", "_chunks", "_removed_chunks", "_removed_lines"]
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == brute_dedup(rows)
    assert sum(r["_removed_lines"] for r in got) > 300 and sum(r["_removed_chunks"] for r in got) > 50
    for r in got:
        whole = next(t for d, t in rows if d == r["doc_id"] and (t is None) == (r["text"] is None))
        if r["doc_id"] is not None and whole is not None:
            assert r["_lines"] == whole.count("\n") + 1 and r["_lines"] - r["_removed_lines"] == (r["text"].count("\n") + 1 if r["_chunks"] > r["_removed_chunks"] else 0)
    assert linededup.line_dedup(df.limit(0)).count() == 0


def brute_mix(rows):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size(t) for _, x, t in rows if x == s) for s in names}
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    capped = set()
    while True:
        rest = sum(total.values()) - sum(3 * total[s] for s in capped)
        share = {s: 3 * total[s] if s in capped else rest * weight[s] / sum(weight[x] for x in names if x not in capped) for s in names}
        over = {s for s in names if share[s] > 3 * total[s]} - capped
        if not over:
            return share, total
        capped |= over


def test_mixing(spark):
    rng = np.random.default_rng(4)
    rows = [(d, f"s{int(rng.integers(0, 3))}", " ".join(["w"] * int(rng.integers(0, 50)))) for d in range(300)]
    rows += [(1000 + d, "big", "x y " * 200) for d in range(50)] + [(2000, "tiny", "only three words"), (2001, None, "a b"), (None, None, "c\td"), (2002, "empty", None), (2003, "empty", ""), (1000, "big", "x y " * 200), (2004, "s1", "long \n" * 20000)]
    df = spark.createDataFrame([(d, s, t, "e", len(t or "")) for d, s, t in rows], "doc_id long, source string, text string, _key string, n_chars long").repartition(5)
    share, total = brute_mix(rows)
    for buckets in (None, 4):
        out = mixing.mix(mixing.sizes(df), buckets=buckets).collect()
        assert len(out) == len(rows)
        for s in share:
            mine = [r for r in out if r["source"] == s]
            assert all(math.isclose(r["_target"], share[s], rel_tol=1e-12) and r["_source_size"] == total[s] and 0 <= r["_taken"] <= 3 * r["_size"] for r in mine)
            assert sum(r["_taken"] for r in mine) == math.floor(share[s] + 0.5)
    again = mixing.mix(mixing.sizes(df.repartition(2)), buckets=64).collect()
    assert sorted((str(r["doc_id"]), r["_size"], r["_taken"]) for r in again) == sorted((str(r["doc_id"]), r["_size"], r["_taken"]) for r in out)
    docs = mixing.mixed_documents(df)
    assert docs.columns == df.columns
    words = mixing.sizes(docs).groupBy("source").sum("_size").collect()
    assert {r["source"]: r[1] for r in words} == {s: math.floor(x + 0.5) for s, x in share.items() if x}
    texts = {t for _, _, t in rows}
    assert all(r["text"] in texts or any(t and t.startswith(r["text"]) for t in texts) for r in docs.collect())
    assert mixing.mix(mixing.sizes(df.limit(0))).count() == 0
