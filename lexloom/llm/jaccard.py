"""Near duplicates by the Jaccard similarity of word shingles, verified exactly.

Texts of equal shingle sets are one class. Classes are loosely joined in two
ways, neither of which expands pairs. SimHash: fingerprints within the radius,
found with vantage-point trees (``simhash.near_links``). MinHash, for the similar
texts whose fingerprints lie farther apart: classes that agree in all ROWS values
of at least one of BANDS bands. A pair at similarity s is no candidate of MinHash
with probability (1 - s^ROWS)^BANDS: 3e-6 at 0.8, less above. The texts of a loose
component then come together once (large ones in pairs of blocks), where the
shingle sets themselves decide; tasks return a spanning forest of the links, and
the forests join into components over the whole corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.common import cut_lineage, spread
from lexloom.llm.components import components
from lexloom.llm.simhash import majority, near_links, one_per_group
from lexloom.llm.textkernel import P1, P2, Words, blocks, texts_of, xxh64

BANDS, ROWS = 32, 5
#: Classes of a loose component that come together in one task; larger components are dealt out in pairs of blocks.
BLOCK = 512
#: About so many classes of small loose components share a task.
SHARED = 2000
_rng = np.random.default_rng(13)
FLIP = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
FACTOR = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles_of(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Return the 64-bit hashes of the shingles of a block of texts, repeats included, and where those of each text begin."""
    w = Words(texts)
    start, end, first = w.shingles(words)
    return xxh64(w.buf, start, end, 42), first


def distinct(hashes: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Return the sorted distinct hashes of each text."""
    return [np.unique(hashes[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Return the sorted distinct 64-bit hashes of the shingles of each text; no word gives an empty set."""
    return [one for lo, hi in blocks(texts) for one in distinct(*shingles_of(texts[lo:hi], words))]


def name_of(one: np.ndarray) -> int:
    """Return the 64-bit name of a shingle set."""
    return xxhash.xxh64_intdigest(one.tobytes(), 7)


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """Return the band keys of non-empty ``sets``, a row of BANDS for each."""
    out = np.zeros((len(sets), BANDS), np.uint64)
    if not sets:
        return out
    first = np.cumsum([0, *map(len, sets[:-1])])
    every = np.concatenate(sets)
    with np.errstate(over="ignore"):
        for k in range(BANDS):
            key = np.full(len(sets), np.uint64(k + 1) * P1)
            for r in range(k * ROWS, (k + 1) * ROWS):
                key = (key ^ np.minimum.reduceat((every ^ FLIP[r]) * FACTOR[r], first)) * P2
                key ^= key >> np.uint64(31)
            out[:, k] = key
    return out


def links_of(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray | None, threshold: float) -> np.ndarray:
    """Return the root that each set reaches over pairs of ``left`` and ``right`` (None: of ``left``) at ``threshold`` or more.

    Pairs that earlier links have joined are not compared again.
    """
    root, size = np.arange(len(sets)), np.array([len(x) for x in sets])
    for n, a in enumerate(left.tolist()):
        others = left[:n] if right is None else right
        low, high = np.minimum(size[others], size[a]), np.maximum(size[others], size[a])
        for b in others[(low >= threshold * high - 1e-9) & (root[others] != root[a])].tolist():
            if root[a] == root[b]:
                continue
            x, y = sets[a], sets[b]
            both = int((x[np.minimum(x.searchsorted(y), len(x) - 1)] == y).sum())
            if both / (len(x) + len(y) - both) >= threshold:
                root[root == max(root[a], root[b])] = min(root[a], root[b])
    return root


def near_fingerprints(signed: DataFrame, radius: int) -> DataFrame:
    """Return links (a, b) between classes of ``signed`` (id, h, fp, bands) that join all whose fingerprints are within ``radius`` bits.

    Texts without words have no fingerprint here.
    """
    points = signed.where("id IS NOT NULL AND size(bands) > 0").select("h", "fp").distinct()
    firsts = cut_lineage(points.groupBy("fp").agg(F.min("h").alias("b")))
    equal = points.join(firsts, "fp").where("h != b").select(F.col("h").alias("a"), "b")
    ends = [firsts.select(F.col("fp").alias(f"fp_{c}"), F.col("b").alias(c)) for c in "ab"]
    links = near_links(firsts.select("fp"), radius).select(F.col("a").alias("fp_a"), F.col("b").alias("fp_b"))
    return equal.unionByName(links.join(ends[0], "fp_a").join(ends[1], "fp_b").select("a", "b"))


def jaccard_groups(docs: DataFrame, words: int = 5, threshold: float = 0.8, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return (id, component_id) for every row of ``docs``.

    component_id is the smallest id that the row reaches over links of a Jaccard
    similarity of at least ``threshold`` between sets of ``words``-word shingles.
    Null texts and texts without words have the empty set, which is linked with
    itself only; rows with equal sets are rows of one class, and rows whose id is
    null belong to a component but never name it. An empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = texts_of(batch.column(1))
            for lo, hi in blocks(raw):
                hashes, first = shingles_of(raw[lo:hi], words)
                sets = distinct(hashes, first)
                keys = np.zeros((len(sets), BANDS), np.uint64)
                some = np.flatnonzero([len(x) for x in sets])
                keys[some] = band_keys([sets[k] for k in some])
                names = np.array([name_of(x) for x in sets], np.uint64).view(np.int64)
                filled = np.zeros(len(sets), np.int64)
                filled[some] = BANDS
                bands = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(filled)]), pa.int32()), pa.array(keys[some].ravel().view(np.int64)))
                fps = pa.array(majority(hashes, first).view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0)[lo:hi], pa.array(names), fps, bands], ["id", "h", "fp", "bands"])

    signed = cut_lineage(spread(texts).mapInArrow(sign, "id long, h long, fp long, bands array<long>"))
    classes = cut_lineage(signed.groupBy("h").agg(F.min("id").alias("low"), F.first("bands").alias("bands")))
    keys = classes.where("low IS NOT NULL").select("h", F.explode("bands").alias("key"))
    shared = cut_lineage(keys.groupBy("key").agg(F.min("h").alias("b"), F.max("h").alias("top")).where("b < top").select("key", "b"))
    in_band = keys.join(shared, "key").where("h != b").select(F.col("h").alias("a"), "b").distinct()
    loose = components(in_band.unionByName(near_fingerprints(signed, radius)))
    loose = cut_lineage(loose.select(F.col("node").alias("h"), F.col("root").alias("loose")))
    sizes = loose.groupBy("loose").agg(F.count("*").alias("many"))
    tasks = max(1, loose.count() // SHARED)
    placed = loose.join(sizes, "loose").join(classes.select("h", "low"), "h")
    dealt = F.ceil(F.col("many") / BLOCK).cast("long")
    placed = placed.withColumn("mine", F.when(dealt > 1, F.pmod(F.xxhash64("h"), dealt)).otherwise(F.lit(0).cast("long")))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), dealt - 1)))
    placed = placed.select("h", "low", "loose", "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), F.when(dealt > 1, F.col("loose")).otherwise(F.pmod("loose", F.lit(tasks))).alias("deal"))
    sent = texts.join(placed, F.col("id") == F.col("low")).select("text", "h", "loose", "mine", "i", "j", "deal")

    def verify(part: pa.Table) -> pa.Table:
        sets = shingle_sets(texts_of(part["text"]), words)
        h, loose_root, mine = (part[c].to_numpy() for c in ("h", "loose", "mine"))
        i, j = part["i"][0].as_py(), part["j"][0].as_py()
        # Of rows that share an id only one row of the class itself counts.
        own = np.array([name_of(x) for x in sets], np.uint64).view(np.int64) == h
        at = np.flatnonzero(own)
        at = at[np.unique(h[at], return_index=True)[1]]
        at = at[np.argsort(loose_root[at], kind="stable")]
        a, b = [], []
        for rows in np.split(at, np.flatnonzero(np.diff(loose_root[at])) + 1):
            local = np.arange(len(rows))
            left, right = (local, None) if i == j else (local[mine[rows] == i], local[mine[rows] == j])
            root = links_of([sets[k] for k in rows], left, right, threshold)
            moved = np.flatnonzero(root != local)
            a.append(h[rows[moved]])
            b.append(h[rows[root[moved]]])
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    roots = components(sent.groupBy("deal", "i", "j").applyInArrow(verify, "a long, b long"))
    rooted = classes.select("h", "low").join(roots, F.col("h") == F.col("node"), "left").select("h", "low", F.coalesce("root", "h").alias("root"))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return signed.select("id", "h").join(rooted.join(lows, "root").select("h", "component_id"), "h").select("id", "component_id")


def keep_one_per_group(docs: DataFrame, words: int = 5, threshold: float = 0.8, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return one row of ``docs`` for each group: that with the group's smallest id; rows whose id is null stay."""
    groups = jaccard_groups(docs.where(F.col(id_col).isNotNull()), words, threshold, radius, id_col, text_col)
    return one_per_group(docs, groups, id_col, text_col)
