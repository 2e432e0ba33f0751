"""SimHash near-duplicates found with vantage-point trees over Hamming space.

A text's fingerprint takes the majority of each bit over the XXH64 hashes of its
word shingles. Equal fingerprints are one class. Classes are spread over shards
by the upper levels of a vantage-point tree: a fingerprint at distance d from a
node's vantage point goes inside if d <= mu and outside if d > mu - radius, so
that of any two fingerprints within the radius both are in at least one child
(triangle inequality). What overlaps a boundary is thus queried in both shards.
In each shard a local tree goes on the same way down to small leaves, which are
compared in full. A shard returns no pairs but a spanning forest of its links;
the forests join into components over the whole corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexloom.llm.common import cut_lineage, given_back, others, spread, table
from lexloom.llm.components import components
from lexloom.llm.textkernel import Words, blocks, texts_of, xxh64

#: Fingerprints that are drawn to place the upper levels of the tree.
SAMPLE = 1 << 15
LEAF = 384
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
OFFSETS = np.arange(8, dtype=np.int64) * 256


def majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Return the majority of each bit over the hashes from first[k] to first[k + 1], for every k; none gives zero."""
    out = np.zeros(len(first) - 1, np.uint64)
    octets = hashes.view(np.uint8).reshape(-1, 8).astype(np.int64) + OFFSETS
    for k, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
        if b > a:
            seen = np.bincount(octets[a:b].ravel(), minlength=2048).reshape(8, 256) @ BITS
            out[k] = np.packbits((2 * seen.ravel() > b - a), bitorder="little").view("<u8")[0]
    return out


def fingerprint(texts: list[bytes], words: int, seed: int) -> np.ndarray:
    """Return the 64-bit fingerprints of ``texts``; no word gives zero."""
    out = np.zeros(len(texts), np.uint64)
    for lo, hi in blocks(texts):
        w = Words(texts[lo:hi])
        start, end, first = w.shingles(words)
        out[lo:hi] = majority(xxh64(w.buf, start, end, seed), first)
    return out


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return (id, fp long) for every row of ``docs``; null texts count as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = fingerprint(texts_of(batch.column(1)), words, seed).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], ["id", "fp"])

    return spread(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))).mapInArrow(run, "id long, fp long")


@dataclass
class Tree:
    """Upper levels: node k has the children 2k+1 (inside) and 2k+2 (outside)."""

    depth: int
    point: np.ndarray
    mu: np.ndarray

    def shards(self, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Return (index into fps, leaf) for every leaf that each fingerprint belongs to."""
        at, node = np.arange(len(fps)), np.zeros(len(fps), np.int64)
        for _ in range(self.depth):
            d = np.bitwise_count(fps[at] ^ self.point[node]).astype(np.int64)
            inside, outside = d <= self.mu[node], d > self.mu[node] - radius
            at, node = np.concatenate([at[inside], at[outside]]), np.concatenate([2 * node[inside] + 1, 2 * node[outside] + 2])
        return at, node


def split_of(fps: np.ndarray, radius: int, rng: np.random.Generator) -> tuple[np.uint64, int, int]:
    """Choose a vantage point and radius for ``fps``: (point, mu, rows in both children)."""
    best = (np.uint64(0), 32, 2 * len(fps))
    for point in [*rng.choice(fps, min(4, len(fps)), replace=False), *rng.integers(0, 1 << 63, 4, dtype=np.uint64) * np.uint64(2)]:
        counts = np.bincount(np.bitwise_count(fps ^ point), minlength=65).cumsum()
        for mu in {int(np.searchsorted(counts, q * len(fps))) for q in (0.35, 0.5, 0.65)}:
            inside, outside = int(counts[mu]), len(fps) - int(counts[mu - radius] if mu >= radius else 0)
            if inside**2 + outside**2 < best[2] ** 2 and max(inside, outside) < len(fps):
                best = (np.uint64(point), mu, int((inside**2 + outside**2) ** 0.5))
    return best


def grow(sample: np.ndarray, depth: int, radius: int) -> Tree:
    """Place ``depth`` levels of a tree by a sample; nodes that few sampled rows reach take a random point and the middle distance."""
    rng = np.random.default_rng(7)
    n = (1 << depth) - 1
    tree = Tree(depth, rng.integers(0, 1 << 63, max(n, 1), dtype=np.uint64) * np.uint64(2), np.full(max(n, 1), 32))
    here = {0: sample}
    for node in range(n):
        fps = here.pop(node, sample[:0])
        if len(fps) >= 32:
            point, mu, _ = split_of(fps, radius, rng)
            tree.point[node], tree.mu[node] = point, mu
            d = np.bitwise_count(fps ^ point)
            here[2 * node + 1], here[2 * node + 2] = fps[d <= mu], fps[d.astype(np.int64) > mu - radius]
    return tree


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Return the smallest index that each of ``n`` points reaches over the links a-b."""
    root = np.arange(n)
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        open_ = low < high
        a, b = a[open_], b[open_]
        np.minimum.at(root, high[open_], low[open_])
        while (root != root[root]).any():
            root = root[root]
    return root


def links_within(fps: np.ndarray, radius: int) -> np.ndarray:
    """Return, for distinct fingerprints, the root that each reaches by links of at most ``radius`` bits."""
    rng = np.random.default_rng(11)
    all_a, all_b = [], []

    def leaf(at: np.ndarray) -> None:
        root = np.arange(len(at))
        for lo in range(0, len(at), LEAF):
            near = np.bitwise_count(fps[at[lo : lo + LEAF], None] ^ fps[at[lo:]][None]) <= radius
            i, j = np.nonzero(near)
            new = forest(len(at), np.concatenate([np.arange(len(at)), i + lo]), np.concatenate([root, j + lo]))
            root = new
        moved = np.flatnonzero(root != np.arange(len(at)))
        all_a.append(at[moved])
        all_b.append(at[root[moved]])

    todo = [np.arange(len(fps))]
    while todo:
        at = todo.pop()
        if len(at) <= LEAF:
            leaf(at)
            continue
        mine = fps[at]
        drawn = mine if len(mine) <= 2048 else rng.choice(mine, 2048, replace=False)
        point, mu, _ = split_of(drawn, radius, rng)
        d = np.bitwise_count(mine ^ point).astype(np.int64)
        inside, outside = at[d <= mu], at[d > mu - radius]
        if max(len(inside), len(outside)) > 0.95 * len(at):
            leaf(at)
        else:
            todo += [inside, outside]
    if not all_a:
        return np.arange(len(fps))
    return forest(len(fps), np.concatenate(all_a), np.concatenate(all_b))


def near_links(classes: DataFrame, radius: int = 3, shard_rows: int = 64_000) -> DataFrame:
    """Return links (a, b) between the distinct fingerprints of ``classes`` (fp): a spanning forest per shard.

    The components of these links are those of all pairs within ``radius``.
    """
    spark = classes.sparkSession
    total = classes.count()
    depth = 0
    while total * 0.66**depth > shard_rows:
        depth += 1
    drawn = [r["fp"] for r in classes.orderBy(F.xxhash64("fp")).limit(SAMPLE).collect()]  # at most SAMPLE longs
    tree = grow(np.array(drawn, np.int64).view(np.uint64), depth, radius)
    shared = spark.sparkContext.broadcast(tree)  # two words for each of the shards

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            at, node = shared.value.shards(fps.view(np.uint64), radius)
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(fps[at])], ["shard", "fp"])

    def within(part: pd.DataFrame) -> pd.DataFrame:
        fps = np.sort(part["fp"].to_numpy())
        root = links_within(fps.view(np.uint64), radius)
        moved = np.flatnonzero(root != np.arange(len(fps)))
        return pd.DataFrame({"a": fps[moved], "b": fps[root[moved]]})

    return classes.select("fp").mapInArrow(route, "shard long, fp long").groupBy("shard").applyInPandas(within, "a long, b long")


def simhash_groups(docs: DataFrame, words: int = 3, radius: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return (id, fp, component_id) for every row of ``docs``.

    component_id is the smallest id that the row reaches over links of at most
    ``radius`` differing bits. Null texts and texts without words have the
    fingerprint zero and are linked like any other; rows with equal ids or equal
    texts are rows of one class; rows whose id is null belong to a component but
    never name it (it is null where all ids are). An empty table gives no rows;
    further columns are ignored.
    """
    fps = cut_lineage(fingerprints(docs, words, seed, id_col, text_col))
    classes = cut_lineage(fps.groupBy("fp").agg(F.min("id").alias("low")))
    roots = components(near_links(classes, radius))
    placed = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lows = placed.groupBy("root").agg(F.min("low").alias("component_id"))
    named = placed.join(lows, "root").select("fp", "component_id")
    return fps.join(named, "fp").select("id", "fp", "component_id")


def one_per_group(docs: DataFrame, groups: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Return one row of ``docs`` for each of ``groups`` (id, component_id): that with the group's smallest id.

    Of rows that repeat this id the one with the smallest text hash stays. Rows
    whose id is null can't be named and stay.
    """
    row, names = others(docs, (), [text_col])
    rows = docs.select(row, F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    named = rows.join(groups.where("id = component_id").select("id").distinct(), "id", "left_semi")
    first = Window.partitionBy("id").orderBy(F.xxhash64("text"))  # rows of one id
    once = named.withColumn("nth", F.row_number().over(first)).where("nth = 1").drop("nth")
    return once.unionByName(rows.where("id IS NULL").select(*once.columns)).select(*given_back(names, {text_col: F.col("text")}))


def keep_one_per_group(docs: DataFrame, words: int = 5, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return one row of ``docs`` for each SimHash group (see ``one_per_group``)."""
    groups = simhash_groups(docs.where(F.col(id_col).isNotNull()), words, radius, 42, id_col, text_col)
    return one_per_group(docs, groups, id_col, text_col)


def op7_simhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash_groups(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
