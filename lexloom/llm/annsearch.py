"""Approximate nearest neighbours with an inverted multi-index.

The two halves of a vector are quantised apart, each by its own K centres, so
that a row's cell is a pair of centres. For a query the pairs are traversed in
order of the summed inner products of the halves with a heap (the multi-sequence
algorithm), until the cells passed hold enough rows; these are reranked by the
exact inner product. How many are enough is measured when the index is fitted:
the share of rows whose cells hold RECALL of the true neighbours of pilot queries
in the sample. So clustered vectors need few cells and isotropic ones many.

Equal vectors are one entry. Entries are sorted by cell once and stay where they
are: queries go to them in blocks of bounded size, with the sum at which their
traversal ended, and each task streams its entries and returns the best of each
query only. The shuffle is one of the entries and one of tasks times queries.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexloom.llm.common import cut_lineage, table
from lexloom.llm.vectors import bounded_sample, k_means, matrix, usable

#: Vectors that the index is fitted on, at most, and of these the pilot queries.
SAMPLE, PILOTS = 8192, 512
#: Of the pilot queries' true neighbours the part that the cells passed must hold.
RECALL = 0.95
#: Centres of a half, at most; queries that go to the entries at once; entries compared at once; entries of a task, about.
CENTRES, QUERIES, TILE, TASK_ROWS = 256, 4096, 512, 1 << 20


@dataclass
class MultiIndex:
    """Centres of both halves and, once they are counted, the entries of each pair."""

    first: np.ndarray
    second: np.ndarray
    counts: np.ndarray | None = None

    def cells(self, x: np.ndarray) -> np.ndarray:
        """Return the pair of centres (as one number) of each row."""
        h = self.first.shape[1]
        return self._near(x[:, :h], self.first) * len(self.second) + self._near(x[:, h:], self.second)

    @staticmethod
    def _near(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
        return np.argmax(x @ centres.T - 0.5 * (centres**2).sum(1), 1)

    def traverse(self, query: np.ndarray, wanted: int) -> tuple[np.ndarray, float]:
        """Return the pairs with the largest summed inner products that hold ``wanted`` entries together, and the last sum."""
        h = self.first.shape[1]
        one, two = self.first @ query[:h], self.second @ query[h:]
        a, b = np.argsort(-one, kind="stable").tolist(), np.argsort(-two, kind="stable").tolist()
        one, two = one[a].tolist(), two[b].tolist()
        width, counts = len(b), self.counts
        taken, found = [0] * len(a), []  # how many pairs of each row have been passed: a row is passed from its left
        heap = [(-(one[0] + two[0]), 0, 0)]
        held, last = 0, math.inf
        while heap and held < wanted:
            last, u, v = heapq.heappop(heap)
            cell = a[u] * width + b[v]
            found.append(cell)
            held += counts[cell]
            taken[u] = v + 1
            if v + 1 < width and (u == 0 or taken[u - 1] > v + 1):
                heapq.heappush(heap, (-(one[u] + two[v + 1]), u, v + 1))
            if u + 1 < len(a) and taken[u + 1] == v:
                heapq.heappush(heap, (-(one[u + 1] + two[v]), u + 1, v))
        return np.array(found, np.int64), -last

    def sums(self, queries: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Return for each query the summed inner products of each of ``cells``."""
        h, width = self.first.shape[1], len(self.second)
        return (queries[:, :h] @ self.first.T)[:, cells // width] + (queries[:, h:] @ self.second.T)[:, cells % width]

    def share(self, sample: np.ndarray, k: int, rows: int) -> float:
        """Return the share of entries that cells must hold for RECALL of the true neighbours of pilot queries.

        Among a sample the neighbours are taken that fall to it of each query's ``k`` among all ``rows``, one at least.
        """
        n = len(sample)
        pilots = np.arange(min(PILOTS, n))
        near = min(n - 1, max(1, round(k * n / rows)))
        if near < 1:
            return 1.0
        true = sample[pilots] @ sample.T
        true[pilots, pilots] = -np.inf
        best = np.argpartition(-true, near - 1, axis=1)[:, :near]
        sums = self.sums(sample[pilots], self.cells(sample))
        ahead = np.sort(-sums, axis=1)
        needed = [np.searchsorted(ahead[p], -sums[p, best[p]], side="right") / n for p in pilots]
        return float(np.quantile(np.concatenate(needed), RECALL))


def best_of(score: np.ndarray, q: np.ndarray, x: np.ndarray, low: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Return (query, entry, score) of the ``k`` best entries of each row of ``score`` (-inf: not a candidate).

    The scores are summed again in one fixed order; ties go to the smaller id.
    """
    if score.shape[1] > k:
        bar = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
        with np.errstate(invalid="ignore"):
            bar = np.where(np.isfinite(bar), bar - 1e-9 * (1 + np.abs(bar)), bar)
        at, entry = np.nonzero((score >= bar[:, None]) & (score > -np.inf))
    else:
        at, entry = np.nonzero(score > -np.inf)
    exact = (q[at] * x[entry]).sum(1)
    order = np.lexsort((low[entry], -exact, at))
    at, entry, exact = at[order], entry[order], exact[order]
    first = np.searchsorted(at, np.arange(len(score)))
    keep = np.arange(len(at)) - first[at] < k
    return at[keep], entry[keep], exact[keep]


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Return (query_id, rank, id, score): the ``k`` nearest rows found for each row whose id is divisible by ``every``.

    Nearness is the inner product in double precision; ties go to the smaller id.
    Vectors that are null, empty, zero or hold null or non-finite components,
    and rows without an id, take no part; only vectors of equal length are
    compared. Rows that repeat id and vector are one row. An empty table gives no
    rows. Other columns, whatever their names, are not looked at.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("_vec")).where(F.col("id").isNotNull() & usable(F.col("_vec")))
    rows = rows.withColumns({"_h": F.xxhash64("_vec"), "_g": F.xxhash64("_vec", F.lit(1))})  # 128 bits name a vector
    rows = cut_lineage(rows.groupBy("id", "_h", "_g").agg(F.first("_vec").alias("_vec")))
    # No query needs more than k rows (and itself) of one vector: the others have the same score and larger ids.
    nth = F.row_number().over(Window.partitionBy("_h", "_g").orderBy("id"))
    entries = rows.withColumn("_nth", nth).where(F.col("_nth") <= k + 1)
    entries = cut_lineage(entries.groupBy("_h", "_g").agg(F.first("_vec").alias("_vec"), F.sort_array(F.collect_list("id")).alias("ids")))
    asked = rows.where(F.col("id") % every == 0)
    out = None
    for n, count in entries.groupBy(F.size("_vec").alias("n")).count().orderBy("n").collect():  # in general one length
        part = of_length(entries.where(F.size("_vec") == n), asked.where(F.size("_vec") == n), n, count, k)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return asked.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), "id", F.lit(0.0).alias("score"))
    # The best rows of each asked vector, then those of each query but itself.
    each = out.select("_h", "_g", "score", F.explode("ids").alias("id"))
    by_vector = Window.partitionBy("_h", "_g").orderBy(F.desc("score"), "id")
    few = each.withColumn("_r", F.row_number().over(by_vector)).where(F.col("_r") <= k + 1).drop("_r")
    joined = asked.select(F.col("id").alias("query_id"), "_h", "_g").join(few, ["_h", "_g"]).where("id <> query_id")
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return joined.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def of_length(entries: DataFrame, asked: DataFrame, n: int, count: int, k: int) -> DataFrame:
    """Return (_h, _g, score, ids): for each asked vector the best entries found by each task."""
    context = entries.sparkSession.sparkContext
    sample = bounded_sample(entries, SAMPLE)
    centres = min(CENTRES, max(1, round(0.5 * math.sqrt(count))))
    index = MultiIndex(k_means(sample[:, : n // 2], centres, False) if n > 1 else np.zeros((1, 0)), k_means(sample[:, n // 2 :], centres, False))
    wanted = max(k + 1, math.ceil(index.share(sample, k, count) * count))
    bare = context.broadcast(index)  # at most CENTRES a half
    kind = entries.schema["_vec"].dataType.simpleString()

    def in_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bare.value.cells(matrix(batch.column(2))))], ["_h", "_g", "_vec", "ids", "cell"])

    tasks = max(context.defaultParallelism, -(-count // TASK_ROWS))
    placed = entries.select("_h", "_g", "_vec", "ids").mapInArrow(in_cells, f"_h long, _g long, _vec {kind}, ids array<long>, cell long")
    # Cells lie together, and a large one may lie in several tasks.
    placed = cut_lineage(placed.repartitionByRange(tasks, "cell", "_h").sortWithinPartitions("cell"))
    counts = np.zeros(len(index.first) * len(index.second), np.int64)
    for r in placed.groupBy("cell").count().collect():  # at most CENTRES squared
        counts[r["cell"]] = r["count"]
    shared = context.broadcast(MultiIndex(index.first, index.second, counts.tolist()))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            ends = [index.traverse(query, wanted)[1] for query in matrix(batch.column(2))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ends, pa.float64())], ["_h", "_g", "_vec", "least"])

    # By number, or adaptive execution would leave the few bytes of the queries to one task.
    queries = asked.groupBy("_h", "_g").agg(F.first("_vec").alias("_vec")).repartition(tasks, "_h", "_g")
    queries = cut_lineage(queries.mapInArrow(ask, f"_h long, _g long, _vec {kind}, least double"))
    blocks = -(-queries.count() // QUERIES)
    out = None
    for b in range(blocks):
        rows = queries.where(F.pmod("_h", F.lit(blocks)) == b).collect()  # about QUERIES rows
        block = context.broadcast(([r["_h"] for r in rows], [r["_g"] for r in rows], np.array([r["_vec"] for r in rows], np.float64).reshape(len(rows), n), np.array([r["least"] for r in rows])))
        part = placed.select("_vec", "ids", "cell").mapInArrow(searched(bare, block, k), "_h long, _g long, score double, ids array<long>")
        out = part if out is None else out.unionByName(part)
        if b % 16 == 15:  # keeps the plan short
            out = cut_lineage(out)
    return out if out is not None else placed.select("_h", "_g", F.lit(0.0).alias("score"), "ids").limit(0)


def searched(index, block, k: int):
    """Return the function that streams entries (_vec, ids, cell) past a block of queries and gives the best ``k`` + 1 of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, g, queries, least = block.value
        if not h:
            return
        slack = 1e-9 * (1 + np.abs(np.where(np.isfinite(least), least, 0)))
        best = pa.table({"who": pa.array([], pa.int64()), "low": pa.array([], pa.int64()), "score": pa.array([], pa.float64()), "ids": pa.array([], pa.list_(pa.int64()))})
        for batch in batches:
            x, ids, cell = matrix(batch.column(0)), batch.column(1), batch.column(2).to_numpy()
            low = np.asarray(ids.flatten())[np.asarray(ids.offsets)[:-1] - ids.offsets[0].as_py()]
            cells, place = np.unique(cell, return_inverse=True)
            passed = index.value.sums(queries, cells) >= (least - slack)[:, None]
            for at in range(0, len(x), TILE):
                some = place[at : at + TILE]
                here = passed[:, some]
                asking = np.flatnonzero(here.any(1))
                for lo in range(0, len(asking), TILE):
                    rows = asking[lo : lo + TILE]
                    score = np.where(here[rows], queries[rows] @ x[at : at + TILE].T, -np.inf)
                    who, entry, exact = best_of(score, queries[rows], x[at : at + TILE], low[at : at + TILE], k + 1)
                    part = {"who": rows[who], "low": low[at + entry], "score": exact, "ids": ids.take(pa.array(at + entry))}
                    best = pa.concat_tables([best, pa.table(part)])
                if len(best) > 4 * (k + 1) * len(h):
                    best = foremost(best, k + 1)
        best = foremost(best, k + 1)
        who = best["who"].to_numpy()
        if len(who):
            yield from pa.table({"_h": np.array(h, np.int64)[who], "_g": np.array(g, np.int64)[who], "score": best["score"], "ids": best["ids"]}).combine_chunks().to_batches(max_chunksize=10_000)

    return run


def foremost(found: pa.Table, k: int) -> pa.Table:
    """Return the ``k`` best rows of each query; ties go to the smaller id."""
    who, score, low = (found[c].to_numpy() for c in ("who", "score", "low"))
    order = np.lexsort((low, -score, who))
    first = np.searchsorted(who[order], who[order])
    return found.take(pa.array(order[np.arange(len(order)) - first < k]))


def op4_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    """The 20 nearest rows found for every twentieth vector."""
    found = nearest(table(spark, sf_dir, "embeddings"))
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
