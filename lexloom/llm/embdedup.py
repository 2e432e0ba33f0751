"""Embedding near-dedup: spherical k-means cells and blocked cosine products.

Equal vectors are one class. Each class belongs to the cell of its nearest
centre and may link with rows of another cell only if that one's centre is
nearly as near: if a pair at the threshold is split between two cells, each of
its vectors must be about as near to the other centre, since the two are at most
sqrt(2 - 2 t) apart. ``guard`` is the part of that exact bound which is used: at
1, the default, no pair can be lost. Neighbouring cells share a bin of a bounded
number of components, and large cells are dealt out over several. A row is sent
once to each pair of its own bin and one that holds a cell in its reach, so it
is copied at most once for each bin, and a task holds two bins. Tasks return each
class's number of links and a spanning forest, no pairs, and the forests join
into components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.common import cut_lineage, table
from lexloom.llm.components import components
from lexloom.llm.simhash import forest
from lexloom.llm.vectors import bounded_sample, k_means, matrix, unit, usable

#: Vectors that the centres are fitted on, at most.
SAMPLE = 8192
#: Numbers (of vectors, scores or marks) that a bin or a step of the routing holds, about; a task holds two bins.
BIN = 1 << 21
#: Rows of a bin, at most; small tables are dealt into about SPREAD bins, of LEAST rows or more.
BLOCK, SPREAD, LEAST = 32_768, 8, 1024
TILE = 1024


@dataclass
class Cells:
    """Centres, the bound between each two, and the bins: cell c is dealt over ``many[c]`` bins from ``first[c]`` on."""

    centres: np.ndarray
    margin: np.ndarray
    first: np.ndarray
    many: np.ndarray

    def reach(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Return each row's own cell and, for every cell, whether the row may link with rows of it."""
        score = x @ self.centres.T
        own = score.argmax(1)
        return own, score >= score[np.arange(len(own)), own][:, None] - self.margin[own] - 1e-9

    def near(self, x: np.ndarray, own: int, other: int) -> np.ndarray:
        """Return the places of the rows of ``x``, all of the cell ``own``, that may link with rows of the cell ``other``."""
        return np.flatnonzero(x @ (self.centres[other] - self.centres[own]) >= -self.margin[own, other] - 2e-9)


def dealt(rows: np.ndarray, most: int, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Deal cells of ``rows`` rows into bins of about ``most``: (first bin, number of bins) of each; cells that share one are neighbours."""
    first, many = np.zeros(len(rows), np.int64), np.maximum(1, -(-rows // most))
    left, at, bins, room = np.ones(len(rows), bool), 0, 0, -1
    while left.any():
        at = int(np.where(left, apart[at], np.inf).argmin())
        left[at] = False
        if many[at] > 1 or rows[at] > room:
            first[at], bins, room = bins, bins + many[at], most - rows[at]
        else:
            first[at], room = bins - 1, room - rows[at]
    return first, many


class Links:
    """Number of links and root of each of the unit vectors ``x`` of one task; each stands for ``weight`` rows."""

    def __init__(self, x: np.ndarray, weight: np.ndarray, threshold: float) -> None:
        self.x, self.weight, self.threshold = x, weight, threshold
        self.short = x.astype(np.float32)
        # Single precision moves a product of unit vectors by less than this.
        self.slack = 4 * (x.shape[1] + 8) * float(np.finfo(np.float32).eps)
        self.links, self.root = np.zeros(len(x), np.int64), np.arange(len(x))

    def compare(self, left: np.ndarray, right: np.ndarray | None = None) -> None:
        """Link the rows ``left`` with ``right`` (None: with one another, each pair once).

        Single precision only tells which pairs are looked at; products in double
        precision decide. These are rounded in an order that depends on the tile;
        those within 1e-12 of the threshold are summed again in one fixed order.
        """
        same = right is None
        right = left if same else right
        for i in range(0, len(left), TILE):
            a = left[i : i + TILE]
            for j in range(i if same else 0, len(right), TILE):
                b = right[j : j + TILE]
                p, q = np.nonzero(self.short[a] @ self.short[b].T >= self.threshold - self.slack)
                if same and i == j:
                    p, q = p[p < q], q[p < q]
                if not len(p):
                    continue
                value = (self.x[a] @ self.x[b].T)[p, q] if 64 * len(p) > len(a) * len(b) else (self.x[a[p]] * self.x[b[q]]).sum(1)
                edge = np.abs(value - self.threshold) < 1e-12
                value[edge] = (self.x[a[p[edge]]] * self.x[b[q[edge]]]).sum(1)
                p, q = p[value >= self.threshold], q[value >= self.threshold]
                self.links[a] += np.bincount(p, self.weight[b[q]], len(a)).astype(np.int64)
                self.links[b] += np.bincount(q, self.weight[a[p]], len(b)).astype(np.int64)
                p, q = a[p], b[q]
                apart = self.root[p] != self.root[q]
                if apart.any():
                    every = np.arange(len(self.x))
                    self.root = forest(len(every), np.concatenate([every, p[apart]]), np.concatenate([self.root, q[apart]]))


def of_length(classes: DataFrame, total: int, n: int, threshold: float, cells: int | None, guard: float) -> DataFrame:
    """Return, for classes of vectors of ``n`` components, rows of (low, _h, _g, links) and of forest edges (low, b)."""
    centres = k_means(unit(bounded_sample(classes, SAMPLE)), cells or min(4096, max(1, round(math.sqrt(total) / 8))), spherical=True)
    apart = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0))
    margin = guard * math.sqrt(2 - 2 * threshold) * apart
    spark = classes.sparkSession
    shared = spark.sparkContext.broadcast(Cells(centres, margin, *np.zeros((2, len(centres)), np.int64)))  # at most 4096 centres
    chunk = max(1, min(BLOCK, BIN // max(n, len(centres))))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = np.zeros(len(shared.value.centres), np.int64)
        for batch in batches:
            for lo in range(0, len(batch), chunk):
                own, _ = shared.value.reach(unit(matrix(batch.column(0).slice(lo, chunk))))
                many += np.bincount(own, minlength=len(many))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(many))), pa.array(many)], ["cell", "rows"])

    counts = classes.select("_vec").mapInArrow(count, "cell long, rows long").groupBy("cell").agg(F.sum("rows").alias("rows"))
    rows = np.zeros(len(centres), np.int64)
    for r in counts.collect():  # one row for each centre
        rows[r["cell"]] = r["rows"]
    first, many = dealt(rows, max(1, min(BLOCK, BIN // n, max(LEAST, total // SPREAD))), apart)
    bins = int((first + many).max())
    placed = spark.sparkContext.broadcast(Cells(centres, margin, first, many))
    step = max(1, min(chunk, BIN // bins))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Send each row to all pairs of bins where it may have links, in batches of bounded size."""
        names = ["_vec", "low", "many", "_h", "_g", "i", "j", "mine", "cell"]
        place = placed.value
        for whole in batches:
            for lo in range(0, len(whole), step):
                batch = whole.slice(lo, step)
                own, near = place.reach(unit(matrix(batch.column(0))))
                mine = place.first[own] + (np.asarray(batch.column(3)).astype(np.uint64) % place.many[own].astype(np.uint64)).astype(np.int64)
                at, cell = np.nonzero(near)
                met = np.zeros((len(batch), bins + 1), np.int32)
                np.add.at(met, (at, place.first[cell]), 1)
                np.add.at(met, (at, place.first[cell] + place.many[cell]), -1)
                at, other = np.nonzero(met.cumsum(1)[:, :-1])
                for k in range(0, len(at), chunk):
                    row, its = at[k : k + chunk], other[k : k + chunk]
                    extra = [np.minimum(mine[row], its), np.maximum(mine[row], its), mine[row], own[row]]
                    yield pa.RecordBatch.from_arrays([*batch.take(pa.array(row)).columns, *map(pa.array, extra)], names)

    def run(part: pa.Table) -> pa.Table:
        i, j = part["i"][0].as_py(), part["j"][0].as_py()
        part = part.sort_by([("mine", "ascending"), ("cell", "ascending")])
        low, mine, cell = (part[c].to_numpy() for c in ("low", "mine", "cell"))
        x = unit(matrix(part["_vec"]))
        found = Links(x, part["many"].to_numpy(), threshold)
        cuts = [0, *(np.flatnonzero((np.diff(cell) != 0) | (np.diff(mine) != 0)) + 1).tolist(), len(x)]
        runs = [(int(mine[a]), int(cell[a]), np.arange(a, b)) for a, b in pairwise(cuts)]
        for k, (p, c, left) in enumerate(runs):
            if i == j:
                found.compare(left)
            for q, d, right in runs[k + 1 :]:
                if i != j and p == q:
                    continue  # rows of one bin meet in its own task
                if c != d:
                    found.compare(left[placed.value.near(x[left], c, d)], right[placed.value.near(x[right], d, c)])
                else:
                    found.compare(left, right)
        some, moved = np.flatnonzero(found.links), np.flatnonzero(found.root != np.arange(len(x)))
        none = lambda k: pa.nulls(k, pa.int64())
        linked = [pa.array(low[some]), part["_h"].take(some).combine_chunks(), part["_g"].take(some).combine_chunks(), pa.array(found.links[some]), none(len(some))]
        joined = [pa.array(low[moved]), none(len(moved)), none(len(moved)), none(len(moved)), pa.array(low[found.root[moved]])]
        return pa.concat_tables([pa.table(dict(zip(["low", "_h", "_g", "links", "b"], c, strict=True))) for c in (linked, joined)])

    kind = classes.schema["_vec"].dataType.simpleString()
    schema = f"_vec {kind}, low long, many long, _h long, _g long, i long, j long, mine long, cell long"
    sent = classes.select("_vec", "low", "many", "_h", "_g").mapInArrow(route, schema)
    # Few bytes are much work here, so partitions are not merged by their size.
    pairs = sent.repartition(min(4096, bins * (bins + 1) // 2), "i", "j")
    return pairs.groupBy("i", "j").applyInArrow(run, "low long, _h long, _g long, links long, b long")


def near_vectors(vectors: DataFrame, threshold: float = 0.9, cells: int | None = None, guard: float = 1.0, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Return (id, n_links, component_id, kept) for every row of ``vectors``.

    Vectors that are null, empty, zero or hold null or non-finite components, and
    rows without an id, are linked with nothing: n_links is 0, their own id is
    the component, and they are kept if they have one. Only vectors of equal
    length are compared. Rows of equal vectors link with one another, also if
    they repeat an id; an id that several vectors have is one node of the
    components. An empty table gives no rows.
    """
    key = F.col(id_col).isNotNull() & usable(F.col(vec_col))
    both = {"_h": F.when(key, F.xxhash64(vec_col)), "_g": F.when(key, F.xxhash64(vec_col, F.lit(1)))}  # 128 bits name a vector
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("_vec"), *[v.alias(k) for k, v in both.items()])
    classes = rows.where("_h IS NOT NULL").groupBy("_vec", "_h", "_g").agg(F.min("id").alias("low"), F.count("*").alias("many"))
    classes = cut_lineage(classes)
    sizes = classes.groupBy(F.size("_vec").alias("n")).count().orderBy("n").collect()  # one row for each length
    found = None
    for n, count in sizes:
        part = of_length(classes.where(F.size("_vec") == n), count, n, threshold, cells, guard)
        found = part if found is None else found.unionByName(part)
    if found is None:
        known = classes.select("_h", "_g", F.lit(0).cast("long").alias("n_links"), F.col("low").alias("component_id"))
    else:
        found = cut_lineage(found)
        links = found.where("b IS NULL").groupBy("_h", "_g").agg(F.sum("links").alias("links"))
        roots = components(found.where("b IS NOT NULL").select(F.col("low").alias("a"), "b"))
        known = classes.drop("_vec").join(links, ["_h", "_g"], "left").join(roots, F.col("low") == F.col("node"), "left")
        known = known.select("_h", "_g", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"), F.coalesce("root", "low").alias("component_id"))
    out = rows.drop("_vec").join(known, ["_h", "_g"], "left")
    out = out.select("id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))


def op10_embedding_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Links, component and verdict of every vector."""
    return near_vectors(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
