"""Helpers for operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Return whether a vector is not null, not empty, without null or non-finite components and not zero."""
    limit = F.lit(float("inf"))
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
    return F.coalesce((F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Return a column of equally long vectors as a matrix of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def unit(x: np.ndarray) -> np.ndarray:
    """Return the rows of ``x`` at length one (scaled first, so that no square overflows)."""
    x = x / np.maximum(np.abs(x).max(1, keepdims=True), np.finfo(float).tiny)
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), np.finfo(float).tiny)


def bounded_sample(vectors: DataFrame, most: int) -> np.ndarray:
    """Return at most ``most`` of ``vectors`` (the column _vec), those of the smallest hash."""
    rows = vectors.select("_vec").orderBy(F.xxhash64("_vec")).limit(most).collect()
    return np.array([r[0] for r in rows], np.float64)


def k_means(x: np.ndarray, k: int, spherical: bool, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """Return ``k`` centres (at most one for each row) of the rows of ``x``; spherical: unit vectors by largest cosine."""
    rng = np.random.default_rng(seed)
    x = np.unique(x, axis=0)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = np.argmax(x @ centres.T - (0 if spherical else 0.5 * (centres**2).sum(1)), 1)
        count = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        empty = count == 0
        sums[empty], count[empty] = x[rng.choice(len(x), int(empty.sum()))], 1
        centres = unit(sums) if spherical else sums / count[:, None]
    return centres
