"""Quality classifier: a factorisation machine over hashed words, structure and length.

Features of a text: each word position (hashed, weighing 1/n words) and one
active bin for each structure statistic (share of capitals, symbols, repeated
neighbours and so on) and for the length. The pairwise term is computed in linear
time as half of (sum of vectors) squared minus the sum of squared vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lexloom.llm.common import crc_fold, fitted, given_back, labelled_sample, others, spread, table
from lexloom.llm.textkernel import FOLDED, PLAIN, Words, blocks, texts_of, xxh64

BUCKETS = 1 << 14
FACTORS = 8
BINS = 16
#: The most labelled rows of each class that the classifier is fitted on.
SAMPLE = {0: 2500, 1: 4500}
STATS = ("words", "bytes", "word_length", "capitals", "symbols", "digits", "bars", "non_ascii", "closed_words", "lines", "repeat_1", "repeat_2", "repeat_4")


def _class(test: np.ndarray) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[test] = 1
    return out


CODES = np.arange(256)
LETTER = ((CODES | 32) >= 97) & ((CODES | 32) <= 122)
DIGIT = (CODES >= 48) & (CODES <= 57)
CLASSES = [_class((CODES >= 65) & (CODES <= 90)), _class((CODES > 32) & (CODES < 127) & ~LETTER & ~DIGIT), _class(DIGIT), _class(CODES == 124), _class(CODES >= 192)]


def describe(texts: list[bytes]) -> tuple[Words, np.ndarray, np.ndarray]:
    """Return the words, their buckets and the statistics (text x STATS) of ``texts``."""
    w = Words(texts, PLAIN)
    folded = FOLDED[w.buf]
    h = xxh64(folded, w.start, w.end, 0)
    counts, first = w.counts, w.first
    n = np.maximum(counts, 1)
    lo = np.where(counts > 0, np.append(w.start, 0)[np.minimum(first[:-1], len(w))], 0)
    hi = np.where(counts > 0, np.append(w.end, 0)[np.maximum(first[1:] - 1, 0)], 0)
    size = np.maximum(hi - lo - counts + 1, 1)
    shares = []
    for kind in CLASSES:
        total = np.concatenate([[0], np.cumsum(kind[w.buf], dtype=np.int64)])
        shares.append((total[hi] - total[lo]) / size)
    over = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[first]) / n
    last = w.buf[np.maximum(w.end - 1, 0)]
    owner = w.owner
    repeats = []
    for lags in ((1,), (1, 2), (1, 2, 3, 4)):
        same = np.zeros(len(w), bool)
        for lag in lags:
            same[lag:] |= (h[lag:] == h[:-lag]) & (owner[lag:] == owner[:-lag])
        repeats.append(over(same))
    lines = np.array([t.count(b"\n") for t in texts]) / n
    whole = np.array([len(t) for t in texts])
    stats = [np.log1p(counts), np.log1p(whole), size / n, *shares, over((CLASSES[1][last] > 0) if len(w) else np.zeros(0, bool)), lines, *repeats]
    return w, (h % np.uint64(BUCKETS)).astype(np.int64), np.stack(stats, 1)


@dataclass
class Machine:
    """w0 + sum w x + pairs <v, v'> x x' over BUCKETS word features and the bins of each statistic."""

    edges: np.ndarray
    w0: float
    w: np.ndarray
    v: np.ndarray

    def bins(self, stats: np.ndarray) -> np.ndarray:
        cols = [BUCKETS + k * (BINS + 1) + np.searchsorted(e, stats[:, k], side="right") for k, e in enumerate(self.edges)]
        return np.stack(cols, 1)

    def score(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros(len(texts))
        for lo, hi in blocks(texts):
            words, bucket, stats = describe(texts[lo:hi])
            n = np.maximum(words.counts, 1).astype(float)
            vec = np.concatenate([self.w[:, None], self.v, (self.v**2).sum(1, keepdims=True)], 1).astype(np.float32)
            sums = np.zeros((len(n), vec.shape[1]))
            full = words.counts > 0
            if full.any():
                sums[full] = np.add.reduceat(vec[bucket], words.first[:-1][full], axis=0, dtype=np.float64)
            b = self.bins(stats)
            s = sums[:, 1:-1] / n[:, None] + self.v[b].sum(1)
            q = sums[:, -1] / n**2 + (self.v[b] ** 2).sum((1, 2))
            z = self.w0 + sums[:, 0] / n + self.w[b].sum(1) + 0.5 * ((s**2).sum(1) - q)
            out[lo:hi] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return out


def fit(sample: list[tuple[str, int]], epochs: int = 6, rate: float = 0.1, decay: float = 1e-5, seed: int = 1) -> Machine:
    """Fit a machine to (text, 0 or 1) rows with Adagrad over small batches; no rows give a constant score of a half."""
    texts = [t.encode("utf-8", "surrogatepass") for t, _ in sample]
    y = np.array([v for _, v in sample], float)
    rng = np.random.default_rng(seed)
    size = BUCKETS + len(STATS) * (BINS + 1)
    if not texts:
        return Machine(np.zeros((len(STATS), BINS)), 0.0, np.zeros(size), np.zeros((size, FACTORS)))
    ids, xs, first, stats = [], [], [0], []
    for lo, hi in blocks(texts):
        words, bucket, s = describe(texts[lo:hi])
        stats.append(s)
        key, many = np.unique(words.owner * BUCKETS + bucket, return_counts=True)
        own = key // BUCKETS
        ids.append(key % BUCKETS)
        xs.append(np.stack([many / words.counts[own], many / words.counts[own].astype(float) ** 2], 1))
        first.extend((first[-1] + np.cumsum(np.bincount(own, minlength=hi - lo))).tolist())
    ids, xs, first, stats = np.concatenate(ids), np.concatenate(xs), np.array(first), np.concatenate(stats)
    edges = np.quantile(stats, np.linspace(0, 1, BINS + 1)[1:], axis=0).T
    model = Machine(edges, float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))), np.zeros(size), rng.normal(0, 0.05, (size, FACTORS)))
    bins = model.bins(stats)
    g_w, g_v = np.full(size, 1e-3), np.full((size, FACTORS), 1e-3)
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(len(y)), max(1, len(y) // 64)):
            many = first[at + 1] - first[at]
            pick = np.repeat(first[at] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
            own = np.concatenate([np.repeat(np.arange(len(at)), many), np.repeat(np.arange(len(at)), bins.shape[1])])
            idx = np.concatenate([ids[pick], bins[at].ravel()])
            x = np.concatenate([xs[pick, 0], np.ones(bins[at].size)])
            x2 = np.concatenate([xs[pick, 1], np.ones(bins[at].size)])  # of the positions that share a feature
            v = model.v[idx]
            s = np.stack([np.bincount(own, v[:, f] * x, len(at)) for f in range(FACTORS)], 1)
            q = np.bincount(own, (v**2).sum(1) * x2, len(at))
            z = model.w0 + np.bincount(own, model.w[idx] * x, len(at)) + 0.5 * ((s**2).sum(1) - q)
            g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[at]
            model.w0 -= rate * g.mean()
            uniq, inv = np.unique(idx, return_inverse=True)
            dw = np.bincount(inv, g[own] * x) + decay * model.w[uniq]
            part = g[own, None] * (s[own] * x[:, None] - v * x2[:, None])
            dv = np.stack([np.bincount(inv, part[:, f]) for f in range(FACTORS)], 1) + decay * model.v[uniq]
            g_w[uniq] += dw**2
            g_v[uniq] += dv**2
            model.w[uniq] -= rate * dw / np.sqrt(g_w[uniq])
            model.v[uniq] -= rate * dv / np.sqrt(g_v[uniq])
    return model


def score_quality(docs: DataFrame, model: Machine, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Return ``docs`` with ``score_col`` (0 to 1, higher: better) of its whole texts.

    Null texts count as empty, an empty text is scored by its statistics; a
    column that has the name ``score_col`` already is replaced. Equal texts get
    equal scores, in whatever rows they stand.
    """
    row, names = others(docs, [score_col], [text_col])
    slim = docs.select(row, F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of one size, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.score(texts_of(batch.column(1))))], ["row", "text", "score"])

    scored = spread(slim).mapInArrow(run, StructType([*slim.schema.fields, StructField("score", DoubleType())]))
    return scored.select(*given_back(names, {text_col: F.col("text")}), F.col("score").alias(score_col))


def fit_quality(docs: DataFrame, labels: DataFrame, most: dict[int, int] = SAMPLE) -> Machine:
    """Fit on a bounded sample (``most`` rows of each class) of the rows whose crc32(doc_id) mod 5 is not 0."""
    return fitted(labelled_sample(docs, labels, "quality", crc_fold("doc_id", 5) != 0, most), fit)


def op6_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Score, fold and class of every document."""
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    slim = docs.select("doc_id", F.coalesce(crc_fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "text")
    return score_quality(slim, model).select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
