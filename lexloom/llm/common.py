"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.session import cut_lineage, reachable, spread, table, written

__all__ = ["WORD", "crc_fold", "cut_lineage", "fitted", "given_back", "labelled_sample", "others", "quoted", "spread", "table", "unused", "written"]

#: A word: bytes other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def unused(name: str, taken: Iterable[str]) -> str:
    """Return ``name`` with as many underscores after it as make it differ from all names that are taken."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name += "_"
    return name


def others(df: DataFrame, made: Iterable[str], apart: Iterable[str] = ()) -> tuple[Column, list[str]]:
    """Return all columns of ``df`` but those ``made`` and ``apart`` as one struct, and all names but those ``made``.

    Carried as one column, a caller's columns can't clash with an operator's own,
    whatever they are called; a column that has the name of a result is replaced.
    """
    new, own = {m.lower() for m in made}, {a.lower() for a in apart}
    kept = [c for c in df.columns if c.lower() not in new]
    return F.struct(F.lit(True).alias("_"), *[quoted(c).alias(f"c{k}") for k, c in enumerate(kept) if c.lower() not in own]).alias("row"), kept


def given_back(names: list[str], apart: dict[str, Column] | None = None) -> list[Column]:
    """Return the columns that :func:`others` packed (and those kept ``apart``) under their names."""
    apart = {k.lower(): v for k, v in (apart or {}).items()}
    return [(apart[c.lower()] if c.lower() in apart else F.col(f"row.c{k}")).alias(c) for k, c in enumerate(names)]


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def crc_fold(key: str, folds: int) -> Column:
    """Return crc32(key as text) mod ``folds``; null keys fall in fold null."""
    return F.crc32(F.col(key).cast("string")) % folds


#: Bytes of text of the sample of each class, and of one text in it, at most.
SAMPLE_BYTES, TEXT_BYTES = 24_000_000, 1_000_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, most: dict[int, int], most_bytes: int = SAMPLE_BYTES, text_bytes: int = TEXT_BYTES) -> DataFrame:
    """Return (doc_id, text, y) of a bounded sample of the labelled rows where ``train`` holds.

    ``most`` gives the largest number of rows for each label value; the rows
    with the smallest hash of their id are taken, so reruns agree. Labels that
    contradict each other count as 1; null labels and ids and labels of other
    values are left out. Of rows that repeat an id the smallest text counts, and a
    null text counts as empty. The texts of a class are ``most_bytes`` together at
    most (in the same order), and a text of over ``text_bytes`` teaches nothing,
    so that one task can hold the sample. Without labels it is empty.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & train).groupBy("doc_id").agg(F.max(label).alias("y"))
    chosen = None
    for value, rows in most.items():
        part = known.where(F.col("y") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.where(train).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")  # at most sum(most) rows
    once = texts.where(F.octet_length("text") <= text_bytes).groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").cast("int").alias("y"))
    so_far = F.sum(F.octet_length("text")).over(Window.partitionBy("y").orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    return once.withColumn("so_far", so_far).where(F.col("so_far") <= most_bytes).select("doc_id", "text", "y")


def fitted(sample: DataFrame, fit: Callable[[list[tuple[str, int]]], Any]) -> Any:
    """Return ``fit`` of the (text, y) of a bounded sample, in order of id; one task learns, and only the model comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [pair for batch in batches for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(rows))], pa.binary())], ["model"])

    reachable(sample.sparkSession)
    model = sample.repartition(1).sortWithinPartitions("doc_id", "text").select("text", "y").mapInArrow(run, "model binary").first()
    return fit([]) if model is None else pickle.loads(model[0])
