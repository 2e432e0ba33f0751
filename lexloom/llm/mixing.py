"""Mixing sources to target weights, with DataFrame functions only.

Each source gets a share of all words by weight, at most ``cap`` times its own
words; what is above is shared again among the others. Documents get a random key
(the MD5 of their id) and are sorted by it within their source: a key's range
decides its bucket, bucket totals give each bucket's offset, and running sums
within a bucket give each document's interval of words. A source's budget is cut
exactly there, after whole epochs over the source where the budget is larger.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.llm.common import WORD, cut_lineage, given_back, others, table

WEIGHTS = (1, 2, 3)
CAP = 3
#: Splits before each word but the first, so that joined pieces are a text's exact beginning.
BEFORE_WORD = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"


def sizes(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Return ``docs`` with ``_size`` (which replaces a column of that name): the words of the text, 0 where it is null."""
    return docs.withColumn("_size", F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long"))


def keyed(sized: DataFrame, row: Column, buckets: int, id_col: str, source_col: str) -> DataFrame:
    """Return the row, id and size of each document with its source, its random key and the key's bucket."""
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    fraction = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    named = {"_none": F.col(source_col).isNull(), "_source": F.coalesce(source_col, F.lit("")), "_key": key, "_bucket": F.shiftright(fraction * F.lit(buckets), 32)}
    return sized.select(row, F.col(id_col).alias("_id"), "_size", *[v.alias(k) for k, v in named.items()])


def targets(totals: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Return ``totals`` (_none, _source, _total: one row for each source) with _target.

    Filling up: sources are taken in order of the level at which they reach
    their cap, and the final level is the largest that any of them sees.
    """
    cycle = F.array(*[F.lit(w).cast("long") for w in weights])
    rank = F.row_number().over(Window.orderBy("_none", "_source")) - 1
    ranked = totals.withColumn("_weight", F.get(cycle, F.pmod(rank, F.lit(len(weights)))))
    by_level = Window.orderBy(F.col("_total") / F.col("_weight"), "_none", "_source")
    before, all_rows = by_level.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (F.sum("_total").over(all_rows) - cap * F.coalesce(F.sum("_total").over(before), F.lit(0))) / (F.sum("_weight").over(all_rows) - F.coalesce(F.sum("_weight").over(before), F.lit(0)))
    seen = ranked.withColumn("_level", level).withColumn("_level", F.max("_level").over(all_rows))
    return seen.withColumn("_target", F.least((cap * F.col("_total")).cast("double"), F.col("_weight") * F.col("_level"))).select("_none", "_source", "_total", "_target")


def mix(sized: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, buckets: int | None = None, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """Return ``sized`` (of :func:`sizes`) with _source_size, _target and _taken, the words that the mix takes of each row.

    Null ids share one key; rows of equal keys are in order of id and size; rows
    equal in all of these are interchangeable. A null source is a source of its
    own. Empty texts take nothing, and an empty table gives no rows. The bucket
    count grows with the root of the rows, so that neither a source's buckets
    nor a bucket's rows are many for one task; the sources' own table, one row
    for each, is sorted in one task. Columns of ``sized`` that have the names of
    the results are replaced; all others stay.
    """
    made = ("_source_size", "_target", "_taken")
    row, names = others(sized, made)
    if buckets is None:
        buckets = 1 << max(8, min(20, math.ceil(math.log2(max(2, sized.count())) / 2)))
    rows = keyed(sized, row, buckets, id_col, source_col)
    per_bucket = rows.groupBy("_none", "_source", "_bucket").agg(F.sum("_size").alias("_words"))
    per_source = per_bucket.groupBy("_none", "_source").agg(F.sum("_words").alias("_total"))
    within = Window.partitionBy("_none", "_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.withColumn("_offset", F.coalesce(F.sum("_words").over(within), F.lit(0)))
    plan = offsets.drop("_words").join(targets(per_source, weights, cap), ["_none", "_source"])
    in_bucket = Window.partitionBy("_none", "_source", "_bucket").orderBy("_key", "_id", "_size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_begin", F.coalesce(F.sum("_size").over(in_bucket), F.lit(0))).join(plan, ["_none", "_source", "_bucket"])
    budget = F.floor(F.col("_target") + 0.5)
    whole = F.when(F.col("_total") > 0, F.floor(budget / F.col("_total"))).otherwise(0)
    left = budget - whole * F.col("_total") - F.col("_offset") - F.col("_begin")
    taken = F.col("_size") * whole + F.greatest(F.lit(0), F.least(F.col("_size"), left))
    return placed.select(*given_back(names), F.col("_total").alias("_source_size"), "_target", taken.cast("long").alias("_taken"))


def mixed_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, cap: int = CAP, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Return the mix itself: each row of ``docs`` as often as it is taken.

    Where the budget ends within a document, its last copy is cut after the
    words taken (and n_chars, if there is such a column, is counted anew). Null
    and empty texts are never taken; rows with null or repeated ids are rows of
    their own; texts of any length are whole but for that last cut.
    """
    row, names = others(docs, (), [text_col])
    slim = docs.select(row, F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    rows = mix(sizes(slim), weights, cap, None, "id", "source").where("_taken > 0")
    rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.ceil(F.col("_taken") / F.col("_size")).cast("int"))))
    here = F.least(F.col("_size"), F.col("_taken") - (F.col("_copy") - 1) * F.col("_size"))
    begin = F.array_join(F.slice(F.split("text", BEFORE_WORD), 1, here.cast("int")), "")
    rows = rows.withColumn("text", F.when(here == F.col("_size"), F.col("text")).otherwise(begin))
    out = rows.select(*given_back(names, {text_col: F.col("text")}))
    return out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    slim = sizes(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text")
    mixed = mix(cut_lineage(slim))
    return mixed.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.col("_taken").alias("taken"))


OP3_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS total, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, (sum(total) OVER () - 3 * coalesce(sum(total) OVER before, 0))::BIGINT
            / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::BIGINT AS level
  FROM totals
  WINDOW before AS (ORDER BY total / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), planned AS (
  SELECT source, total, least((3 * total)::DOUBLE, weight * max(level) OVER ()) AS target FROM levels
), placed AS (
  SELECT s.*, p.total, p.target, floor(p.target + 0.5)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, total AS source_size, target,
       CASE WHEN total = 0 THEN 0 ELSE size * (budget // total) + greatest(0, least(size, budget % total - start)) END::BIGINT AS taken
FROM placed
"""
