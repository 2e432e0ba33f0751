"""Line dedup with content-defined chunks, with DataFrame functions only.

A text's lines are hashed, and a rolling hash over neighbouring line hashes
decides where a chunk ends, so that the same lines are cut in the same way
wherever they stand. A chunk of two lines or more that an earlier place holds as
well is removed there, after the chunks themselves (not only their hashes) have
been compared; the first place, by document id, keeps it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.llm.common import cut_lineage, given_back, others, table

BASE, MODULUS = 1_000_003, 2_147_483_647
#: Of rolling hashes, one in so many is a candidate for a boundary.
SPREAD = 2


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once for ``body`` (a lambda's argument isn't computed again for each use)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def ends(hashes: Column, spread: int) -> Column:
    """Return the numbers of the lines that end a chunk.

    One ends where the rolling hash of two lines is a candidate and that of the
    line before is not; the last line ends one always.
    """

    def candidate(i: Column) -> Column:
        before, here = F.coalesce(F.get(hashes, i - 2), F.lit(0)), F.get(hashes, i - 1)
        return F.coalesce(((before * BASE) % MODULUS + here) % MODULUS % spread == 0, F.lit(False))

    return F.filter(F.sequence(F.lit(1), F.size(hashes)), lambda i: (i == F.size(hashes)) | (candidate(i) & ~candidate(i - 1)))


def chunks(lines: Column, spread: int) -> Column:
    """Return the chunks of ``lines``: an array of structs of the first and the last line's number."""

    def pairs(last: Column) -> Column:
        return F.transform(last, lambda e, k: F.struct((F.coalesce(F.get(last, k - 1), F.lit(0)) + 1).alias("first"), e.alias("last")))

    return let(F.transform(lines, line_hash), lambda h: let(ends(h, spread), pairs))


def line_dedup(docs: DataFrame, spread: int = SPREAD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return ``docs`` with text_col deduplicated and _lines, _chunks, _removed_chunks, _removed_lines.

    Null texts stay null and have no lines; an empty text is one empty line. Rows
    of equal id and text are one document read twice: they get the same result
    and do not repeat one another. Null ids come after all others; rows of equal
    id come in order of a hash of the text. Lines end with a newline (not
removed lines are joined by one), and an empty table gives no rows. Columns
    of ``docs`` that have the names of the counts are replaced; all others stay.
    """
    made = ("_lines", "_chunks", "_removed_chunks", "_removed_lines")
    row, names = others(docs, made, [text_col])
    split = F.split("text", "\n")
    base = docs.select(row, F.col(text_col).alias("text"), F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1)).alias("_id"), F.xxhash64(text_col).alias("_th"))

    def texts(lines: Column) -> Column:
        cut = lambda c: F.array_join(F.slice(lines, c["first"], c["last"] - c["first"] + 1), "\n")
        whole = F.transform(chunks(lines, spread), lambda c, k: F.struct(k.alias("k"), (c["last"] > c["first"]).alias("many"), cut(c).alias("chunk")))
        return F.filter(whole, lambda c: c["many"])

    rows = base.where(F.col("text").contains("\n")).select("_id", "_th", F.explode(let(split, texts)).alias("c"))
    rows = rows.select("_id", "_th", F.col("c.k").alias("_k"), F.col("c.chunk").alias("_chunk")).withColumn("_h", F.xxhash64("_chunk"))
    spans = [f(c).alias(f"{n}{c}") for c in ("_id", "_th", "_k") for n, f in (("lo", F.min), ("hi", F.max))]
    # What is counted by a key is cut off before it is joined on that key: only then can a frequent chunk's rows be split.
    repeated = cut_lineage(rows.groupBy("_h").agg(*spans).where("lo_id < hi_id OR lo_th < hi_th OR lo_k < hi_k").select("_h"))
    maybe = rows.join(repeated, "_h", "left_semi")
    firsts = maybe.groupBy("_h", "_chunk").agg(F.min(F.struct("_id", "_th", "_k")).alias("_first"))
    later = maybe.join(firsts, ["_h", "_chunk"]).where(F.struct("_id", "_th", "_k") != F.col("_first"))  # equal hashes and equal bytes
    drop = later.groupBy("_id", "_th").agg(F.collect_set("_k").alias("_drop"))
    joined = base.join(drop, ["_id", "_th"], "left")

    def rebuilt(lines: Column) -> Column:
        def result(all_chunks: Column) -> Column:
            # By hash, so that a text of many chunks is not searched once for each.
            stay = F.array_except(F.sequence(F.lit(0), F.size(all_chunks) - 1), "_drop")
            kept = F.transform(stay, lambda k: F.get(all_chunks, k))
            left = F.aggregate(kept, F.lit(0), lambda a, c: a + c["last"] - c["first"] + 1)
            text = F.array_join(F.flatten(F.transform(kept, lambda c: F.slice(lines, c["first"], c["last"] - c["first"] + 1))), "\n")
            return F.struct(text.alias("text"), F.size(lines).alias("lines"), F.size(all_chunks).alias("chunks"), (F.size(all_chunks) - F.size(kept)).alias("gone"), (F.size(lines) - left).alias("removed"))

        return let(chunks(lines, spread), result)

    out = joined.withColumn("_drop", F.coalesce("_drop", F.array().cast("array<int>"))).withColumn("_r", F.when(F.col("text").isNotNull(), let(split, rebuilt)))
    counted = [F.coalesce(F.col(f"_r.{old}"), F.lit(0)).alias(new) for new, old in zip(made, ("lines", "chunks", "gone", "removed"), strict=True)]
    text = F.when(F.size("_drop") == 0, F.col("text")).otherwise(F.col("_r.text"))
    return out.select(*given_back(names, {text_col: text}), *counted)


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Kept text and counts of every document."""
    found = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.col("_lines").alias("n_lines"), F.col("_chunks").alias("n_chunks"), F.col("_removed_chunks").alias("n_removed_chunks"), F.col("_removed_lines").alias("n_removed_lines"), F.col("text").alias("kept_text"))


OP1_SQL = r"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i
  FROM (SELECT DISTINCT doc_id, text FROM documents)
), hashed AS (
  SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM lines
), rolled AS (
  SELECT *, ((coalesce(lag(h) OVER w, 0) * 1000003) % 2147483647 + h) % 2147483647 % 2 = 0 AS hit
  FROM hashed WINDOW w AS (PARTITION BY doc_id, text ORDER BY i)
), cuts AS (
  SELECT *, (hit AND NOT coalesce(lag(hit) OVER w, false))::INT AS cut FROM rolled WINDOW w AS (PARTITION BY doc_id, text ORDER BY i)
), numbered AS (
  SELECT *, coalesce(sum(cut) OVER (PARTITION BY doc_id, text ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM cuts
), chunked AS (
  SELECT doc_id, text, k, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) AS n FROM numbered GROUP BY doc_id, text, k
), judged AS (
  SELECT *, n > 1 AND row_number() OVER (PARTITION BY chunk ORDER BY doc_id, k) > 1 AS gone FROM chunked
)
SELECT doc_id, sum(n)::INT AS n_lines, count(*)::INT AS n_chunks, count(*) FILTER (gone)::INT AS n_removed_chunks,
       coalesce(sum(n) FILTER (gone), 0)::INT AS n_removed_lines, coalesce(string_agg(chunk, chr(10) ORDER BY k) FILTER (NOT gone), '') AS kept_text
FROM judged GROUP BY doc_id, text
"""
