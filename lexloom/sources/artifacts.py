"""What a run leaves beside its documents: analyses by kind, progress, the OCR queue's results, and an API's answers."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions import url as U
from lexloom.operators import report, scans
from lexloom.session import cut_lineage

# Kinds of analyses.
KINDS = ("pagemap", "plan", "sections", "provenance")


def analyses(rows: DataFrame, kind: str, url: Column | str = "url") -> DataFrame:
    """Return (doc_id, kind, body) of analyses: everything in a row of ``rows`` as one JSON document, named by its URL."""
    if kind not in KINDS:
        raise ValueError(f"unknown kind of analysis: {kind}")
    return rows.select(U.doc_id(url).alias("doc_id"), F.lit(kind).alias("kind"), F.to_json(F.struct(*[F.col(c) for c in rows.columns])).alias("body"))


def save_analyses(rows: DataFrame, folder: str) -> None:
    """Add analyses to a Parquet table with a folder for each kind; of a document's analyses of one kind the last written counts."""
    rows.withColumn("written", F.current_timestamp()).write.mode("append").partitionBy("kind").parquet(folder)


def read_analyses(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """Return (doc_id, body), one for each document; only the folder of ``kind`` is read."""
    rows = spark.read.parquet(folder).where(F.col("kind") == kind)
    return rows.groupBy("doc_id").agg(F.max_by("body", "written").alias("body"))


def listing_summary(maps: DataFrame) -> DataFrame:
    """Return (url, n_items, pagination_js_only) of the pages that are listings."""
    return maps.where("page_kind = 'listing'").select("url", F.size("listing_items").alias("n_items"), "pagination_js_only")


def corpus_report(docs: DataFrame, maps: DataFrame, columns: list[str], path: str) -> dict:
    """Write the corpus's report as one JSON document and return it: totals, counts by column, kinds of pages, listings.

    Counts have one row for each value and are small; the listings and documents
    themselves stay in tables beside it.
    """
    counts = report.corpus_counts(docs, columns).collect()
    kinds = {r["page_kind"]: r["n"] for r in maps.groupBy("page_kind").agg(F.count("*").alias("n")).collect()}
    out = {"totals": {"documents": 0, "words": 0, "pages_analyzed": sum(kinds.values())}, "page_kinds_seen": kinds}
    for r in counts:
        if r["dimension"] == "total":
            out["totals"] |= {"documents": r["docs"], "words": r["words"]}
        else:
            out.setdefault(f"by_{r['dimension']}", {})[r["value"]] = r["docs"]
    for name in [f"by_{c}" for c in columns]:
        out[name] = dict(sorted(out.get(name, {}).items(), key=lambda kv: (-kv[1], kv[0])))
    listing_summary(maps).write.mode("overwrite").json(f"{path}/listings")
    spark = docs.sparkSession
    spark.createDataFrame([(json.dumps(out, ensure_ascii=False),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/report")
    return out


def mark_done(spark: SparkSession, domains: DataFrame, folder: str) -> None:
    """Add finished domains (domain) to the progress table; each run's part is written whole or not at all."""
    domains.select("domain").distinct().sort("domain").coalesce(1).write.mode("append").parquet(folder)  # one short name for each domain


def done(spark: SparkSession, folder: str) -> DataFrame:
    """Return the finished domains, each once; none where nothing has been written."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(folder).select("domain").distinct()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], "domain string")


def processed_queue(queue: DataFrame, docs: DataFrame, lang: str = "spa") -> tuple[DataFrame, DataFrame]:
    """Return (docs, queue) after the queue's engines ran once: texts that were read replace the old, failures stay queued with their error.

    ``queue``: doc_id, body, engine; ``docs``: doc_id, text and more. An empty
    result of an engine is a failure. The engines' results are written once,
    since both tables need them.
    """
    ran = cut_lineage(scans.work_queue(queue, lang))
    read = ran.where("error IS NULL AND length(trim(text)) > 0").select("doc_id", F.col("text").alias("_read"))
    fresh = docs.join(read, "doc_id", "left").withColumns({"text": F.coalesce("_read", "text"), "ocr_status": F.when(F.col("_read").isNotNull(), "done").otherwise("pending")}).drop("_read")
    errors = ran.select("doc_id", F.coalesce("error", F.lit("empty result")).alias("error"))
    left = queue.join(read.select("doc_id"), "doc_id", "left_anti").join(errors, "doc_id", "left")
    return fresh, left


def api_results(pages: DataFrame, ask: Callable[[str, int], str], size: int = 25) -> DataFrame:
    """Return (query, ext_source, ext_id, title, open_access, has_pdf) of a literature API's answers to ``pages`` (query).

    ``ask`` (query, size) gives the answer as JSON text; it runs once for each
    query, in the tasks. Flags are ``Y`` or ``N`` there.
    """
    call = F.udf(lambda q: ask(q, size), "string")
    item = "array<struct<source: string, id: string, title: string, isOpenAccess: string, hasPDF: string>>"
    answer = F.from_json(call("query"), f"resultList struct<result: {item}>")
    rows = pages.select("query", F.explode(answer["resultList"]["result"]).alias("r"))
    return rows.select("query", F.col("r.source").alias("ext_source"), F.col("r.id").alias("ext_id"), F.btrim("r.title", F.lit(" .")).alias("title"), (F.col("r.isOpenAccess") == "Y").alias("open_access"), (F.col("r.hasPDF") == "Y").alias("has_pdf"))
