"""Writing documents (each content once) and reading Word files."""

from __future__ import annotations

import io
import re
import zipfile
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.functions import text as T
from lexloom.functions import url as U
from lexloom.operators import dedup
from lexloom.session import cut_lineage, written

WORD_SPACE = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def prepared(docs: DataFrame) -> DataFrame:
    """Return ``docs`` (url, text) with doc_id, content_hash and words."""
    return docs.withColumns({"doc_id": U.doc_id("url"), "content_hash": T.content_hash("text"), "words": T.count_words("text")})


def save(docs: DataFrame, folder: str) -> None:
    """Write ``docs`` with each content once, and the others' ids as aliases beside them."""
    rows = prepared(docs).dropDuplicates(["doc_id"])
    dedup.deduplicated(rows).write.mode("overwrite").parquet(f"{folder}/documents")
    dedup.aliases(rows).write.mode("overwrite").parquet(f"{folder}/aliases")


def save_batches(stream: DataFrame, folder: str, checkpoint: str, prefix: int = 2):
    """Start a query that adds each batch's new contents to ``folder``; what is there already is left out.

    Beside the documents a table of their ids and content hashes is kept, in a
    folder for each beginning of the hash: a batch reads only the folders that its
    own documents fall into, and never the documents.
    """
    from pyspark.errors import AnalysisException

    keys = f"{folder}/keys"
    shard = lambda c: F.substring(F.sha2(F.col(c), 256), 1, prefix)

    def add(batch: DataFrame, _: int) -> None:
        # Texts are hashed once; what is new is told by ids and hashes alone, and the texts are read again where they are added.
        row = "_row"
        while row in batch.columns:
            row += "_"
        rows = written(prepared(batch).withColumn(row, F.monotonically_increasing_id()))
        once = rows.groupBy("doc_id").agg(F.min(F.struct(row, "content_hash")).alias("first")).select("doc_id", "first.*")
        lead = once.where("content_hash IS NOT NULL").groupBy("content_hash").agg(F.min("doc_id").alias("_lead"))
        new = cut_lineage(once.join(lead, "content_hash", "left").where("_lead IS NULL OR doc_id IS NULL OR doc_id = _lead").drop("_lead"))
        wanted = new.select(F.explode(F.array("doc_id", "content_hash")).alias("key")).where("key IS NOT NULL").withColumn("shard", shard("key"))
        try:
            here = [r[0] for r in wanted.select("shard").distinct().collect()]  # at most 16 to the power of prefix
            known = batch.sparkSession.read.schema("key string, shard string").parquet(keys).where(F.col("shard").isin(here)).select("key").distinct()
            new = new.join(known.withColumnRenamed("key", "doc_id"), "doc_id", "left_anti").join(known.withColumnRenamed("key", "content_hash"), "content_hash", "left_anti")
            new = cut_lineage(new)
        except AnalysisException as error:  # the first batch finds no table
            if "PATH_NOT_FOUND" not in str(error):
                raise
        rows.join(new.select(row), row, "left_semi").drop(row).write.mode("append").parquet(f"{folder}/documents")
        added = new.select(F.explode(F.array("doc_id", "content_hash")).alias("key")).where("key IS NOT NULL").withColumn("shard", shard("key"))
        # One file for each shard: every task would else write one into each.
        added.repartition("shard").write.mode("append").partitionBy("shard").parquet(keys)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)


def word_text(body: bytes) -> tuple[str | None, dict[str, str], str]:
    """Return (Markdown, core properties, status) of a Word file: ok, raw_only (too little text, or the old format) or not_word."""
    if body.startswith(bytes.fromhex("D0CF11E0A1B11AE1")):
        return None, {}, "raw_only"
    try:
        with zipfile.ZipFile(io.BytesIO(body)) as file:
            root = ET.fromstring(file.read("word/document.xml"))
            core = ET.fromstring(file.read("docProps/core.xml")) if "docProps/core.xml" in file.namelist() else None
    except (zipfile.BadZipFile, KeyError, ET.ParseError):
        return None, {}, "not_word"
    parts = []
    for paragraph in root.iter(f"{WORD_SPACE}p"):
        style = paragraph.find(f"{WORD_SPACE}pPr/{WORD_SPACE}pStyle")
        level = re.fullmatch(r"(?:Heading|Ttulo|Título)\s?(\d)", style.get(f"{WORD_SPACE}val", "")) if style is not None else None
        text = "".join(t.text or "" for t in paragraph.iter(f"{WORD_SPACE}t")).strip()
        if text:
            parts.append("#" * int(level[1]) + " " + text if level else text)
    properties = {e.tag.rpartition("}")[2]: e.text.strip() for e in (() if core is None else core) if e.text and e.text.strip()}
    text = "\n\n".join(parts)
    return (text, properties, "ok") if len(text.split()) >= 20 else (None, properties, "raw_only")


def word_files(files: DataFrame) -> DataFrame:
    """Return (path, text, properties, status) of Word files (path, content), as the binaryFile source reads them."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([(p, *word_text(bytes(c or b""))) for p, c in zip(batch["path"], batch["content"], strict=True)], columns=["path", "text", "properties", "status"])

    return files.select("path", "content").mapInPandas(run, "path string, text string, properties map<string, string>, status string")

