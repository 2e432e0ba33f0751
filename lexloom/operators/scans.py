"""Decisions on scanned documents: does a file need OCR, and by which engine."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions import text as T

#: Engines by name: (bytes, language) -> text. Register one to make it available.
ENGINES: dict[str, Callable[[bytes, str], str]] = {}


def triage(pages: DataFrame, least_chars: float = 120, image_share: float = 0.85, sample: int = 8) -> DataFrame:
    """Return a row for each document of ``pages`` (doc_id, page, text, image_ratio) with signals and ``needs_ocr``.

    Of longer documents ``sample`` evenly spaced pages are judged.
    """
    whole = Window.partitionBy("doc_id")
    rows = pages.withColumns({"_n": F.count("*").over(whole), "_k": F.row_number().over(whole.orderBy("page")) - 1})
    spots = F.transform(F.sequence(F.lit(0), F.lit(sample - 1)), lambda i: F.rint(i * (F.col("_n") - 1) / (sample - 1)).cast("int"))
    rows = rows.where((F.col("_n") <= sample) | F.array_contains(spots, F.col("_k")))
    ratio = T.page_wordy_ratio("text")
    sums = rows.groupBy("doc_id").agg(
        F.max("_n").alias("pages"), F.avg(F.length(F.btrim("text", F.lit(" \n\t\r")))).alias("avg_chars"), F.avg(F.least("image_ratio", F.lit(1.0))).alias("avg_image_ratio"),
        F.count_if(F.length(F.btrim("text", F.lit(" \n\t\r"))) < 20).alias("without_text"), F.count("*").alias("sampled"),
        F.sort_array(F.collect_list(ratio)).alias("wordy"),
    )
    bad = F.when(F.size("wordy") > 0, F.size(F.filter("wordy", lambda r: r < 0.45)) / F.size("wordy")).otherwise(0.0)
    sums = sums.withColumns({"bad_text_ratio": bad, "median_wordy": F.when(F.size("wordy") > 0, F.get("wordy", F.floor(F.size("wordy") / 2).cast("int"))).otherwise(1.0)})
    reason = (
        F.when((F.col("avg_chars") < least_chars) & (F.col("avg_image_ratio") > 0.5), "little text, many images")
        .when(F.col("without_text") / F.col("sampled") > 0.5, "pages without text")
        .when((F.col("avg_image_ratio") > image_share) & (F.col("avg_chars") < 3 * least_chars), "page images")
        .when(F.col("bad_text_ratio") > 0.5, "corrupt text layer")
    )
    note = F.when(F.col("bad_text_ratio") > 0.15, "some noisy pages").otherwise("enough text")
    return sums.withColumns({"needs_ocr": reason.isNotNull(), "reason": F.coalesce(reason, note)}).drop("wordy")


def engine(image_ratio: Column, bad_text_ratio: Column, avg_chars: Column) -> Column:
    """Return the vision engine for degraded pages, else the light one; missing signals count as good."""
    degraded = (F.coalesce(image_ratio, F.lit(0.0)) > 0.5) | (F.coalesce(bad_text_ratio, F.lit(0.0)) > 0.5) | (F.coalesce(avg_chars, F.lit(999.0)) < 50)
    return F.when(degraded, "paddle_vl").otherwise("rapidocr")


def hints(pages: Column, image_ratio: Column) -> Column:
    """Return what to try on a queued file, as short names."""
    small = F.coalesce(pages, F.lit(0)) <= 30
    tips = F.when(small, F.array(F.lit("ocrmypdf"), F.lit("vision_model"))).otherwise(F.array(F.lit("batch_workers"), F.lit("managed_service")))
    return F.when(F.coalesce(image_ratio, F.lit(0.0)) > 0.9, F.concat(tips, F.array(F.lit("check_orientation")))).otherwise(tips)


def work_queue(queue: DataFrame, lang: str = "spa") -> DataFrame:
    """Return (doc_id, text, error) for rows of (doc_id, body, engine); failures stay queued with their error."""
    engines = dict(ENGINES)  # as registered here: the tasks have registries of their own

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples():
                try:
                    out.append((row.doc_id, engines[row.engine](bytes(row.body), lang), None))
                except Exception as error:  # whatever an engine raises belongs to its row
                    out.append((row.doc_id, None, f"{type(error).__name__}: {error}"))
            yield pd.DataFrame(out, columns=["doc_id", "text", "error"])

    return queue.select("doc_id", "body", "engine").mapInPandas(run, "doc_id string, text string, error string")


def is_pdf(content_type: Column, body: Column) -> Column:
    return F.coalesce(F.lower(content_type).contains("application/pdf"), F.lit(False)) | F.coalesce(F.substring(body, 1, 5) == F.lit(b"%PDF-"), F.lit(False))


def is_word(content_type: Column, body: Column, url: Column) -> Column:
    ole, zipped = F.lit(bytes.fromhex("D0CF11E0A1B11AE1")), F.lit(b"PK\x03\x04")
    typed = F.coalesce(F.lower(content_type).rlike("msword|wordprocessingml"), F.lit(False))
    return typed | F.coalesce(F.substring(body, 1, 8) == ole, F.lit(False)) | (F.coalesce(F.substring(body, 1, 4) == zipped, F.lit(False)) & F.coalesce(F.lower(url).contains(".docx"), F.lit(False)))
