"""Inventories and statistics from the logs of other tools."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.functions import url as U

# How a spider's log names a URL, and what a run's log says, in the order it is tried.
SPIDER_LINE = r"URL:\s*(\S+)\s+(?:(\d{3})\b|\[\d+(?:/\d+)?\])"
RUN_EVENTS = [
    ("PageMap", "pages_analysed"), ("Escalando a render dinámico", "rendered"), ("Guardado", "saved"), ("Sin contenido sustantivo", "without_text"), ("robots.txt prohíbe", "robots"),
    ("requiere OCR", "ocr_queued"), ("demasiado grande", "too_large"), ("Portadilla descartada", "hubs"), ("Fallo de red", "failures"), ("falló", "failures"), ("marcado como bloqueado", "blocked"),
]


def spider_urls(lines: DataFrame, host: str | None = None) -> DataFrame:
    """Return (url) of the lines (value) of a spider's log that were found (2xx, or with a size), each once."""
    rows = lines.select(F.regexp_extract("value", SPIDER_LINE, 1).alias("url"), F.regexp_extract("value", SPIDER_LINE, 2).alias("status"))
    rows = rows.where((F.col("url") != "") & ((F.col("status") == "") | F.col("status").startswith("2")))
    return (rows.where(U.bare_host("url") == host) if host else rows).select("url").distinct()


def run_events(lines: DataFrame) -> DataFrame:
    """Return (event, n) of the lines (value) of a run's log; the first event that fits a line counts."""
    event = None
    for mark, name in RUN_EVENTS:
        fits = F.lower("value").contains(mark.lower()) if mark == "falló" else F.col("value").contains(mark)
        event = F.when(fits, name) if event is None else event.when(fits, name)
    return lines.select(event.alias("event")).where("event IS NOT NULL").groupBy("event").agg(F.count("*").alias("n"))


def run_kinds(lines: DataFrame) -> DataFrame:
    rows = lines.where(F.col("value").contains("PageMap")).select(F.regexp_extract("value", r"kind=(\w+)", 1).alias("page_kind")).where("page_kind <> ''")
    return rows.groupBy("page_kind").agg(F.count("*").alias("n"))


def run_seconds(lines: DataFrame) -> DataFrame:
    """Return the seconds between the first and the last time of day of the lines (pos, value), across midnight."""
    clock = F.regexp_extract("value", r"^(\d{2}):(\d{2}):(\d{2})", 0)
    timed = lines.where(clock != "").select("pos", (F.substring(clock, 1, 2).cast("int") * 3600 + F.substring(clock, 4, 2).cast("int") * 60 + F.substring(clock, 7, 2).cast("int")).alias("s"))
    return timed.agg(F.pmod(F.max_by("s", "pos") - F.min_by("s", "pos"), F.lit(86_400)).alias("seconds"))


def run_sections(lines: DataFrame) -> DataFrame:
    """Return (section, documents) of the lines that say how many documents a section gave."""
    part = lambda k: F.regexp_extract("value", r"Sección '([^']+)': (\d+) doc", k)
    return lines.where(part(1) != "").select(part(1).alias("section"), part(2).cast("int").alias("documents"))
