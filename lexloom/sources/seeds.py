"""Seeds from text, CSV and lists of links, with the context that stands beside each URL."""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Headers of the column of URLs, and words of a comment that restricts use.
URL_HEADERS = ("url", "link", "enlace")
RESTRICTION = r"(?i)prohíben|prohiben|ninguna porción|todos los derechos reservados|no se puede reproducir"
URL_PATTERN = r"https?://[^\s<>|,;]+"
DOMAIN_PATTERN = r"(?i)\b((?:[a-z0-9-]+\.)+[a-z]{2,}(?:/[^\s<>|,;]*)?)"


def _content(spark: SparkSession, path: str) -> str:
    row = spark.read.text(path, wholetext=True).first()
    return (row[0] if row else "").removeprefix("﻿")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Return (pos, url, context) of a seed file; of a URL that is repeated the first row counts.

    A text file has a URL on each line and comments after ``#``. A CSV file names
    the column of URLs, or its first row shows it by a cell that begins with
    http; other cells become the context. A seed list is a configuration file, so
    it is read as a whole.
    """
    text = _content(spark, path)
    found: dict[str, dict[str, str]] = {}
    if path.lower().endswith(".csv"):
        rows = list(csv.reader(io.StringIO(text)))
        head = [h.strip() for h in rows[0]] if rows else []
        at = next((i for i, h in enumerate(head) if h.lower() in URL_HEADERS), None)
        if at is None:
            at = next((i for i, h in enumerate(head) if h.startswith("http")), 0)
            head = [f"col{i}" for i in range(len(head))]
        else:
            rows = rows[1:]
        for row in rows:
            cells = [c.strip() for c in row]
            if len(cells) > at and cells[at].startswith("http"):
                found.setdefault(cells[at], {h: c for i, (h, c) in enumerate(zip(head, cells, strict=False)) if i != at and c})
    else:
        for line in map(str.strip, text.splitlines()):
            if line.startswith("http"):
                found.setdefault(line, {})
    return spark.createDataFrame([(k, u, c) for k, (u, c) in enumerate(found.items())], "pos int, url string, context map<string, string>")


def with_context_title(docs: DataFrame, seeds: DataFrame, keys: tuple[str, ...] = ("Titulo", "titulo", "title", "Consulta_Origen"), least: int = 8) -> DataFrame:
    """Return ``docs`` (seed, title) with a missing title taken from the seed's context, if that has a label of some length."""
    label = F.coalesce(*[F.when(F.length(F.element_at("context", k)) >= least, F.element_at("context", k)) for k in keys])
    named = seeds.select(F.col("url").alias("seed"), label.alias("_label"), "context")
    return docs.join(named, "seed", "left").withColumn("title", F.coalesce("title", "_label")).drop("_label")


def _clean(url):
    bare = F.regexp_replace(F.btrim(url), r"[.,;:)»”\"']+$", "")
    return F.when(bare.startswith("http"), bare).otherwise(F.concat(F.lit("https://"), bare))


def from_free_form(rows: DataFrame) -> DataFrame:
    """Return (row, institution, url, is_home) of a free-form sheet (row, institution, text).

    Explicit URLs come first, then bare domains in the rest of the text. Rows
    with URLs belong to the institution last named; a URL counts once, whatever
    its case and final slash.
    """
    text = F.coalesce("text", F.lit(""))
    explicit = F.regexp_extract_all(text, F.lit(URL_PATTERN), 0)
    bare = F.regexp_extract_all(F.regexp_replace(text, URL_PATTERN, " "), F.lit(DOMAIN_PATTERN), 1)
    named = F.last(F.when(F.btrim("institution") != "", F.btrim("institution")), ignorenulls=True).over(Window.orderBy("row"))  # a sheet is small
    every = rows.withColumn("institution", named).select("row", "institution", F.posexplode(F.concat(explicit, bare)).alias("k", "u"))
    clean = every.select("row", "k", "institution", _clean(F.col("u")).alias("url")).where(F.regexp_extract("url", r"^https?://([^/?#]*)", 1).contains("."))
    first = Window.partitionBy(F.regexp_replace(F.lower("url"), "/$", "")).orderBy("row", "k")
    once = clean.withColumn("n", F.row_number().over(first)).where("n = 1")
    home = F.regexp_extract("url", r"^https?://[^/?#]*/*([^?#]*)", 1).rlike("^/*$") & ~F.col("url").contains("?")
    return once.select("row", "institution", "url", home.alias("is_home"))


def from_ordered(rows: DataFrame) -> DataFrame:
    """Return numbered links (n, institution, url, permission, comment) once each, with class restricted, home or deep."""
    url = F.when(F.btrim("url").rlike("(?i)^https?://"), F.btrim("url")).otherwise(F.concat(F.lit("https://"), F.btrim("url")))
    links = rows.where("n IS NOT NULL AND url IS NOT NULL AND url <> ''").withColumn("url", url)
    once = links.withColumn("_k", F.row_number().over(Window.partitionBy(F.regexp_replace("url", "/+$", "")).orderBy("n"))).where("_k = 1").drop("_k")
    place = F.regexp_extract("url", r"^https?://[^/?#]*([^?#]*)", 1)
    home = place.isin("", "/") | place.rlike(r"(?i)/(home|index)(\.\w+)?/?$")
    return once.withColumn("class", F.when(F.coalesce(F.col("comment").rlike(RESTRICTION), F.lit(False)), "restricted").when(home, "home").otherwise("deep"))
