"""The HTML functions on tables: one pass of Arrow batches for each."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions import text as T
from lexloom.functions import url as U
from lexloom.functions import vocab
from lexloom.html import documents, pages
from lexloom.session import spread

PAGE_MAP = (
    "page_kind string, text_chars int, root_selector string, root_chars int, link_density double, paragraph_chars int, group_items int, group_score double, "
    "landmarks array<struct<tag: string, selector: string, chars: int, share: double>>, listing_items array<struct<title: string, url: string, snippet: string>>, "
    "pagination_urls array<string>, pagination_js_only boolean, fulltext_links array<struct<url: string, anchor_text: string, kind: string, same_site: boolean>>"
)
METADATA = "title string, description string, published_date string, authors array<string>, site_name string, language string, keywords array<string>, canonical string, has_citation boolean, rights string, license_url string"
RIGHTS = "meta_noai boolean, license_links array<string>, copyright_line string, legal_pages array<struct<label: string, url: string>>"
SECTION = "sections array<struct<name: string, url: string, source: string, path_depth: int, is_media: boolean>>"
EXTRACT = "canonical string, markdown string, needs_rendering boolean, digest struct<title: string, headings: array<string>, labels: array<string>>"
LINKS = "html_links array<string>, document_links array<string>"


#: Characters of markup and pages that are read as one block, which bounds a worker's memory.
BLOCK_CHARS, BLOCK_PAGES = 4_000_000, 500


def _mapped(rows: DataFrame, make: Callable[[list[str], list[str | None]], list[dict]], schema: str, keys: tuple[str, ...]) -> DataFrame:
    kept = [*keys, "url"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split(" ")[0] for x in _fields(schema)]
        for batch in batches:
            # A longer page is a block of its own.
            block = ((batch["html"].str.len().fillna(0).cumsum() // BLOCK_CHARS) * (len(batch) // BLOCK_PAGES + 1) + pd.RangeIndex(len(batch)) // BLOCK_PAGES).to_numpy()
            for _, part in batch.groupby(block):
                urls, htmls = ([None if v is None or v != v else v for v in part[c]] for c in ("url", "html"))
                made = pd.DataFrame(make([u or "" for u in urls], htmls), columns=names, index=part.index)
                yield pd.concat([part[kept], made], axis=1)

    types = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in kept)
    return spread(rows.select(*kept, "html")).mapInPandas(run, f"{types}, {schema}")


def _fields(schema: str) -> list[str]:
    out, depth = [""], 0
    for c in schema:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return [x.strip() for x in out]


def page_maps(rows: DataFrame, *keys: str) -> DataFrame:
    """Return the page map of each of ``rows`` (url, html); ``keys`` are kept."""
    return _mapped(rows, pages.page_maps, PAGE_MAP, keys)


def head_metadata(rows: DataFrame, *keys: str) -> DataFrame:
    return _mapped(rows, documents.head_metadata, METADATA, keys)


def page_links(rows: DataFrame, *keys: str) -> DataFrame:
    return _mapped(rows, pages.links, LINKS, keys)


def page_sections(rows: DataFrame, *keys: str) -> DataFrame:
    return _mapped(rows, pages.sections, SECTION, keys)


def rights_signals(rows: DataFrame, *keys: str) -> DataFrame:
    return _mapped(rows, documents.rights_signals, RIGHTS, keys)


def extracted(rows: DataFrame, *keys: str, least_words: int = 80) -> DataFrame:
    """Return (url, doc_id, canonical, markdown, n_words, needs_rendering, digest) of each page.

    The id is that of the canonical address; a main text of fewer than
    ``least_words`` words is no document: its markdown is null.
    """
    found = _mapped(rows, documents.extracted, EXTRACT, keys).withColumn("n_words", T.count_words("markdown"))
    body = F.when(F.col("n_words") >= least_words, F.col("markdown"))
    return found.select(*keys, "url", U.doc_id("canonical").alias("doc_id"), "canonical", body.alias("markdown"), "n_words", "needs_rendering", "digest")


def block_kind(status: Column, html: Column) -> Column:
    """Return http_block, captcha or an empty string: a mark counts on short pages only, and as a whole word."""
    marks = "|".join(m.replace(".", r"\.") for m in vocab.CHALLENGE_MARKS)
    marked = F.lower(F.substring(html, 1, vocab.CHALLENGE_CHARS)).rlike(rf"(?<![\p{{L}}\p{{N}}_-])({marks})(?![\p{{L}}\p{{N}}_-])")
    short = T.visible_words(html) <= vocab.CHALLENGE_WORDS
    return F.when(F.coalesce(status.isin(vocab.BLOCK_STATUSES), F.lit(False)), "http_block").when(F.coalesce(marked & short, F.lit(False)), "captcha").otherwise("")
