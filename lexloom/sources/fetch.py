"""Fetching behind an interface: who answers is given, so that the decisions can be tested without a network."""

from __future__ import annotations

import re
import time
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions import url as U
from lexloom.html.documents import renderable
from lexloom.session import cut_lineage


@dataclass
class Answer:
    """What a fetch brought."""

    url: str
    status: int | None = None
    content_type: str = ""
    html: str | None = None
    body: bytes = b""
    method: str = "static"
    blocked: str = ""

    @property
    def is_pdf(self) -> bool:
        return "application/pdf" in self.content_type.lower() or self.body.startswith(b"%PDF-")

    @property
    def is_word(self) -> bool:
        kind = self.content_type.lower()
        return "msword" in kind or "wordprocessingml" in kind or self.body.startswith(bytes.fromhex("D0CF11E0A1B11AE1")) or (self.body.startswith(b"PK\x03\x04") and ".docx" in self.url.lower())


class Fetcher(Protocol):
    def fetch(self, url: str) -> Answer: ...


@dataclass
class TableFetcher:
    """Answers from a dictionary of pages."""

    pages: dict[str, str]

    def fetch(self, url: str) -> Answer:
        page = self.pages.get(url)
        return Answer(url, 404) if page is None else Answer(url, 200, "text/html", page)


def empty_site() -> TableFetcher:
    """Return a fetcher that finds nothing anywhere."""
    return TableFetcher({})


@dataclass
class Retrying:
    """Asks again after failures of the transport, at growing distances of 2 to 30 seconds; a last failure is a block of kind network."""

    ask: Callable[[str], Answer]
    tries: int = 3
    wait: Callable[[float], None] = time.sleep

    def fetch(self, url: str) -> Answer:
        for turn in range(self.tries):
            try:
                got = self.ask(url)
            except (OSError, TimeoutError):
                if turn + 1 < self.tries:
                    self.wait(min(30.0, 2.0 * 2**turn))
                continue
            kind = got.content_type.lower()
            if not ("html" in kind or ("xml" in kind and not re.search("rss|atom", kind))):
                got.html = None
            return got
        return Answer(url, blocked="network")


@dataclass
class Adaptive:
    """Static first; rendered only where the page needs it and the rendering brings something."""

    static: Fetcher
    render: Fetcher | None = None
    least_chars: int = 400
    markers: tuple[str, ...] = ()

    def fetch(self, url: str) -> Answer:
        plain = self.static.fetch(url)
        if self.render is None or plain.blocked or plain.is_pdf or not plain.html or not renderable(plain.html, self.least_chars, self.markers):
            return plain
        try:
            full = self.render.fetch(url)
        except OSError:
            return plain
        return plain if full.blocked or not full.html else full


def fetched(urls: DataFrame, make: Callable[[], Fetcher]) -> DataFrame:
    """Return the answers for ``urls`` (url); a fetcher is made once in each task.

    Rows are best partitioned by host before, so that one task speaks to one site.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fetcher = make()
        for batch in batches:
            got = [fetcher.fetch(u) for u in batch["url"]]
            yield pd.DataFrame([(a.url, a.status, a.content_type, a.html, a.body, a.method, a.blocked, a.is_pdf, a.is_word) for a in got], columns=["url", "status", "content_type", "html", "body", "method", "blocked", "is_pdf", "is_word"])

    return urls.select("url").mapInPandas(run, "url string, status int, content_type string, html string, body binary, method string, blocked string, is_pdf boolean, is_word boolean")


@dataclass
class Throttle:
    """Quota, spacing and block of each site, for simulations with a clock of their own."""

    quota: int = 500
    delay: float = 2.0
    clock: Callable[[], float] = time.monotonic
    counts: dict[str, int] = field(default_factory=dict)
    last: dict[str, float] = field(default_factory=dict)
    blocked: set[str] = field(default_factory=set)

    def admits(self, url: str) -> bool:
        site = urlsplit(url).netloc
        return site not in self.blocked and self.counts.get(site, 0) < self.quota

    def wait(self, url: str) -> float:
        """Count a visit and return the seconds to wait before it."""
        site, now = urlsplit(url).netloc, self.clock()
        pause = max(0.0, self.last.get(site, float("-inf")) + self.delay - now)
        self.last[site] = now + pause
        self.counts[site] = self.counts.get(site, 0) + 1
        return pause


SITEMAP = "kind string, locs array<string>"


def read_sitemaps(files: DataFrame) -> DataFrame:
    """Return (url, kind, locs) of sitemap files (url, text): index or pages, and the addresses in order; broken files are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for url, text in zip(batch["url"], batch["text"], strict=True):
                try:
                    root = ET.fromstring((text or "").encode())
                except ET.ParseError:
                    continue
                locs = [e.text.strip() for e in root.iter() if e.tag.rpartition("}")[2] == "loc" and e.text]
                rows.append((url, "index" if root.tag.endswith("sitemapindex") else "pages", locs))
            yield pd.DataFrame(rows, columns=["url", "kind", "locs"])

    return files.select("url", "text").mapInPandas(run, f"url string, {SITEMAP}")


def sitemap_pages(sites: DataFrame, files: DataFrame, limit: int = 500, levels: int = 3) -> DataFrame:
    """Return (site, url) of the pages that the sitemaps of ``sites`` (site, robots) list, at most ``limit`` of each site.

    Sitemaps are those that robots.txt names and the usual two places; ``files``
    (url, text) are the answers. Indexes are followed over ``levels`` joins; of a
    site's pages those come first that the first sitemap names first.
    """
    known = cut_lineage(read_sitemaps(files))
    named = F.regexp_extract_all(F.coalesce("robots", F.lit("")), F.lit(r"(?im)^sitemap:\s*(\S+)"), 1)
    usual = F.array(*[F.concat(F.regexp_replace("site", "/+$", ""), F.lit(f"/{n}")) for n in ("sitemap.xml", "sitemap_index.xml")])
    at = sites.select("site", F.posexplode(F.array_distinct(F.concat(named, usual))).alias("k", "url")).select("site", "url", F.array("k").alias("order"))
    found = None
    for _ in range(levels):
        read = at.join(known, "url").select("site", "order", "kind", F.posexplode("locs").alias("k", "loc")).select("site", "kind", F.col("loc").alias("url"), F.concat("order", F.array("k")).alias("order"))
        pages = read.where("kind = 'pages'").drop("kind")
        found = pages if found is None else found.unionByName(pages)
        at = read.where("kind = 'index'").groupBy("site", "url").agg(F.min("order").alias("order"))
    first = found.groupBy("site", "url").agg(F.min("order").alias("order"))
    nth = F.row_number().over(Window.partitionBy("site").orderBy("order"))
    return first.withColumn("nth", nth).where(F.col("nth") <= limit).select("site", "url")


def content_first(urls: DataFrame, hints: list[str], limit: int, keys: tuple[str, ...] = ("site",)) -> DataFrame:
    """Return at most ``limit`` URLs of each site, those that look like content first, else in the order given (pos)."""
    order = Window.partitionBy(*keys).orderBy(F.when(U.looks_like_content("url", hints), 0).otherwise(1), "pos")
    return urls.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= limit).drop("_n")
