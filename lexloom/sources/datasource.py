"""Fetched pages as a Spark data source: ``spark.read.format("lexloom_pages")`` after :func:`register`."""

from __future__ import annotations

import importlib
import json
from collections import defaultdict
from collections.abc import Iterator
from urllib.parse import urlsplit

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lexloom.session import reachable

COLUMNS = "url string, status int, content_type string, html string, body binary, method string, blocked string, is_pdf boolean, is_word boolean"


class Hosts(InputPartition):
    """The URLs of some hosts; all URLs of a host are in one partition, so that one task speaks to one site."""

    def __init__(self, urls: list[str]) -> None:
        self.urls = urls


class PagesReader(DataSourceReader):
    def __init__(self, urls: list[str], fetcher: str, partitions: int) -> None:
        self.urls, self.fetcher, self.most = urls, fetcher, partitions

    def partitions(self) -> list[Hosts]:
        by_host: dict[str, list[str]] = defaultdict(list)
        for url in self.urls:
            by_host[urlsplit(url).netloc].append(url)
        dealt: list[list[str]] = [[] for _ in range(max(1, min(self.most, len(by_host))))]
        for _, own in sorted(by_host.items(), key=lambda x: (-len(x[1]), x[0])):  # the largest host to the emptiest partition
            min(dealt, key=len).extend(own)
        return [Hosts(urls) for urls in dealt]

    def read(self, partition: Hosts) -> Iterator[tuple]:
        module, _, name = self.fetcher.partition(":")
        fetcher = getattr(importlib.import_module(module), name)()
        for url in partition.urls:
            a = fetcher.fetch(url)
            yield (a.url, a.status, a.content_type, a.html, a.body, a.method, a.blocked, a.is_pdf, a.is_word)


class PagesSource(DataSource):
    """Options: ``urls`` (a JSON array of seeds), ``fetcher`` (module:callable that makes a ``Fetcher`` in each task) and ``partitions``.

    A list of seeds is a configuration; tables of URLs go through ``sources.fetch.fetched``.
    """

    @classmethod
    def name(cls) -> str:
        return "lexloom_pages"

    def schema(self) -> str:
        return COLUMNS

    def reader(self, schema) -> PagesReader:
        if "fetcher" not in self.options:
            raise ValueError("option fetcher names what fetches, as module:callable")
        return PagesReader(json.loads(self.options.get("urls", "[]")), self.options["fetcher"], int(self.options.get("partitions", "8")))


def register(spark: SparkSession) -> None:
    reachable(spark)
    spark.dataSource.register(PagesSource)
