"""Settings of a crawl and its corpus: a YAML file over defaults, as typed records."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields, is_dataclass, replace
from typing import Any

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Discovery:
    """What is looked for and how far."""

    mode: str | None = None
    use_sitemaps: bool = True
    sitemap_limit: int = 500
    max_pages_per_site: int = 500
    max_depth: int = 3
    follow_subdomains: bool = True
    follow_article_links: bool = True
    exhaustive: bool = False
    max_listing_pages: int = 3
    max_sections: int = 8
    max_section_depth: int = 1
    max_subsections: int = 4
    max_pages_per_section: int = 8
    saturation_window: int = 25
    max_seconds_per_site: float | None = None
    exclude_patterns: tuple[str, ...] = ()
    content_hints: tuple[str, ...] = ()


@dataclass(frozen=True)
class Fetching:
    """How sites are asked."""

    delay_seconds: float = 2.0
    max_requests_per_domain: int = 500
    respect_robots: bool = True
    min_text_length: int = 400
    spa_markers: tuple[str, ...] = ()


@dataclass(frozen=True)
class Extraction:
    """What counts as a document."""

    min_words: int = 80
    max_link_density: float = 0.85


@dataclass(frozen=True)
class Files:
    """Downloads and when they need OCR."""

    download: bool = True
    max_size_mb: float = 50.0
    ocr_chars_per_page_threshold: float = 120
    ocr_image_coverage_threshold: float = 0.85


@dataclass(frozen=True)
class Settings:
    """All settings; sections that a file does not name keep their defaults, and ``extra`` holds what is not known here."""

    seeds: tuple[str, ...] = ()
    discovery: Discovery = field(default_factory=Discovery)
    fetching: Fetching = field(default_factory=Fetching)
    extraction: Extraction = field(default_factory=Extraction)
    pdf: Files = field(default_factory=Files)
    extra: Mapping[str, Any] = field(default_factory=dict)


def merged(base: Any, given: Mapping[str, Any] | None) -> Any:
    """Return a record with the values of a mapping: records within it are merged, lists become tuples, unknown names of a section are refused."""
    known = {f.name for f in fields(base)}
    out, rest = {}, {}
    for name, value in (given or {}).items():
        if name not in known:
            rest[name] = value
        elif is_dataclass(getattr(base, name)):
            out[name] = merged(getattr(base, name), value)
        else:
            out[name] = tuple(value) if isinstance(value, list) else value
    if rest and "extra" in known:
        out["extra"] = {**base.extra, **rest}
    elif rest:
        raise ValueError(f"unknown settings of {type(base).__name__}: {sorted(rest)}")
    return replace(base, **out)


def parse(text: str, base: Settings | None = None) -> Settings:
    """Return the settings of a YAML text over ``base`` (the defaults, if none is given); an empty text changes nothing."""
    import yaml

    given = yaml.safe_load(text) or {}
    if not isinstance(given, Mapping):
        raise ValueError("settings are a mapping")
    return merged(base or Settings(), given)


def load(spark: SparkSession, path: str, base: Settings | None = None) -> Settings:
    """Read settings through Spark, so that any store it reaches will do."""
    row = spark.read.text(path, wholetext=True).first()
    return parse(row[0] if row else "", base)


def with_overrides(settings: Settings, overrides: Mapping[str, Any]) -> Settings:
    """Return settings with a plan's changes to discovery; the mode stays as it is."""
    changes = {k: {"true": True, "false": False}.get(v, v) if isinstance(v, str) else v for k, v in overrides.items() if k != "mode"}
    return replace(settings, discovery=merged(settings.discovery, changes))
