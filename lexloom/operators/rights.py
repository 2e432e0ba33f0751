"""Rights: evidence, verdict, partition and the partitioned export."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.functions import text as T
from lexloom.functions import url as U
from lexloom.functions import vocab


def robots_signals(robots: Column | str) -> Column:
    """Return (content_signal, ai_bots_blocked) of a robots.txt: a bot counts if its own block disallows everything."""
    text = F.regexp_replace(F.col(robots) if isinstance(robots, str) else robots, "\r", "")
    signal = F.btrim(F.regexp_extract(text, r"(?im)^Content-Signal:\s*(.+)$", 1))
    blocks = F.slice(F.split(text, r"(?im)^user-agent:\s*"), 2, 1_000_000)
    full = F.transform(F.filter(blocks, lambda b: F.regexp_like(F.regexp_replace(b, r"^[^\n]*", ""), F.lit(r"(?im)^disallow:\s*/\s*$"))), lambda b: F.lower(F.btrim(F.element_at(F.split(b, "\n"), 1))))
    blocked = F.filter(F.array(*[F.lit(b) for b in vocab.AI_BOTS]), lambda b: F.array_contains(full, F.lower(b)))
    return F.struct(F.when(signal != "", signal).alias("content_signal"), blocked.alias("ai_bots_blocked"))


def phrases(text: Column | str) -> Column:
    """Return the phrases about rights that a text holds."""
    return T.let(F.lower(T.collapse(text)), lambda flat: F.filter(F.array(*[F.lit(p) for p in vocab.RIGHTS_PHRASES]), lambda p: flat.contains(p)))


def verdict(domain: Column, content_signal: Column, ai_bots_blocked: Column, tdm: Column, meta_noai: Column, license_links: Column, copyright_line: Column, found: Column) -> Column:
    """Return the verdict on a site by its signals, the strongest first.

    ``ai_bots_blocked``, ``license_links`` and ``found`` (phrases of its legal
    pages) are arrays.
    """
    signal = F.lower(F.coalesce(content_signal, F.lit("")))
    free = F.exists(license_links, lambda x: x.contains("creativecommons")) | F.exists(found, lambda p: p.rlike("^(creative commons|cc by|cc-by)"))
    reserved = F.exists(found, lambda p: p.isin(vocab.RESERVING_PHRASES)) | F.coalesce(copyright_line.rlike("(?i)derechos reservados|rights reserved"), F.lit(False))
    return (
        F.when(F.coalesce(tdm, F.lit(False)) | F.coalesce(meta_noai, F.lit(False)) | signal.contains("ai-train=no") | signal.contains("ai=n"), vocab.VERDICT_AI)
        .when(F.size(ai_bots_blocked) > 0, vocab.VERDICT_AI_BOTS)
        .when(free, vocab.VERDICT_CC)
        .when(reserved, vocab.VERDICT_RESERVED)
        .when(domain.rlike(vocab.PUBLIC_SECTOR_PATTERN), vocab.VERDICT_PUBLIC)
        .when(F.coalesce(copyright_line, F.lit("")) != "", vocab.VERDICT_COPYRIGHT)
        .otherwise(vocab.VERDICT_NONE)
    )


def partition_of(found: Column) -> Column:
    """Return the export partition of a verdict."""
    out = None
    for prefix, name in vocab.PARTITIONS:
        out = F.when(found.startswith(prefix), name) if out is None else out.when(found.startswith(prefix), name)
    return out.otherwise(vocab.DEFAULT_PARTITION)


def export_rows(docs: DataFrame, verdicts: DataFrame, least_words: int = 50, only: list[str] | None = None, url: str = "url", body: str = "text") -> DataFrame:
    """Return ``docs`` with words, partition and skipped (the reason, or null).

    ``verdicts`` has domain and verdict; a document's host is looked up with its
    ``www.`` and, where no verdict is known, goes to the default partition.
    """
    known = verdicts.select(F.lower("domain").alias("_host"), partition_of(F.col("verdict")).alias("_part")).groupBy("_host").agg(F.max("_part").alias("_part"))
    rows = docs.withColumns({body: T.body_of(body), "_host": U.netloc(url)}).withColumn("words", T.count_words(F.coalesce(body, F.lit(""))))
    rows = rows.join(known, "_host", "left").withColumn("partition", F.coalesce("_part", F.lit(vocab.DEFAULT_PARTITION)))
    outside = ~F.col("partition").isin(only) if only else F.lit(False)
    skipped = F.when(F.col(body).isNull(), "sin_texto").when(F.col("words") < least_words, "texto_corto").when(outside, F.concat(F.lit("fuera_de_--only:"), "partition"))
    return rows.withColumn("skipped", skipped).drop("_host", "_part")


def manifest(rows: DataFrame) -> DataFrame:
    """Return (name, kind, documents, words) of the partitions and of what was skipped."""
    kept = rows.where("skipped IS NULL").groupBy(F.col("partition").alias("name")).agg(F.count("*").alias("documents"), F.sum("words").cast("long").alias("words"))
    gone = rows.where("skipped IS NOT NULL").groupBy(F.col("skipped").alias("name")).agg(F.count("*").alias("documents"), F.sum("words").cast("long").alias("words"))
    return kept.withColumn("kind", F.lit("partition")).unionByName(gone.withColumn("kind", F.lit("skipped")))


def write_export(rows: DataFrame, folder: str) -> None:
    """Write one folder of JSON lines for each partition, and the manifest beside them."""
    kept = rows.where("skipped IS NULL").drop("skipped")
    kept.write.mode("overwrite").partitionBy("partition").json(f"{folder}/data")
    manifest(rows).coalesce(1).write.mode("overwrite").json(f"{folder}/manifest")  # a few rows


def verdict_summary(verdicts: DataFrame, docs_per_host: DataFrame) -> DataFrame:
    """Return (verdict, domains, docs)."""
    rows = verdicts.join(docs_per_host, "domain", "left")
    return rows.groupBy("verdict").agg(F.count("*").alias("domains"), F.coalesce(F.sum("docs"), F.lit(0)).cast("long").alias("docs"))


def robots_pattern(pattern: str) -> str:
    """Return a rule's path pattern as a regular expression that is anchored at the start."""
    return "^" + re.escape(pattern.rstrip("$")).replace(r"\*", ".*") + ("$" if pattern.endswith("$") else "")


def robots_allows(rules: list[tuple[str, str]], path: str) -> bool:
    """Return whether a path may be fetched by (allow or disallow, pattern) rules: the longest fitting one counts, allow on a tie."""
    best = (-1, True)
    for kind, pattern in rules:
        if pattern and re.match(robots_pattern(pattern), path):
            best = max(best, (len(pattern), kind == "allow"))
    return best[1]


def robots_rules(text: str, agent: str) -> tuple[list[tuple[str, str]], float | None]:
    """Return the rules and the crawl delay for ``agent`` (else for ``*``) in a robots.txt."""
    groups: dict[str, tuple[list, list]] = {}
    names: list[str] = []
    open_ = False
    for line in text.splitlines():
        key, _, value = (x.strip() for x in line.partition("#")[0].partition(":"))
        key = key.lower()
        if key == "user-agent":
            names = [*names, value.lower()] if open_ else [value.lower()]
            open_ = True
        elif key:
            open_ = False
            for name in names:
                rules, delays = groups.setdefault(name, ([], []))
                if key in ("allow", "disallow"):
                    rules.append((key, value))
                elif key == "crawl-delay":
                    delays.append(value)
    low = agent.lower()
    named = [n for n in groups if n != "*" and n in low]
    rules, delays = groups.get(max(named, key=len) if named else "*", ([], []))
    try:
        delay = float(delays[0]) if delays else None
    except ValueError:
        delay = None
    return rules, delay


RULES = "rules array<struct<kind: string, pattern: string, size: int>>, delay double"


def parsed_robots(robots: DataFrame, agent: str) -> DataFrame:
    """Return (host, rules, delay) of robots files (host, robots): each is parsed once, its patterns as regular expressions."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [robots_rules(text or "", agent) for text in batch["robots"]]
            rules = [[{"kind": k, "pattern": robots_pattern(p), "size": len(p)} for k, p in r if p] for r, _ in found]
            yield pd.DataFrame({"host": batch["host"], "rules": rules, "delay": pd.Series([d for _, d in found], dtype="float64")})

    return robots.select("host", "robots").mapInPandas(run, f"host string, {RULES}")


def allowed(urls: DataFrame, robots: DataFrame, agent: str) -> DataFrame:
    """Return ``urls`` (url) with ``allowed`` by their site's robots file (host, robots); without one all is allowed.

    Rules are joined by host, not sent to every task, and tested as columns.
    """
    where = F.concat(U.path("url"), F.when(U.query("url") != "", F.concat(F.lit("?"), U.query("url"))).otherwise(""))
    rows = urls.withColumns({"_host": U.netloc("url"), "_place": F.when(where == "", "/").otherwise(where)})
    joined = rows.join(parsed_robots(robots, agent).select(F.col("host").alias("_host"), F.col("rules").alias("_rules")), "_host", "left")
    fits = F.filter("_rules", lambda r: F.regexp_like(F.col("_place"), r["pattern"]))
    best = F.array_max(F.transform(fits, lambda r: F.struct(r["size"].alias("size"), (r["kind"] == "allow").alias("yes"))))
    return joined.withColumn("allowed", F.coalesce(best["yes"], F.lit(True))).drop("_host", "_place", "_rules")
