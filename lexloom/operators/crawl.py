"""Crawl decisions over static tables: admission, order, plan, page decisions, provenance."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions import url as U
from lexloom.functions import vocab

UNLIMITED = 10**6


def admission(targets: DataFrame, seed: Column | str, max_depth: int, excludes: Iterable[str] = (), hints: Iterable[str] = (), subdomains: bool = True, aliases: Iterable[str] = (), exhaustive: bool = False, seen: DataFrame | None = None, whole_labels: bool = True, pos: str = "pos") -> DataFrame:
    """Return each URL of ``targets`` once, as it first comes, with reason (of a rejection) or tier.

    Checks go by depth, site, exclusion and query trap. Tiers: 0 documents,
    1 listing items, 2 content-like URLs, 3 sitemap, 4 others. ``seen`` (url) are
    URLs that are known already.
    """
    rows = targets if seen is None else targets.join(seen.select("url"), "url", "left_anti")
    columns = [c for c in rows.columns if c != "url"]
    first = rows.groupBy("url").agg(F.min_by(F.struct(*columns), pos).alias("r")).select("url", *[F.col(f"r.{c}").alias(c) for c in columns])
    pdf = F.coalesce("hint_pdf", F.lit(False))
    limit = UNLIMITED if exhaustive else max_depth
    reason = (
        F.when(F.col("depth") > limit, "depth")
        .when(~U.same_site("url", seed, subdomains, aliases, whole_labels) & ~pdf, "offsite")
        .when(U.is_excluded("url", list(excludes)), "excluded")
        .when(U.is_query_trap("url"), "trap")
    )
    tier = F.when(pdf, 0).when(F.coalesce("from_listing", F.lit(False)), 1).when(U.looks_like_content("url", list(hints)), 2).when(F.coalesce("from_sitemap", F.lit(False)), 3).otherwise(4)
    return first.withColumn("reason", reason).withColumn("tier", F.when(reason.isNull(), tier))


def emission(admitted: DataFrame, max_pages: int, site: str | None = None, pos: str = "pos") -> DataFrame:
    """Return the admitted URLs with their turn; beyond ``max_pages`` they are not fetched.

    With ``site`` the turns (and the budget) are each site's own.
    """
    order = Window.partitionBy(*([site] if site else [])).orderBy("tier", pos)
    rows = admitted.where("reason IS NULL").withColumn("turn", F.row_number().over(order))
    return rows.withColumn("decision", F.when(F.col("turn") <= max_pages, "fetch").otherwise("not_fetched"))


def plan(page_kind: Column, listing_items: Column, sections: Column, sitemap_urls: Column) -> Column:
    """Return (strategy, low_confidence) by what a probe of the seed showed."""
    strategy = (
        F.when((page_kind == "listing") & (listing_items >= 3), "listing")
        .when(page_kind == "article", "directed")
        .when(sections >= 3, "sections")
        .when(sitemap_urls >= 10, "sitemap")
        .otherwise("bfs")
    )
    return F.struct(strategy.alias("strategy"), (strategy == "bfs").alias("low_confidence"))


def refined(strategy: Column, low_confidence: Column, answer: Column) -> Column:
    """Return the arbiter's answer where the plan was unsure and the answer is a strategy, else the plan's."""
    return F.when(low_confidence & answer.isin("listing", "directed", "sections", "sitemap", "bfs"), answer).otherwise(strategy)


def page_decision(rows: DataFrame, max_density: float = 0.85, least_words: int = 80) -> DataFrame:
    """Return ``rows`` with ``decision``, the first that holds of those a fetched page goes through.

    Columns: already_saved, robots_allowed, throttled, blocked, status, is_pdf,
    is_word, too_large, html (null or empty: nothing came), same_site, page_kind,
    link_density, words, repeats (its content is known), extract_fails (reading
    its text or file raised an error). Only a page that gave a document can be a hub.
    """
    c = lambda name, default: F.coalesce(F.col(name), F.lit(default))
    binary = c("is_pdf", False) | c("is_word", False)
    decision = (
        F.when(c("already_saved", False), "already_saved")
        .when(~c("robots_allowed", True), "robots")
        .when(c("throttled", False), "throttle")
        .when(c("blocked", False), "blocked")
        .when(c("status", 200) >= 400, "http_error")
        .when(binary & c("too_large", False), "too_large")
        .when(binary, F.when(c("extract_fails", False), "extract_error").when(c("repeats", False), "duplicate").otherwise("saved"))
        .when(c("html", "") == "", "empty")
        .when(~c("same_site", True), "offsite_html")
        .when(c("page_kind", "") == "listing", "listing")
        .when(c("extract_fails", False), "extract_error")
        .when(c("words", 0) < least_words, "no_document")
        .when(c("link_density", 0.0) >= max_density, "hub")
        .otherwise(F.when(c("repeats", False), "duplicate").otherwise("saved"))
    )
    return rows.withColumn("decision", decision)


def provenance_paths(nodes: DataFrame, max_hops: int = 12) -> DataFrame:
    """Return (url, path): the chain of URLs from the seed (via null) to each node, at most ``max_hops`` long.

    One join for each hop, of all nodes at once; cycles end where they close.
    """
    edges = nodes.select(F.col("url").alias("_at"), F.col("via").alias("_up")).dropDuplicates(["_at"])
    walk = edges.select(F.col("_at").alias("url"), F.array("_at").alias("path"), F.col("_up").alias("next"))
    for _ in range(max_hops - 1):
        step = walk.join(edges, walk["next"] == edges["_at"], "left")
        moves = F.col("_at").isNotNull() & ~F.array_contains("path", F.col("next"))
        walk = step.select("url", F.when(moves, F.concat(F.array("next"), F.col("path"))).otherwise(F.col("path")).alias("path"), F.when(moves, F.col("_up")).alias("next"))
    return walk.select("url", "path")


def branch_totals(paths: DataFrame, docs: DataFrame) -> DataFrame:
    """Return (url, branch_docs, branch_words): what the nodes below each node (itself included) hold."""
    held = docs.groupBy("url").agg(F.count("*").alias("docs"), F.sum("words").alias("words"))
    rows = paths.join(held, "url", "left").select(F.explode("path").alias("node"), "docs", "words")
    return rows.groupBy(F.col("node").alias("url")).agg(F.coalesce(F.sum("docs"), F.lit(0)).cast("long").alias("branch_docs"), F.coalesce(F.sum("words"), F.lit(0)).cast("long").alias("branch_words"))


def rendered_tree(paths: DataFrame, max_depth: int = 6) -> DataFrame:
    """Return (path, line): one indented line for each node, in the order of a walk through the tree."""
    depth = F.size("path") - 1
    return paths.where(depth <= max_depth).select("path", F.concat(F.repeat(F.lit("  "), depth), "url").alias("line")).orderBy("path")


def breadth_first(links: DataFrame, seeds: DataFrame, max_depth: int) -> DataFrame:
    """Return (url, depth) of the pages that ``seeds`` (url) reach over ``links`` (via, url) on the same host.

    One join for each level over the link table; only new URLs go on.
    """
    inside = links.where((U.bare_host("url") == U.bare_host("via")) & ~U.is_utility("url")).select("via", "url").distinct()
    found = level = seeds.select("url").distinct().withColumn("depth", F.lit(0))
    for depth in range(1, max_depth + 1):
        level = level.select(F.col("url").alias("via")).join(inside, "via").select("url").distinct().join(found, "url", "left_anti").withColumn("depth", F.lit(depth))
        found = found.unionByName(level)
    return found


def check_decisions(ledger: DataFrame) -> DataFrame:
    """Return ``ledger``; a row with an unknown decision fails the job."""
    known = F.col("decision").isin(vocab.DECISIONS)
    return ledger.withColumn("decision", F.when(known, F.col("decision")).otherwise(F.raise_error(F.concat(F.lit("unknown decision: "), F.coalesce("decision", F.lit("null"))))))
