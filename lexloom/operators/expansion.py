"""What fetched pages lead to, and how a site is walked: links to follow, listings, sections, modes, pagination."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions import url as U
from lexloom.session import cut_lineage

# Why a crawl of a site ended.
EXHAUSTED = "frontera agotada"
OUT_OF_PAGES = "presupuesto de páginas agotado"
# What each plan changes in the settings of discovery.
OVERRIDES = {
    "listing": {"use_sitemaps": "false", "mode": None}, "directed": {"use_sitemaps": "false", "mode": None, "follow_article_links": "false"},
    "sections": {"mode": "sections"}, "sitemap": {"use_sitemaps": "true", "mode": None}, "bfs": {"use_sitemaps": "false", "mode": None},
}


def _targets(pages: DataFrame, urls: Column, kind: Column | str, place: int, deeper: bool = True, pdf: Column | bool = False, listed: bool = False) -> DataFrame:
    """Return a row for each URL of an array column: what the frontier needs to know, and its place among a page's targets."""
    rows = pages.select("*", F.posexplode(urls).alias("k", "to"))
    kind = F.lit(kind) if isinstance(kind, str) else kind
    pdf = F.lit(pdf) if isinstance(pdf, bool) else pdf
    return rows.select(
        "seed", F.col("url").alias("via"), F.col("to").alias("url"), (F.col("depth") + int(deeper)).alias("depth"), kind.alias("kind"), pdf.alias("hint_pdf"), F.lit(listed).alias("from_listing"),
        F.struct("pos", F.lit(place).alias("place"), "k").alias("at"),
    ).where("kind IS NOT NULL")


def listing_expansion(pages: DataFrame, most_listings: int = 3) -> DataFrame:
    """Return the targets of listing pages: seed, via, url, depth, kind, hint_pdf, from_listing, at.

    ``pages``: seed, url, depth, pos (the order of fetches), page_kind,
    listing_items and pagination_urls (arrays of URLs), pagination_js_only. The
    first ``most_listings`` listings of a seed are expanded to their items (one
    level deeper), all but the last of these also to their other pages (on the
    same level). Where only scripts page, and the listing brought an item that
    no earlier one had, the URLs that may come next are tried.
    """
    listings = pages.where("page_kind = 'listing'")
    nth = F.row_number().over(Window.partitionBy("seed").orderBy("pos"))
    open_ = cut_lineage(listings.withColumn("nth", nth).where(F.col("nth") <= most_listings))
    items = _targets(open_, F.col("listing_items"), "listing_item", 0, listed=True)
    first = items.groupBy("seed", "url").agg(F.min("at.pos").alias("pos"))
    fresh = first.groupBy("seed", "pos").agg(F.count("*").alias("new_items"))
    paged = open_.where(F.col("nth") < most_listings).join(fresh, ["seed", "pos"], "left")
    told = _targets(paged, F.col("pagination_urls"), "pagination", 1, deeper=False, listed=True)
    silent = paged.where((F.size("pagination_urls") == 0) & F.col("pagination_js_only") & (F.coalesce("new_items", F.lit(0)) > 0))
    probes = _targets(silent, U.next_pages("url"), "pagination_probe", 2, deeper=False, listed=True)
    return items.unionByName(told).unionByName(probes)


def followed_links(pages: DataFrame, hints: Iterable[str], exhaustive: bool = False, follow_article_links: bool = True, most_fulltext: int = 5) -> DataFrame:
    """Return the links to follow of pages that are no listings: seed, via, url, depth, kind, hint_pdf, from_listing, at.

    ``pages``: seed, url, depth, pos, page_kind, fulltext_links (array of url,
    kind, same_site), html_links, document_links. Documents are always followed.
    An article leads to its first full texts (on its site, or files), to pages
    below it and to those that look like content; others only if ``exhaustive``.
    Every other page leads to all its links.
    """
    article = F.col("page_kind") == "article"
    rows = pages.where("page_kind <> 'listing'")
    full = rows.where(article).select("*", F.slice("fulltext_links", 1, most_fulltext).alias("full"))
    of_kind = lambda test: F.transform(F.filter("full", test), lambda x: x["url"])
    file = lambda x: x["kind"].isin("pdf", "download")
    out = _targets(full, of_kind(file), "fulltext", 0, pdf=True, listed=True).unionByName(_targets(full, of_kind(lambda x: ~file(x) & x["same_site"]), "fulltext", 0, listed=True))
    out = out.unionByName(_targets(rows, F.col("document_links"), "document_link", 1, pdf=True))
    own = F.concat(F.regexp_replace(U.path("url"), "/+$", ""), F.lit("/"))
    child = (own != "/") & F.startswith(U.path("to"), own)
    content = U.looks_like_content("to", list(hints))
    of_article = F.when(child, "child_page").when(content, "content_link").when(F.lit(exhaustive), "bfs")
    links = F.when(~article | F.lit(follow_article_links), F.col("html_links")).otherwise(F.array().cast("array<string>"))
    return out.unionByName(_targets(rows, links, F.when(article, of_article).otherwise("bfs"), 2))


def discovered(*targets: DataFrame) -> DataFrame:
    """Return each URL of a seed once, as it is first met (by ``at``)."""
    every = targets[0]
    for more in targets[1:]:
        every = every.unionByName(more)
    kept = [c for c in every.columns if c not in ("seed", "url")]
    first = every.groupBy("seed", "url").agg(F.min_by(F.struct(*kept), F.struct("at", "kind")).alias("r"))
    return first.select("seed", "url", *[F.col(f"r.{c}").alias(c) for c in kept])


def closing_reason(pending: Column, fetched: Column, budget: Column, saturated: Column) -> Column:
    """Return why a site's crawl ended: saturation (its reason), the budget of pages, or nothing left."""
    return F.when(saturated.isNotNull(), F.concat(F.lit("saturación: "), saturated)).when((fetched >= budget) & (pending >= 0), OUT_OF_PAGES).otherwise(EXHAUSTED)


def drained(emitted: DataFrame, reasons: DataFrame, site: str = "site") -> DataFrame:
    """Return ledger rows of what was admitted but not fetched (of ``crawl.emission``), with its site's closing reason."""
    left = emitted.where("decision = 'not_fetched'").drop("reason")
    return left.join(reasons, site).select(site, "url", "decision", "reason", "turn")


def seed_closed(seeds: DataFrame) -> DataFrame:
    """Return (seed, decision, reason, terminated) of seeds whose own page could not be used.

    ``seeds``: seed, robots_allowed, throttled, blocked (detail or null), status,
    html (null or empty: nothing came), needs_html (the mode looks at sections).
    """
    code = F.concat(F.lit("http "), F.col("status").cast("string"))
    decision = (
        F.when(~F.coalesce("robots_allowed", F.lit(True)), F.struct(F.lit("robots").alias("d"), F.lit("robots.txt prohíbe la portada").alias("r")))
        .when(F.coalesce("throttled", F.lit(False)), F.struct(F.lit("throttle").alias("d"), F.lit(None).cast("string").alias("r")))
        .when(F.col("blocked").isNotNull(), F.struct(F.lit("blocked").alias("d"), F.col("blocked").alias("r")))
        .when(F.coalesce("status", F.lit(0)) >= 400, F.struct(F.lit("http_error").alias("d"), code.alias("r")))
        .when(F.col("needs_html") & (F.coalesce("html", F.lit("")) == ""), F.struct(F.lit("empty").alias("d"), code.alias("r")))
    )
    rows = seeds.withColumn("c", decision).where("c IS NOT NULL").select("seed", F.col("c.d").alias("decision"), F.col("c.r").alias("reason"))
    why = F.concat(F.lit("portada: "), F.col("decision"), F.coalesce(F.concat(F.lit(" ("), F.col("reason"), F.lit(")")), F.lit("")))
    return rows.withColumn("terminated", why)


def site_aliases(seeds: DataFrame) -> DataFrame:
    """Return (seed, alias): the other host that a seed's own page (seed, final_url) redirects to, which then belongs to its site."""
    host = U.bare_host("final_url")
    return seeds.where((host != "") & (host != U.bare_host("seed"))).select("seed", host.alias("alias")).distinct()


def in_scope(targets: DataFrame, aliases: DataFrame, subdomains: bool = True) -> DataFrame:
    """Return ``targets`` (seed, url) with ``inside``: on the seed's site, or on a host that its own page redirects to."""
    known = aliases.select("seed", F.col("alias").alias("_alias"), F.lit(True).alias("_known"))
    rows = targets.withColumn("_host", U.bare_host("url")).join(known, (targets["seed"] == known["seed"]) & (F.col("_host") == F.col("_alias")), "left").drop(known["seed"])
    return rows.withColumn("inside", U.same_site("url", F.col("seed"), subdomains) | F.coalesce("_known", F.lit(False))).drop("_host", "_alias", "_known")


def throttled(visits: DataFrame, quota: int = 500, delay: float = 2.0) -> DataFrame:
    """Return ``visits`` (url, ts, blocked; ts is when a visit is asked for) with turn, admitted and begins, by site.

    A site admits ``quota`` visits, and none after one that met a block. Visits
    keep a distance of ``delay`` seconds, so the i-th begins at the largest of
    ts(j) + (i - j) * delay over those up to it: a running maximum, no loop.
    """
    site = Window.partitionBy("_site").orderBy("ts", "url")
    before = site.rowsBetween(Window.unboundedPreceding, -1)
    rows = visits.withColumn("_site", U.netloc("url")).withColumn("turn", F.row_number().over(site))
    latched = F.coalesce(F.max(F.col("blocked").cast("int")).over(before), F.lit(0)) == 1
    rows = rows.withColumn("admitted", (F.col("turn") <= quota) & ~latched)
    slack = F.max(F.col("ts") - F.col("turn") * delay).over(site.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("begins", F.when(F.col("admitted"), slack + F.col("turn") * delay)).drop("_site")


def crawl_mode(mode: Column, closed: Column, binary: Column, sections: Column, strategy: Column) -> Column:
    """Return how a seed is walked: closed, classic, sections, or directed (a file as seed).

    ``mode`` is what the settings ask for: sections, auto, or anything else.
    Without sections the classic way is taken; ``auto`` follows the plan's
    ``strategy``, and only a plan for sections looks at sections.
    """
    by_sections = F.when(sections > 0, "sections").otherwise("classic")
    auto = F.when(binary, "directed").when(strategy == "sections", by_sections).otherwise("classic")
    return F.when(mode.isin("sections", "auto") & closed, "closed").when(mode == "sections", by_sections).when(mode == "auto", auto).otherwise("classic")


def plan_overrides(strategy: Column) -> Column:
    """Return what a plan changes in the settings, as a map; ``mode`` itself is never passed on."""
    none = F.create_map().cast("map<string, string>")
    out = None
    for name, changes in OVERRIDES.items():
        pairs = [F.lit(x) for k, v in changes.items() if k != "mode" for x in (k, v)]
        value = F.create_map(*pairs).cast("map<string, string>") if pairs else none
        out = F.when(strategy == name, value) if out is None else out.when(strategy == name, value)
    return out


def section_tree(roots: DataFrame, found: DataFrame, budget: int = 8, levels: int = 1, most_children: int = 4) -> DataFrame:
    """Return (seed, label, url, budget, level): the sections that are walked, each once for each way to it.

    ``roots``: seed, name, url of the sections of home pages. ``found``: via, name,
    url, rank of the sections that a section's own page names. Those whose path
    extends the section's are its children, the first ``most_children`` by rank;
    a child has half of its parent's budget, two pages at least, and the label
    ``parent > child``. A root is always walked, even if it was met before as a link.
    """
    level = roots.select("seed", F.col("name").alias("label"), "url", F.lit(budget).alias("budget"), F.lit(1).alias("level"))
    out = level
    bare = lambda c: F.regexp_replace(U.path(c), "/+$", "")
    for n in range(2, levels + 1):
        ways = level.join(found.select(F.col("via").alias("_via"), "name", F.col("url").alias("to"), "rank"), F.col("url") == F.col("_via"))
        ways = ways.where(F.startswith(U.path("to"), F.concat(bare("url"), F.lit("/"))) & (bare("to") != bare("url")))
        order = Window.partitionBy("seed", "label", "url").orderBy("rank", "to")
        kept = ways.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= most_children)
        half = F.greatest(F.lit(2), F.floor(F.col("budget") / 2).cast("int"))
        level = cut_lineage(kept.select("seed", F.concat_ws(" > ", "label", "name").alias("label"), F.col("to").alias("url"), half.alias("budget"), F.lit(n).alias("level")))
        out = out.unionByName(level)
    return out


def pagination_walk(seeds: DataFrame, pages: DataFrame, most_pages: int = 30, patience: int = 3) -> DataFrame:
    """Return (seed, n, url, items, new_items, synthesized): the pages that a probe of each seed visits, in order.

    ``pages``: url, status, items and pagination_urls (arrays of URLs) stand for
    the site. A probe takes the first URL that waits and has not been visited;
    answers of 400 and above (or none) are passed over. What a page declares waits
    next; if it declares nothing new and brought new items, the URLs that may
    come next do. It stops after ``patience`` pages in a row (after the first)
    without new items, after ``most_pages``, or when nothing waits. All seeds
    advance at once: each step is a join of one row for each seed.
    """
    urls = F.array().cast("array<string>")
    known = pages.select(F.col("url").alias("_url"), "status", F.col("items").alias("_items"), "pagination_urls")
    state = seeds.select(F.col("url").alias("seed"), F.array(F.struct(F.col("url").alias("u"), F.lit(False).alias("s"))).alias("queue"), urls.alias("visited"), urls.alias("seen"), F.lit(0).alias("n"), F.lit(0).alias("barren"))
    out = None
    for _ in range(4 * most_pages):
        state = state.withColumn("queue", F.filter("queue", lambda q: ~F.array_contains("visited", q["u"])))
        state = cut_lineage(state.where((F.size("queue") > 0) & (F.col("n") < most_pages) & (F.col("barren") < patience)))
        if state.isEmpty():
            break
        rows = state.withColumn("at", F.col("queue")[0]).withColumn("queue", F.slice("queue", 2, 1_000_000)).join(known, F.col("at.u") == F.col("_url"), "left")
        good = F.coalesce(F.col("status") < 400, F.lit(False))
        rows = rows.withColumns({"visited": F.concat("visited", F.array("at.u")), "good": good, "fresh": F.when(good, F.array_except("_items", "seen")).otherwise(urls)})
        new = F.size("fresh")
        declared = F.filter("pagination_urls", lambda u: ~F.array_contains("visited", u))
        tried = F.filter(U.next_pages(F.col("at.u")), lambda u: ~F.array_contains("visited", u))
        as_queue = lambda found, made: F.transform(found, lambda u: F.struct(u.alias("u"), F.lit(made).alias("s")))
        more = F.when(F.size(declared) > 0, as_queue(declared, False)).when(new > 0, as_queue(tried, True)).otherwise(F.array().cast("array<struct<u: string, s: boolean>>"))
        rows = rows.withColumns({"n2": F.col("n") + F.col("good").cast("int"), "barren2": F.when(~F.col("good"), F.col("barren")).when((F.col("n") > 0) & (new == 0), F.col("barren") + 1).otherwise(0)})
        rows = cut_lineage(rows.withColumn("waiting", F.when(F.col("good"), F.array_distinct(F.concat("queue", more))).otherwise(F.col("queue"))))
        step = rows.where("good").select("seed", F.col("n2").alias("n"), F.col("at.u").alias("url"), F.size("_items").alias("items"), new.alias("new_items"), F.col("at.s").alias("synthesized"))
        out = step if out is None else out.unionByName(step)
        state = rows.select("seed", F.col("waiting").alias("queue"), "visited", F.concat("seen", "fresh").alias("seen"), F.col("n2").alias("n"), F.col("barren2").alias("barren"))
    if out is None:
        return seeds.select(F.col("url").alias("seed"), F.lit(0).alias("n"), "url", F.lit(0).alias("items"), F.lit(0).alias("new_items"), F.lit(False).alias("synthesized")).limit(0)
    return out
