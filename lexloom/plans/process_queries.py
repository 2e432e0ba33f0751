"""How sites are walked and what the panel shows, over tables derived by number."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexloom.functions import url as U
from lexloom.operators import coverage, crawl, expansion
from lexloom.plans.fixtures import LEDGER_SQL, OUTCOME_LIST, ledger
from lexloom.session import shared_folder, table
from lexloom.streaming import panel

HINTS = ["/noticia/"]


def _events(spark, sf):
    return table(spark, sf, "events").withColumn("k", F.col("event_id"))


def _decided(spark, sf):
    k = F.col("event_id")
    rows = table(spark, sf, "events").select(
        k, (k % 31 == 0).alias("already_saved"), (k % 29 != 0).alias("robots_allowed"), (k % 27 == 0).alias("throttled"), (k % 25 == 0).alias("blocked"), F.when(k % 23 == 0, 404).otherwise(200).alias("status"),
        (k % 19 == 0).alias("is_pdf"), (k % 18 == 0).alias("is_word"), (k % 2 == 0).alias("too_large"), F.when(k % 17 == 0, "").otherwise("<p>").alias("html"), (k % 16 != 0).alias("same_site"),
        F.when(k % 5 == 0, "listing").otherwise("article").alias("page_kind"), ((k % 10) / 10).alias("link_density"), (k % 400).alias("words"), (k % 3 == 0).alias("repeats"), (k % 13 == 0).alias("extract_fails"),
    )
    return crawl.page_decision(rows).select("event_id", "decision")


DECISIONS_SQL = (
    "SELECT k AS event_id, CASE WHEN k % 31 = 0 THEN 'already_saved' WHEN k % 29 = 0 THEN 'robots' WHEN k % 27 = 0 THEN 'throttle' WHEN k % 25 = 0 THEN 'blocked' WHEN k % 23 = 0 THEN 'http_error' WHEN k % 19 = 0 OR k % 18 = 0 THEN CASE WHEN k % 2 = 0 THEN 'too_large' WHEN k % 13 = 0 THEN 'extract_error' WHEN k % 3 = 0 THEN 'duplicate' ELSE 'saved' END "
    "WHEN k % 17 = 0 THEN 'empty' WHEN k % 16 = 0 THEN 'offsite_html' WHEN k % 5 = 0 THEN 'listing' WHEN k % 13 = 0 THEN 'extract_error' WHEN k % 400 < 80 THEN 'no_document' WHEN k % 10 = 9 THEN 'hub' WHEN k % 3 = 0 THEN 'duplicate' ELSE 'saved' END AS decision FROM (SELECT event_id AS k FROM events)"
)


def _walked(spark, sf):
    """Fetched pages in order: every third is a listing of three items of a site's hundred, some with a pager."""
    k = F.col("k")
    site = F.concat(F.lit("https://s"), k % 5, F.lit(".org"))
    page = F.concat(site, F.lit("/l/"), k)
    items = F.transform(F.array(*[F.lit(j) for j in range(3)]), lambda j: F.concat(site, F.lit("/d/"), (k * 3 + j) % 97))
    empty = F.array().cast("array<string>")
    link = lambda t, k_, s: F.struct(t.alias("url"), F.lit(k_).alias("kind"), F.lit(s).alias("same_site"))
    return _events(spark, sf).select(
        F.concat(site, F.lit("/")).alias("seed"), page.alias("url"), (k % 4).cast("int").alias("depth"), k.alias("pos"), F.when(k % 3 == 0, "listing").when(k % 3 == 1, "article").otherwise("navigation").alias("page_kind"),
        items.alias("listing_items"), F.when(k % 2 == 0, F.array(F.concat(page, F.lit("?page=2")))).otherwise(empty).alias("pagination_urls"), (k % 4 == 3).alias("pagination_js_only"),
        F.array(link(F.concat(page, F.lit(".pdf")), "pdf", True), link(F.lit("http://o.org/x"), "fulltext", False), link(F.concat(page, F.lit("/full")), "fulltext", True), link(F.lit("http://o.org/y"), "download", False)).alias("fulltext_links"),
        F.array(F.concat(page, F.lit("/part")), F.concat(site, F.lit("/noticia/"), k), F.concat(site, F.lit("/other"))).alias("html_links"), F.array(F.concat(page, F.lit(".docx"))).alias("document_links"),
    )


_W = "w AS (SELECT event_id AS k, 'https://s' || (event_id % 5) || '.org' AS site, 'https://s' || (event_id % 5) || '.org/l/' || event_id AS url, (event_id % 4)::INT AS depth FROM events)"
EXPANSION_SQL = (
    f"WITH {_W}, o AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY k) AS nth FROM w WHERE k % 3 = 0), open AS (SELECT * FROM o WHERE nth <= 20), "
    "i AS (SELECT site, k, nth, depth, url AS via, site || '/d/' || ((k * 3 + j) % 97) AS url FROM open, (SELECT unnest(range(0, 3)) AS j)), fresh AS (SELECT site, k, count(*) AS n FROM (SELECT site, url, min(k) AS k FROM i GROUP BY ALL) GROUP BY ALL), "
    "probe AS (SELECT o.* FROM open o JOIN fresh USING (site, k) WHERE nth < 20 AND k % 4 = 3), t AS ("
    "SELECT site, via, url, depth + 1 AS depth, 'listing_item' AS kind FROM i UNION ALL SELECT site, url, url || '?page=2', depth, 'pagination' FROM open WHERE nth < 20 AND k % 2 = 0 "
    "UNION ALL SELECT site, url, url || '/page/2/', depth, 'pagination_probe' FROM probe UNION ALL SELECT site, url, url || '?page=2', depth, 'pagination_probe' FROM probe UNION ALL SELECT site, url, url || '?p=2', depth, 'pagination_probe' FROM probe) "
    "SELECT site || '/' AS seed, via, url, depth::INT AS depth, kind, true AS from_listing FROM t"
)
FOLLOWED_SQL = (
    f"WITH {_W}, p AS (SELECT *, k % 3 = 1 AS article FROM w WHERE k % 3 <> 0), t AS ("
    "SELECT site, url AS via, url || '.pdf' AS url, depth, 'fulltext' AS kind, true AS hint_pdf FROM p WHERE article UNION ALL SELECT site, url, 'http://o.org/y', depth, 'fulltext', true FROM p WHERE article UNION ALL SELECT site, url, url || '/full', depth, 'fulltext', false FROM p WHERE article "
    "UNION ALL SELECT site, url, url || '.docx', depth, 'document_link', true FROM p UNION ALL SELECT site, url, url || '/part', depth, CASE WHEN article THEN 'child_page' ELSE 'bfs' END, false FROM p "
    "UNION ALL SELECT site, url, site || '/noticia/' || k, depth, CASE WHEN article THEN 'content_link' ELSE 'bfs' END, false FROM p UNION ALL SELECT site, url, site || '/other', depth, 'bfs', false FROM p WHERE NOT article) "
    "SELECT site || '/' AS seed, via, url, (depth + 1)::INT AS depth, kind, hint_pdf FROM t"
)


def _closed(spark, sf):
    k = F.col("k")
    rows = _events(spark, sf).select(
        F.concat(F.lit("https://s"), k).alias("seed"), (k % 7 != 0).alias("robots_allowed"), (k % 5 == 0).alias("throttled"), F.when(k % 3 == 0, "captcha").alias("blocked"), F.when(k % 4 == 1, 404).otherwise(200).alias("status"),
        F.when(k % 2 == 0, "<p>").otherwise("").alias("html"), (k % 11 < 6).alias("needs_html"),
    )
    return expansion.seed_closed(rows)


CLOSED_SQL = (
    "WITH d AS (SELECT event_id AS k, CASE WHEN event_id % 7 = 0 THEN 'robots' WHEN event_id % 5 = 0 THEN 'throttle' WHEN event_id % 3 = 0 THEN 'blocked' WHEN event_id % 4 = 1 THEN 'http_error' WHEN event_id % 11 < 6 AND event_id % 2 = 1 THEN 'empty' END AS decision FROM events), "
    "r AS (SELECT *, CASE decision WHEN 'robots' THEN 'robots.txt prohíbe la portada' WHEN 'blocked' THEN 'captcha' WHEN 'http_error' THEN 'http 404' WHEN 'empty' THEN 'http 200' END AS reason FROM d WHERE decision IS NOT NULL) "
    "SELECT 'https://s' || k AS seed, decision, reason, 'portada: ' || decision || coalesce(' (' || reason || ')', '') AS terminated FROM r"
)


def _modes(spark, sf):
    k = F.col("k")
    pick = lambda values, at: F.get(F.array(*[F.lit(v) for v in values]), at.cast("int"))
    strategy = pick(list(expansion.OVERRIDES), k % 5)
    mode = expansion.crawl_mode(pick(["sections", "auto", None], k % 3), k % 17 == 0, k % 13 == 0, k % 4, strategy)
    changes = expansion.plan_overrides(strategy)
    return _events(spark, sf).select("event_id", mode.alias("mode"), F.concat_ws(",", F.sort_array(F.transform(F.map_entries(changes), lambda e: F.concat(e["key"], F.lit("="), e["value"])))).alias("changes"))


MODES_SQL = (
    "SELECT event_id, CASE WHEN event_id % 3 < 2 AND event_id % 17 = 0 THEN 'closed' WHEN event_id % 3 = 0 THEN CASE WHEN event_id % 4 > 0 THEN 'sections' ELSE 'classic' END "
    "WHEN event_id % 3 = 1 AND event_id % 13 = 0 THEN 'directed' WHEN event_id % 3 = 1 AND event_id % 5 = 2 AND event_id % 4 > 0 THEN 'sections' ELSE 'classic' END AS mode, "
    "(['use_sitemaps=false', 'follow_article_links=false,use_sitemaps=false', '', 'use_sitemaps=true', 'use_sitemaps=false'])[event_id % 5 + 1] AS changes FROM events"
)


def _aliases(spark, sf):
    k = F.col("k")
    seed = F.concat(F.lit("https://www.s"), k % 50, F.lit(".org/"))
    final = F.when(k % 50 % 3 == 0, F.concat(F.lit("https://new"), k % 50, F.lit(".net/home"))).otherwise(F.concat(F.lit("https://s"), k % 50, F.lit(".org/")))
    rows = _events(spark, sf)
    found = expansion.site_aliases(rows.select(seed.alias("seed"), final.alias("final_url")))
    targets = rows.select("event_id", seed.alias("seed"), F.concat(F.lit("https://new"), k % 60, F.lit(".net/x")).alias("url"))
    return expansion.in_scope(targets, found).select("event_id", "inside")


def _tree(spark, sf):
    """Sections by number: each page names five, of which those with an even number extend its path."""
    k = F.col("page_id")
    pages = table(spark, sf, "pages").select("page_id")
    home = F.concat(F.lit("https://s.org/a"), k)
    roots = pages.select(F.concat(F.lit("https://s"), k % 3).alias("seed"), F.concat(F.lit("A"), k).alias("name"), home.alias("url"))
    subs = pages.select(home.alias("via"), F.explode(F.sequence(F.lit(0), F.lit(5))).alias("j"))
    place = F.when(F.col("j") % 6 < 5, F.concat("via", F.lit("/b"), "j")).otherwise(F.concat(F.lit("https://s.org/elsewhere/"), "j"))
    one = subs.select("via", F.concat(F.lit("B"), "j").alias("name"), place.alias("url"), "j")
    two = one.select(F.col("url").alias("via"), F.concat("name", F.lit("C")).alias("name"), F.concat("url", F.lit("/c/")).alias("url"), "j")
    found = one.unionByName(two).withColumn("rank", F.col("j") * 7 % 6)
    return expansion.section_tree(roots, found, 9, 3, 4)


TREE_SQL = (
    "WITH r AS (SELECT page_id, 'https://s' || (page_id % 3) AS seed, 'A' || page_id AS label, 'https://s.org/a' || page_id AS url FROM pages), "
    "b AS (SELECT seed, label || ' > B' || j AS label, url || '/b' || j AS url, j FROM r, (SELECT unnest(range(0, 5)) AS j) WHERE j <= 3), "
    "c AS (SELECT seed, label || ' > B' || j || 'C' AS label, url || '/c/' AS url FROM b) "
    "SELECT seed, label, url, 9 AS budget, 1 AS level FROM r UNION ALL SELECT seed, label, url, 4, 2 FROM b UNION ALL SELECT seed, label, url, 2, 3 FROM c"
)


def _reasons(spark, sf):
    k = F.col("k")
    why = expansion.closing_reason(k % 5, k % 100, F.lit(90), F.when(k % 7 == 0, F.concat(k % 30, F.lit(" páginas"))))
    return _events(spark, sf).select("event_id", why.alias("reason"))


def _drained(spark, sf):
    rows = _walked(spark, sf).select(F.col("seed").alias("site"), "url", F.lit(None).cast("string").alias("reason"), F.lit(1).alias("tier"), "pos")
    reasons = rows.select("site").distinct().withColumn("reason", F.concat(F.lit(expansion.OUT_OF_PAGES), F.lit(" "), "site"))
    return expansion.drained(crawl.emission(rows, 40, site="site"), reasons).select("site", "url", "reason")


def _probe(spark, sf):
    """Sites of 12 pages by number: some declare the next page, some page by scripts, some repeat themselves."""
    k, n = F.col("page_id"), F.col("n")
    numbers = table(spark, sf, "pages").select("page_id", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("n"))
    base = F.concat(F.lit("https://p"), k, F.lit(".org/l"))
    at = lambda m: F.when(m == 1, base).otherwise(F.concat(base, F.lit("?page="), m.cast("string")))
    items = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda j: F.concat((F.least(n, k % 9 + 1) * 5 + j).cast("string")))
    told = F.when((k % 2 == 0) & (n < 12), F.array(at(n + 1))).otherwise(F.array().cast("array<string>"))
    pages = numbers.select(at(n).alias("url"), F.lit(200).alias("status"), items.alias("items"), told.alias("pagination_urls"))
    seeds = table(spark, sf, "pages").select(base.alias("url"))
    return expansion.pagination_walk(seeds, pages, 10)


#: Page n of site k holds the items of page min(n, k % 9 + 1): after that nothing is new. Sites of odd number declare no page, and the synthesised ?page= is found as long as the page before was new.
PROBE_SQL = (
    "WITH w AS (SELECT page_id AS k, n, page_id % 9 + 1 AS last FROM pages, (SELECT unnest(range(1, 13)) AS n)), v AS (SELECT *, CASE WHEN k % 2 = 0 THEN least(10, last + 3) ELSE least(10, last + 1) END AS stop FROM w) "
    "SELECT 'https://p' || k || '.org/l' AS seed, n::INT AS n, 'https://p' || k || '.org/l' || CASE WHEN n = 1 THEN '' ELSE '?page=' || n END AS url, 5 AS items, CASE WHEN n <= last THEN 5 ELSE 0 END AS new_items, k % 2 = 1 AND n > 1 AS synthesized FROM v WHERE n <= stop"
)


def _bfs(spark, sf):
    pages = table(spark, sf, "pages").select("page_id")
    name = lambda c: F.concat(F.lit("http://a.org/"), c.cast("string"))
    steps = F.explode(F.array(F.col("page_id") * 2 + 1, F.col("page_id") * 2 + 2, F.floor(F.col("page_id") / 2)))
    links = pages.select(name(F.col("page_id")).alias("via"), steps.alias("to")).select("via", name(F.col("to")).alias("url"))
    return crawl.breadth_first(links, spark.createDataFrame([("http://a.org/0",)], "url string"), 4)


def _rows(spark, sf):
    """The panel's row of each domain from the derived ledger, with every saved page as a document of 900 characters a unit of its number."""
    visits = ledger(spark, sf)
    docs = visits.where("decision = 'saved'").select(U.bare_host("seed").alias("domain"), "ts", (F.col("seq") % 100).alias("words"), (F.col("seq") % 50 * 9).alias("chars"), F.when(F.col("seq") % 3 == 0, "pdf").when(F.col("seq") % 3 == 1, "html_static").otherwise("docx").alias("source_type"))
    seeds = visits.select(U.bare_host("seed").alias("domain")).distinct().unionByName(spark.createDataFrame([("never.example",), ("closed.example",)], "domain string"))
    done = spark.createDataFrame([("www.site3.example",), ("closed.example",)], "domain string")
    return panel.domain_rows(visits, docs, seeds, done, 1706500000.0, quiet=3600.0)


ROWS_SQL = (
    f"{LEDGER_SQL}, d AS (SELECT host AS domain, count(*) FILTER (decision = 'enqueued') AS seen, count(*) FILTER (decision IN {OUTCOME_LIST}) AS fetched, count(*) FILTER (decision = 'saved') AS saved, "
    "coalesce(sum(seq % 100) FILTER (decision = 'saved'), 0)::BIGINT AS words, coalesce(sum(seq % 50 * 9 // 4) FILTER (decision = 'saved'), 0)::BIGINT AS tokens, count(*) FILTER (decision = 'duplicate') AS dup, count(*) FILTER (decision IN ('blocked', 'http_error', 'extract_error', 'too_large', 'empty', 'offsite_html', 'robots')) AS fail, "
    "count(*) FILTER (decision = 'listing') AS listing, count(*) FILTER (decision IN ('hub', 'no_document')) AS discarded, count(*) FILTER (decision = 'saved' AND seq % 3 = 0) AS pdf, count(*) FILTER (decision = 'saved' AND seq % 3 = 1) AS html, count(*) FILTER (decision = 'saved' AND seq % 3 = 2) AS docx, "
    "max(ts) FILTER (decision = 'saved') - min(ts) FILTER (decision = 'saved') AS span, max(ts) AS last, arg_max(url, seq) AS last_url, arg_max(decision, seq) AS last_decision FROM visits GROUP BY host), "
    "rows AS (SELECT domain, CASE WHEN domain = 'site3.example' THEN 'terminado' WHEN 1706500000.0 - last < 3600.0 THEN 'activo' ELSE 'en pausa' END AS status, seen, fetched, saved, words, tokens, dup, fail, listing, discarded, pdf, html, docx, CASE WHEN span >= 600 THEN round(tokens / span, 1) END AS tps, last_url, last_decision, '' AS seed_close FROM d "
    "UNION ALL SELECT 'never.example', 'pendiente', 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, NULL, NULL, NULL, '' UNION ALL SELECT 'closed.example', 'terminado', 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, 0, NULL, NULL, NULL, '')"
)


def _figures(spark, sf):
    rows = _rows(spark, sf)
    return panel.key_figures({"one": rows, "two": rows.where(F.col("domain").rlike("[02468].example$"))})


_f = "count(*) AS domains, count(*) FILTER (status = 'terminado') AS done, count(*) FILTER (status = 'activo') AS active, count(*) FILTER (status = 'en pausa') AS paused, count(*) FILTER (status = 'pendiente') AS pending, sum(saved)::BIGINT AS saved, sum(words)::BIGINT AS words, sum(tokens)::BIGINT AS tokens, sum(fetched)::BIGINT AS fetched, sum(fail)::BIGINT AS fail"
FIGURES_SQL = f"WITH {ROWS_SQL}, e AS (SELECT 'one' AS corpus, * FROM rows UNION ALL SELECT 'two', * FROM rows WHERE regexp_matches(domain, '[02468].example$')) SELECT corpus, {_f} FROM e GROUP BY corpus UNION ALL SELECT '*', {_f} FROM e"


def _documents(spark, sf):
    rows = ledger(spark, sf).where("decision = 'saved'")
    kind = F.when(F.col("seq") % 3 == 0, "pdf").when(F.col("seq") % 3 == 1, "html_static").otherwise("docx")
    return rows.select(F.timestamp_seconds("ts").alias("time"), U.bare_host("seed").alias("domain"), kind.alias("source_type"), (F.col("seq") % 100).alias("words"), (F.col("seq") % 50 * 9).alias("chars"))


def _per_minute(spark, sf):
    return panel.documents_per_minute(_documents(spark, sf)).select(F.unix_timestamp("start").alias("start"), "domain", "kind", "docs", "words", "tokens")


def _series(spark, sf):
    return panel.minute_series(panel.documents_per_minute(_documents(spark, sf)), 1706500000.0)


_MINUTES = f"{LEDGER_SQL}, s AS (SELECT *, floor(ts / 60)::BIGINT AS minute, seq % 50 * 9 // 4 AS tokens FROM visits WHERE decision = 'saved')"


def _stream(spark, sf):
    """The events as a stream."""
    schema = table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet*").parquet(sf)


def _folder(spark, name):
    import uuid

    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _streamed_minutes(spark, sf):
    rows = _stream(spark, sf).select(F.col("ts").cast("timestamp").alias("time"), "event_type", "value")
    out = panel.to_table(panel.per_minute(rows, width="1 minute", keys=("event_type",)), _folder(spark, "minutes"))
    return out.select(F.unix_timestamp("start").alias("start"), "event_type", "n")


def _streamed_new(spark, sf):
    """Contents by number, each of which comes eleven times or so: the first of each stays."""
    rows = _stream(spark, sf).select((F.col("event_id") % 900).cast("string").alias("content_hash"))
    return panel.to_table(panel.new_contents(rows), _folder(spark, "new"), "append")


def _streamed_saturation(spark, sf):
    """The last state of each seed over the stream of visits: fetches, and those since the last that yielded."""
    k = F.col("event_id")
    decision = F.when(k % 4 == 0, "enqueued").when(k < 5000, "saved").when(k % 7 == 0, "listing").otherwise("hub")
    rows = _stream(spark, sf).select(F.concat(F.lit("s"), k % 6).alias("seed"), k.cast("double").alias("ts"), decision.alias("decision"), F.when(k % 5 == 0, "new_items").alias("kind"))
    return panel.to_table(panel.saturation(rows, 25), _folder(spark, "saturation"), "update")


SATURATION_SQL = (
    "WITH v AS (SELECT event_id AS k, 's' || (event_id % 6) AS seed, CASE WHEN event_id % 4 = 0 THEN 'enqueued' WHEN event_id < 5000 THEN 'saved' WHEN event_id % 7 = 0 THEN 'listing' ELSE 'hub' END AS decision FROM events), f AS (SELECT *, decision = 'saved' OR (decision = 'listing' AND k % 5 = 0) AS yields FROM v WHERE decision <> 'enqueued'), "
    "m AS (SELECT seed, count(*) AS fetched, coalesce(max(k) FILTER (yields), -1) AS last FROM f GROUP BY seed), b AS (SELECT m.seed, any_value(fetched) AS fetched, count(*) FILTER (k > last) AS barren FROM f JOIN m USING (seed) GROUP BY m.seed) SELECT seed, fetched, barren, CASE WHEN barren >= 25 THEN 'saturated' ELSE 'open' END AS state FROM b"
)

def _throttled(spark, sf):
    """Visits to 50 sites by number, some of which meet a block."""
    k = F.col("k")
    rows = _events(spark, sf).select("event_id", F.concat(F.lit("https://t"), k % 50, F.lit(".org/"), F.lpad(k.cast("string"), 9, "0")).alias("url"), F.floor(k / 40).cast("double").alias("ts"), (k % 3001 == 3000).alias("blocked"))
    return expansion.throttled(rows, 150, 2.0).select("event_id", "turn", "admitted", "begins")


THROTTLED_SQL = (
    "WITH v AS (SELECT event_id AS k, event_id % 50 AS site, floor(event_id / 40)::DOUBLE AS ts, event_id % 3001 = 3000 AS blocked FROM events), n AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY ts, k) AS turn, coalesce(max(blocked::INT) OVER (PARTITION BY site ORDER BY ts, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS latch FROM v), "
    "pairs AS (SELECT a.k, max(b.ts + (a.turn - b.turn) * 2.0) AS begins FROM n a JOIN n b ON a.site = b.site AND b.turn <= a.turn GROUP BY a.k) SELECT k AS event_id, turn::INT AS turn, turn <= 150 AND latch = 0 AS admitted, CASE WHEN turn <= 150 AND latch = 0 THEN begins END AS begins FROM n JOIN pairs USING (k)"
)

QUERIES = {
    "throttled_visits": (_throttled, THROTTLED_SQL),
    "page_decision_rows": (_decided, DECISIONS_SQL),
    "listing_expansion": (lambda spark, sf: expansion.listing_expansion(_walked(spark, sf), 20).select("seed", "via", "url", "depth", "kind", "from_listing"), EXPANSION_SQL),
    "followed_links": (lambda spark, sf: expansion.followed_links(_walked(spark, sf), HINTS).select("seed", "via", "url", "depth", "kind", "hint_pdf"), FOLLOWED_SQL),
    "discovered_targets": (
        lambda spark, sf: expansion.discovered(expansion.listing_expansion(_walked(spark, sf), 20)).select("seed", "url"),
        f"SELECT DISTINCT seed, url FROM ({EXPANSION_SQL})",
    ),
    "closed_seeds": (_closed, CLOSED_SQL),
    "crawl_modes": (_modes, MODES_SQL),
    "redirect_scope": (_aliases, "SELECT event_id, event_id % 60 = event_id % 50 AND event_id % 50 % 3 = 0 AS inside FROM events"),
    "section_tree": (_tree, TREE_SQL),
    "closing_reasons": (_reasons, "SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'saturación: ' || (event_id % 30) || ' páginas' WHEN event_id % 100 >= 90 THEN 'presupuesto de páginas agotado' ELSE 'frontera agotada' END AS reason FROM events"),
    "drained_targets": (_drained, f"WITH {_W}, t AS (SELECT site || '/' AS site, url, row_number() OVER (PARTITION BY site ORDER BY k) AS turn FROM w) SELECT site, url, 'presupuesto de páginas agotado ' || site AS reason FROM t WHERE turn > 40"),
    "pagination_walk": (_probe, PROBE_SQL),
    "breadth_first": (
        _bfs,
        "WITH RECURSIVE l AS (SELECT page_id AS a, unnest([page_id * 2 + 1, page_id * 2 + 2, page_id // 2]) AS b FROM pages), r AS (SELECT 0::BIGINT AS p, 0 AS depth UNION SELECT l.b, depth + 1 FROM r JOIN l ON l.a = r.p WHERE depth < 4) SELECT 'http://a.org/' || p AS url, min(depth)::INT AS depth FROM r GROUP BY p",
    ),
    "panel_rows": (_rows, f"WITH {ROWS_SQL} SELECT * FROM rows"),
    "panel_key_figures": (_figures, FIGURES_SQL),
    "documents_per_minute": (_per_minute, f"WITH {_MINUTES} SELECT minute * 60 AS start, host AS domain, (['pdf', 'html', 'docx'])[seq % 3 + 1] AS kind, count(*) AS docs, sum(seq % 100)::BIGINT AS words, sum(tokens)::BIGINT AS tokens FROM s GROUP BY ALL"),
    "minute_series": (_series, f"WITH {_MINUTES}, c AS (SELECT unnest(range(1706500000 // 60 - 119, 1706500000 // 60 + 1)) AS minute) SELECT c.minute, count(s.seq) AS docs, coalesce(sum(tokens), 0)::BIGINT AS tokens FROM c LEFT JOIN s ON s.minute = c.minute GROUP BY c.minute"),
    "stream_events_per_minute": (_streamed_minutes, "SELECT (floor(epoch(ts) / 60) * 60)::BIGINT AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2"),
    "stream_new_contents": (_streamed_new, "SELECT DISTINCT (event_id % 900)::VARCHAR AS content_hash FROM events"),
    "stream_saturation": (_streamed_saturation, SATURATION_SQL),
    "index_reconciled": (
        lambda spark, sf: coverage.funnel(coverage.collapse(ledger(spark, sf), index_urls=ledger(spark, sf).where("decision = 'saved' AND seq % 3 = 0").select("url"))),
        f"WITH {LEDGER_SQL}, known AS (SELECT DISTINCT replace(url, '://www.', '://') AS key FROM visits WHERE decision = 'saved' AND seq % 3 = 0), v AS (SELECT * REPLACE (CASE WHEN decision = 'saved' AND replace(url, '://www.', '://') NOT IN (SELECT key FROM known) THEN 'duplicate' ELSE decision END AS decision), replace(url, '://www.', '://') AS key FROM visits), "
        f"u AS (SELECT key, CASE WHEN bool_or(decision = 'saved') THEN 'saved' ELSE arg_max(decision, seq) FILTER (decision IN {OUTCOME_LIST}) END AS f, arg_max(reason, seq) FILTER (decision = 'not_fetched') AS nf, arg_max(reason, seq) FILTER (decision = 'rejected') AS r FROM v GROUP BY key) "
        "SELECT coalesce(f, CASE WHEN nf IS NOT NULL THEN 'not_fetched' END, 'rejected:' || r, 'enqueued_only') AS outcome, count(*) AS n_urls FROM u GROUP BY 1",
    ),
}
