"""Ledger, coverage, frontier, plan, provenance and panel over derived crawl tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lexloom.functions import text as T
from lexloom.functions import url as U
from lexloom.functions import vocab
from lexloom.operators import coverage, crawl, report
from lexloom.plans.fixtures import COLLAPSED_SQL, INVENTORY_SQL, LEDGER_SQL, OUTCOME_LIST, SITES, TREE_SQL, inventories, ledger, provenance
from lexloom.session import shared_folder, table
from lexloom.streaming import panel

FAILURE_LIST = "('blocked', 'http_error', 'extract_error', 'too_large', 'empty', 'offsite_html', 'robots')"
BOTH = f"{LEDGER_SQL}, {COLLAPSED_SQL}, {INVENTORY_SQL}"
MISSING_SQL = (
    f"{BOTH}, missing AS (SELECT i.key, i.source, CASE WHEN c.key IS NULL THEN 'no_vista' WHEN \"fetch\" IS NOT NULL THEN 'descartada' WHEN not_fetched IS NOT NULL THEN 'sin_descargar' WHEN rejected IS NOT NULL THEN 'rechazada' ELSE 'sin_descargar' END AS stage, "
    "CASE WHEN c.key IS NULL THEN 'el crawl nunca llegó a esta URL' ELSE coalesce(\"fetch\" || coalesce(' (' || reason || ')', ''), not_fetched, rejected, 'quedó encolada') END AS why, "
    "regexp_matches(i.key, '(?i)\\.(pdf|docx?|odt|rtf)$') AS document FROM classed i LEFT JOIN collapsed c USING (key) WHERE class = 'content' AND coalesce(\"fetch\", '') <> 'saved')"
)


def _by_url(spark, sf):
    return coverage.collapse(ledger(spark, sf))


def _inventory(spark, sf):
    return coverage.union_inventories(inventories(spark, sf))


def _missing(spark, sf):
    return coverage.missing(_inventory(spark, sf), _by_url(spark, sf))


def _targets(spark, sf):
    """Links to pages: depth, hints and origin by number; every seventh repeats an earlier one."""
    e = table(spark, sf, "events")
    k = F.when(F.col("event_id") % 7 == 0, F.floor(F.col("event_id") / 2)).otherwise(F.col("event_id"))
    site = F.when(k % 6 == 0, "other.org").when(k % 6 == 1, "www.hub.example").when(k % 6 == 2, "sub.hub.example").otherwise("hub.example")
    tail = F.when(k % 5 == 0, "/cart").when(k % 5 == 1, "/cartelera").when(k % 5 == 2, "/noticia/x").when(k % 5 == 3, "?a=1&a=2").otherwise("")
    return e.select(F.concat(F.lit("https://"), site, F.lit("/"), k.cast("string"), tail).alias("url"), (F.col("event_id") % 9).cast("int").alias("depth"), (k % 10 == 6).alias("hint_pdf"), (k % 8 == 3).alias("from_listing"), (k % 4 == 1).alias("from_sitemap"), F.col("event_id").alias("pos"))


def _admitted(spark, sf):
    return crawl.admission(_targets(spark, sf), F.lit("https://www.hub.example/"), 7, excludes=["/cart", "/login"], hints=["/noticia/"])


TARGETS_SQL = (
    "t0 AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN event_id // 2 ELSE event_id END AS k FROM events), targets AS (SELECT event_id AS pos, (event_id % 9)::INT AS depth, k % 10 = 6 AS hint_pdf, k % 8 = 3 AS from_listing, k % 4 = 1 AS from_sitemap, "
    "'https://' || CASE k % 6 WHEN 0 THEN 'other.org' WHEN 1 THEN 'www.hub.example' WHEN 2 THEN 'sub.hub.example' ELSE 'hub.example' END || '/' || k || CASE k % 5 WHEN 0 THEN '/cart' WHEN 1 THEN '/cartelera' WHEN 2 THEN '/noticia/x' WHEN 3 THEN '?a=1&a=2' ELSE '' END AS url FROM t0), "
    "firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY pos) AS r FROM targets) WHERE r = 1), judged AS (SELECT url, pos, CASE WHEN depth > 7 THEN 'depth' WHEN contains(url, 'other.org') AND NOT hint_pdf THEN 'offsite' WHEN ends_with(url, '/cart') THEN 'excluded' WHEN contains(url, 'a=1&a=2') THEN 'trap' END AS reason, "
    "CASE WHEN hint_pdf THEN 0 WHEN from_listing THEN 1 WHEN contains(url, '/noticia/') THEN 2 WHEN from_sitemap THEN 3 ELSE 4 END AS t FROM firsts), admitted AS (SELECT url, pos, reason, CASE WHEN reason IS NULL THEN t END AS tier FROM judged)"
)


def _signals(spark, sf):
    e = table(spark, sf, "events")
    kind = F.get(F.array(*[F.lit(x) for x in ("listing", "article", "navigation", "empty")]), (F.col("event_id") % 4).cast("int"))
    return e.select("event_id", kind.alias("page_kind"), (F.col("event_id") % 6).alias("items"), (F.col("event_id") % 5).alias("sections"), (F.col("event_id") % 17).alias("sitemap"))


def _tree_docs(spark, sf):
    docs = table(spark, sf, "documents").select(F.concat(F.lit("n"), (F.col("doc_id") * 3).cast("string")).alias("url"), T.count_words("text").alias("words"))
    return docs


def _seeds(spark, sf):
    pages = table(spark, sf, "pages")
    return report.seeds_by_domain(pages.select("url"), pages.where(F.col("url").contains(".example.org")).select(U.bare_host("url").alias("domain")).distinct())


def _saturation(spark, sf):
    rows = coverage.saturation(ledger(spark, sf), window=5)
    return rows.select("seq", "seed", "barren", "saturated")


def _per_minute(spark, sf):
    rows = ledger(spark, sf).withColumn("time", F.timestamp_seconds("ts"))
    out = panel.per_minute(rows, width="1 minute", keys=("decision",), values={"total": "value"})
    return out.select(F.unix_timestamp("start").alias("start"), "decision", "n", F.round("total", 4).alias("total"))


def _trailing(spark, sf):
    rows = ledger(spark, sf).where("decision = 'saved'").withColumn("time", F.timestamp_seconds("ts"))
    return panel.per_minute(rows, width="10 minutes", slide="1 minute").select(F.unix_timestamp("start").alias("start"), "n")


def _streamed(spark, sf):
    """Windows of a day by outcome, from the events as a stream; read back when the stream has run dry."""
    schema = table(spark, sf, "events").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet*").parquet(sf).select(F.col("ts").cast("timestamp").alias("time"), "event_type", "value")
    out = panel.to_table(panel.per_minute(rows, width="1 day", keys=("event_type",)), f"{shared_folder(spark)}/days-{uuid.uuid4().hex}")
    return out.select(F.unix_timestamp("start").alias("start"), "event_type", "n")


def _streamed_domains(spark, sf):
    schema = table(spark, sf, "events").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet*").parquet(sf)
    site = F.concat(F.lit("https://site"), (F.col("user_id") % SITES).cast("string"), F.lit(".example/"))
    visits = rows.select(site.alias("url"), F.get(F.array(*[F.lit(x) for x in vocab.DECISIONS]), (F.col("event_id") % 17).cast("int")).alias("decision"), F.unix_timestamp(F.col("ts").cast("timestamp")).cast("double").alias("ts"))
    return panel.to_table(panel.domain_counters(visits), f"{shared_folder(spark)}/counters-{uuid.uuid4().hex}")


def _rates(spark, sf):
    rows = ledger(spark, sf).where("decision = 'saved'").groupBy("seed").agg(F.sum(F.col("seq") % 100).cast("long").alias("tokens"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return panel.rates(rows).select("seed", "tokens", F.round("tokens_per_second", 2).alias("tokens_per_second"))


def _probe(spark, sf):
    e = table(spark, sf, "events")
    rows = e.select((F.col("event_id") % 7).cast("string").alias("seed"), (F.floor(F.col("event_id") / 7) % 40).alias("page"), (F.floor(F.col("event_id") / 7) * (F.col("event_id") % 7 + 1) % 97).alias("item"))
    return report.probe_summary(rows)


def _compared(spark, sf):
    docs = table(spark, sf, "documents")
    urls = docs.select(F.concat(F.lit("https://x.org/article/"), F.when(F.col("doc_id") % 2 == 0, "MED").otherwise("PMC"), F.lit("/"), (F.col("doc_id") % 600).cast("string")).alias("url"))
    api = docs.select((F.col("doc_id") * 3 % 700).cast("string").alias("ext_id"))
    return report.compared(api, report.external_ids(urls))


QUERIES = {
    "ledger_collapse": (_by_url, f"WITH {LEDGER_SQL}, {COLLAPSED_SQL} SELECT * FROM collapsed"),
    "ledger_funnel": (lambda spark, sf: coverage.funnel(_by_url(spark, sf)), f"WITH {LEDGER_SQL}, {COLLAPSED_SQL} SELECT coalesce(\"fetch\", CASE WHEN not_fetched IS NOT NULL THEN 'not_fetched' END, 'rejected:' || rejected, 'enqueued_only') AS outcome, count(*) AS n_urls FROM collapsed GROUP BY 1"),
    "inventory_union": (_inventory, f"WITH {INVENTORY_SQL} SELECT key, source FROM inventory"),
    "coverage_metrics": (
        lambda spark, sf: coverage.metrics(_inventory(spark, sf), _by_url(spark, sf)),
        f"WITH {BOTH}, j AS (SELECT i.key AS ik, class, c.key AS ck, \"fetch\" FROM classed i FULL JOIN collapsed c ON i.key = c.key), m AS (SELECT count(ik) AS inventory_total, count(*) FILTER (class = 'content') AS inventory_content, count(*) FILTER (class = 'utility') AS inventory_utility, count(*) FILTER (class = 'not_extractable') AS inventory_not_extractable, "
        "count(*) FILTER (class = 'content' AND ck IS NOT NULL) AS seen, count(*) FILTER (class = 'content' AND \"fetch\" IS NOT NULL) AS fetched, count(*) FILTER (class = 'content' AND \"fetch\" = 'saved') AS saved, count(*) FILTER (\"fetch\" = 'saved') AS saved_total, count(*) FILTER (\"fetch\" = 'saved' AND ik IS NOT NULL) AS sl FROM j) "
        "SELECT * EXCLUDE (sl), round(100 * seen / inventory_content, 1) AS reach_pct, round(100 * fetched / inventory_content, 1) AS fetch_pct, round(100 * saved / inventory_content, 1) AS recall_pct, round(100 * sl / saved_total, 1) AS precision_pct, saved_total - sl AS saved_outside FROM m",
    ),
    "coverage_missing": (_missing, f"WITH {MISSING_SQL} SELECT key, source, stage, why, document FROM missing"),
    "coverage_missing_reasons": (lambda spark, sf: coverage.missing_reasons(_missing(spark, sf)), f"WITH {MISSING_SQL} SELECT split_part(why, ' (', 1) AS why, count(*) AS n_urls FROM missing GROUP BY 1 ORDER BY n_urls DESC, why LIMIT 12"),
    "coverage_extra": (lambda spark, sf: coverage.extra(_inventory(spark, sf), _by_url(spark, sf)), f"WITH {BOTH} SELECT key FROM collapsed WHERE \"fetch\" = 'saved' AND key NOT IN (SELECT key FROM inventory)"),
    "domain_activity": (
        lambda spark, sf: coverage.domain_activity(ledger(spark, sf), 1706572800.0, quiet=86400.0),
        f"WITH {LEDGER_SQL} SELECT host AS domain, count(*) FILTER (decision = 'enqueued') AS enqueued, count(*) FILTER (decision IN {OUTCOME_LIST}) AS fetched, count(*) FILTER (decision = 'saved') AS saved, count(*) FILTER (decision IN {FAILURE_LIST}) AS failed, arg_max(url, seq) AS last_url, arg_max(decision, seq) AS last_decision, max(ts) AS last_ts, "
        "CASE WHEN 1706572800.0 - max(ts) < 86400.0 THEN 'active' ELSE 'paused' END AS status FROM visits GROUP BY host",
    ),
    "recent_failures": (lambda spark, sf: coverage.recent_failures(ledger(spark, sf)).select("seq", "url", "decision"), f"WITH {LEDGER_SQL} SELECT seq, url, decision FROM visits WHERE decision IN {FAILURE_LIST} ORDER BY ts DESC, seq DESC LIMIT 200"),
    "saturation_points": (
        _saturation,
        f"WITH {LEDGER_SQL}, f AS (SELECT *, row_number() OVER (PARTITION BY seed ORDER BY seq) AS nth FROM visits WHERE decision IN {OUTCOME_LIST}), b AS (SELECT seq, seed, nth - coalesce(max(CASE WHEN decision = 'saved' OR (decision = 'listing' AND kind = 'new_items') THEN nth END) OVER (PARTITION BY seed ORDER BY seq ROWS UNBOUNDED PRECEDING), 0) AS barren FROM f) SELECT seq, seed, barren::INT AS barren, barren >= 5 AS saturated FROM b",
    ),
    "events_per_minute": (_per_minute, f"WITH {LEDGER_SQL} SELECT (floor(ts / 60) * 60)::BIGINT AS start, decision, count(*) AS n, round(sum(value), 4) AS total FROM visits GROUP BY 1, 2"),
    "trailing_rate": (_trailing, f"WITH {LEDGER_SQL}, s AS (SELECT ts, unnest(range(0, 10)) AS k FROM visits WHERE decision = 'saved') SELECT (floor(ts / 60) * 60 - 60 * k)::BIGINT AS start, count(*) AS n FROM s GROUP BY 1"),
    "token_rates": (_rates, f"WITH {LEDGER_SQL}, s AS (SELECT seed, sum(seq % 100)::BIGINT AS tokens, min(ts) AS a, max(ts) AS b FROM visits WHERE decision = 'saved' GROUP BY seed) SELECT seed, tokens, CASE WHEN b - a >= 600 THEN round(tokens / (b - a), 2) END AS tokens_per_second FROM s"),
    "stream_events_per_day": (_streamed, "SELECT epoch(date_trunc('day', ts))::BIGINT AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2"),
    "stream_domain_counters": (
        _streamed_domains,
        f"WITH v AS (SELECT 'site' || (user_id % {SITES}) || '.example' AS domain, (['enqueued', 'rejected', 'saved', 'duplicate', 'listing', 'hub', 'no_document', 'blocked', 'robots', 'http_error', 'throttle', 'already_saved', 'too_large', 'empty', 'offsite_html', 'extract_error', 'not_fetched'])[event_id % 17 + 1] AS decision, floor(epoch(ts))::DOUBLE AS ts FROM events) "
        f"SELECT domain, count(*) FILTER (decision = 'enqueued') AS enqueued, count(*) FILTER (decision IN {OUTCOME_LIST}) AS fetched, count(*) FILTER (decision = 'saved') AS saved, count(*) FILTER (decision IN {FAILURE_LIST}) AS failed, max(ts) AS last_ts FROM v GROUP BY domain",
    ),
    "frontier_admission": (lambda spark, sf: _admitted(spark, sf).select("url", "reason", "tier"), f"WITH {TARGETS_SQL} SELECT url, reason, tier::INT AS tier FROM admitted"),
    "frontier_emission": (
        lambda spark, sf: crawl.emission(_admitted(spark, sf).withColumn("site", U.netloc("url")), 100, site="site").select("url", "turn", "decision"),
        f"WITH {TARGETS_SQL}, o AS (SELECT url, row_number() OVER (PARTITION BY regexp_extract(url, '//([^/?]*)', 1) ORDER BY tier, pos) AS turn FROM admitted WHERE reason IS NULL) SELECT url, turn::INT AS turn, CASE WHEN turn <= 100 THEN 'fetch' ELSE 'not_fetched' END AS decision FROM o",
    ),
    "crawl_plan": (
        lambda spark, sf: _signals(spark, sf).select("event_id", crawl.plan(F.col("page_kind"), F.col("items"), F.col("sections"), F.col("sitemap")).alias("p")).select("event_id", "p.strategy", "p.low_confidence"),
        "WITH s AS (SELECT event_id, CASE WHEN event_id % 4 = 0 AND event_id % 6 >= 3 THEN 'listing' WHEN event_id % 4 = 1 THEN 'directed' WHEN event_id % 5 >= 3 THEN 'sections' WHEN event_id % 17 >= 10 THEN 'sitemap' ELSE 'bfs' END AS strategy FROM events) SELECT event_id, strategy, strategy = 'bfs' AS low_confidence FROM s",
    ),
    "provenance_path": (
        lambda spark, sf: crawl.provenance_paths(provenance(spark, sf)),
        f"WITH RECURSIVE {TREE_SQL}, walk AS (SELECT url, [url] AS path, via AS next FROM nodes UNION ALL SELECT w.url, list_prepend(n.url, w.path), n.via FROM walk w JOIN nodes n ON n.url = w.next WHERE len(w.path) < 12) SELECT url, arg_max(path, len(path)) AS path FROM walk GROUP BY url",
    ),
    "provenance_rollup": (
        lambda spark, sf: crawl.branch_totals(crawl.provenance_paths(provenance(spark, sf)), _tree_docs(spark, sf)),
        f"WITH RECURSIVE {TREE_SQL}, up AS (SELECT url, url AS node, via FROM nodes UNION ALL SELECT u.url, n.url, n.via FROM up u JOIN nodes n ON n.url = u.via), d AS (SELECT 'n' || (doc_id * 3) AS url, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) AS words FROM documents) "
        "SELECT node AS url, count(d.url) AS branch_docs, coalesce(sum(words), 0)::BIGINT AS branch_words FROM up LEFT JOIN d ON d.url = up.url GROUP BY node",
    ),
    "seed_order": (_seeds, "WITH p AS (SELECT page_id, regexp_replace(lower(regexp_extract(url, '://([^/?#]*)', 1)), '^www\\.', '') AS domain FROM pages) SELECT domain, count(*) AS n_seeds FROM p WHERE domain NOT IN (SELECT domain FROM p WHERE contains(domain, '.example.org')) GROUP BY 1"),
    "resume_pending": (
        lambda spark, sf: ledger(spark, sf).select("seed").distinct().join(ledger(spark, sf).where(F.col("seed").rlike("[13579].example$")).select("seed").distinct(), "seed", "left_anti"),
        f"WITH {LEDGER_SQL} SELECT DISTINCT seed FROM visits WHERE NOT regexp_matches(seed, '[13579].example$')",
    ),
    "probe_summary": (
        _probe,
        "WITH p AS (SELECT (event_id % 7)::VARCHAR AS seed, (event_id // 7) % 40 AS page, (event_id // 7) * (event_id % 7 + 1) % 97 AS item FROM events), f AS (SELECT seed, item, min(page) AS page FROM p GROUP BY ALL), n AS (SELECT seed, page, count(*) AS new FROM f GROUP BY ALL), g AS (SELECT DISTINCT seed, page FROM p), j AS (SELECT seed, page, coalesce(new, 0) AS new FROM g LEFT JOIN n USING (seed, page)), "
        "b AS (SELECT *, page - coalesce(max(CASE WHEN new > 0 THEN page END) OVER (PARTITION BY seed ORDER BY page), 0) AS barren FROM j) SELECT seed, sum(new)::BIGINT AS unique_items, count(*) AS pages, count(*) FILTER (new > 0) AS pages_with_new, min(page) FILTER (barren >= 3) AS stopped_at FROM b GROUP BY seed",
    ),
    "api_comparison": (
        _compared,
        "WITH a AS (SELECT DISTINCT (doc_id * 3 % 700)::VARCHAR AS i FROM documents), s AS (SELECT DISTINCT (doc_id % 600)::VARCHAR AS i FROM documents) SELECT CASE WHEN s.i IS NULL THEN 'api' WHEN a.i IS NULL THEN 'scraped' ELSE 'both' END AS found_in, count(*) AS n FROM a FULL JOIN s ON a.i = s.i GROUP BY 1",
    ),
    "run_rates": (
        lambda spark, sf: report.run_rates(ledger(spark, sf).groupBy("seed").agg(F.count("*").alias("pages"), F.count_if(F.col("decision") == "saved").alias("documents"), (F.max("ts") - F.min("ts")).alias("seconds"))).select("seed", "pages", "documents", "pages_per_minute", "documents_per_hour"),
        f"WITH {LEDGER_SQL}, r AS (SELECT seed, count(*) AS pages, count(*) FILTER (decision = 'saved') AS documents, max(ts) - min(ts) AS s FROM visits GROUP BY 1) SELECT seed, pages, documents, round(pages / s * 60, 1) AS pages_per_minute, round(documents / s * 3600, 1) AS documents_per_hour FROM r",
    ),
}
