"""Sources, logs, queues and stores, over rows derived by number."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexloom.functions import text as T
from lexloom.functions import url as U
from lexloom.operators import report, rights, scans
from lexloom.plans.fixtures import DOCUMENTS_SQL, LEDGER_SQL, documents, ledger
from lexloom.session import shared_folder, table
from lexloom.sources import artifacts, fetch, logs, seeds
from lexloom.sources import documents as stores
from lexloom.sources import ledger as ledgers


def _folder(spark, name):
    import uuid

    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _pick(values, at):
    return F.get(F.array(*[F.lit(v) for v in values]), at.cast("int"))


def _spider(spark, sf):
    """A spider's log by number: found pages, sizes, errors, noise; every URL twice or so."""
    k = F.col("event_id")
    url = F.concat(F.lit("http://www.a.org/p"), F.floor(k / 2))
    line = F.when(k % 5 == 0, F.concat(F.lit("2024 URL:"), url, F.lit(" 200 OK"))).when(k % 5 == 1, F.concat(F.lit("URL: "), url, F.lit(' [12/34] -> "x"'))).when(k % 5 == 2, F.concat(F.lit("URL:"), url, F.lit(" 404 Not"))).when(k % 5 == 3, F.concat(F.lit("URL:http://b.org/"), k, F.lit(" [9]"))).otherwise("noise")
    return logs.spider_urls(table(spark, sf, "events").select(line.alias("value")), "a.org")


MARKS = ["PageMap x: kind=listing items=3", "Escalando a render dinámico", "Guardado doc", "Sin contenido sustantivo (3)", "robots.txt prohíbe x", "requiere OCR", "demasiado grande", "Portadilla descartada", "Fallo de red", "x Falló y", "marcado como bloqueado", "other", "PageMap y: kind=article", "Sección 'News': 4 documentos"]


def _log(spark, sf):
    k = F.col("event_id")
    clock = F.concat_ws(":", *[F.lpad(x.cast("string"), 2, "0") for x in (F.floor(k / 3600 + 23) % 24, F.floor(k / 60) % 60, k % 60)])
    return table(spark, sf, "events").select(k.alias("pos"), F.concat(clock, F.lit(" "), _pick(MARKS, k % len(MARKS))).alias("value"))


def _sheet(spark, sf):
    """A free-form sheet by number: an institution now and then, with URLs, bare domains and repeats."""
    k = F.col("page_id")
    text = F.concat(F.lit("see https://www.x"), k % 90, F.lit(".org/a/, and y"), k % 40, F.lit(".com or https://z.org/?q="), k % 30)
    rows = table(spark, sf, "pages").select(k.alias("row"), F.when(k % 7 == 0, F.concat(F.lit(" Inst "), k, F.lit(" "))).otherwise("").alias("institution"), text.alias("text"))
    return seeds.from_free_form(rows)


SHEET_SQL = (
    "WITH r AS (SELECT page_id AS row, 'Inst ' || (page_id // 7 * 7) AS institution FROM pages), u AS (SELECT row, institution, 0 AS k, 'https://www.x' || (row % 90) || '.org/a/' AS url, false AS is_home FROM r UNION ALL SELECT row, institution, 1, 'https://z.org/?q=' || (row % 30), false FROM r UNION ALL SELECT row, institution, 2, 'https://y' || (row % 40) || '.com', true FROM r) "
    "SELECT row, institution, url, is_home FROM (SELECT *, row_number() OVER (PARTITION BY regexp_replace(lower(url), '/$', '') ORDER BY row, k) AS n FROM u) WHERE n = 1"
)


def _ordered(spark, sf):
    k = F.col("page_id")
    url = F.when(k % 4 == 0, F.concat(F.lit("a"), k % 60, F.lit(".org"))).when(k % 4 == 1, F.concat(F.lit(" https://b"), k % 60, F.lit(".org/home/ "))).when(k % 4 == 2, F.concat(F.lit("https://c"), k % 60, F.lit(".org/x/y"))).otherwise("")
    rows = table(spark, sf, "pages").select(F.when(k % 11 != 0, k).alias("n"), F.lit("i").alias("institution"), url.alias("url"), F.lit("p").alias("permission"), F.when(k % 10 == 0, "Todos los derechos reservados").otherwise("ok").alias("comment"))
    return seeds.from_ordered(rows).select("n", "url", "class")


ORDERED_SQL = (
    "WITH r AS (SELECT page_id AS n, CASE page_id % 4 WHEN 0 THEN 'https://a' || (page_id % 60) || '.org' WHEN 1 THEN 'https://b' || (page_id % 60) || '.org/home/' WHEN 2 THEN 'https://c' || (page_id % 60) || '.org/x/y' END AS url, page_id % 4 AS t FROM pages WHERE page_id % 11 <> 0 AND page_id % 4 < 3) "
    "SELECT n, url, CASE WHEN n % 10 = 0 THEN 'restricted' WHEN t < 2 THEN 'home' ELSE 'deep' END AS class FROM (SELECT *, row_number() OVER (PARTITION BY regexp_replace(url, '/+$', '') ORDER BY n) AS k FROM r) WHERE k = 1"
)


def _seed_file(spark, sf):
    """A CSV of seeds with its context, written and read again; the first of a repeated URL counts."""
    folder = _folder(spark, "seeds") + ".csv"
    k = F.col("page_id")
    line = F.concat(F.lit('"Consulta '), k, F.lit(', x",'), F.when(k % 9 == 0, "no url").otherwise(F.concat(F.lit("https://s"), k % 70, F.lit(".org"))))
    rows = table(spark, sf, "pages").select(line.alias("value"), (k + 1).alias("o")).unionByName(spark.createDataFrame([("Titulo,URL", 0)], "value string, o long")).orderBy("o")
    rows.select("value").coalesce(1).write.text(folder)
    found = seeds.read(spark, folder)
    docs = table(spark, sf, "pages").select(F.concat(F.lit("https://s"), k, F.lit(".org")).alias("seed"), F.when(k % 2 == 0, "own").alias("title"))
    return seeds.with_context_title(docs, found).select("seed", "title")


SEEDS_SQL = "WITH f AS (SELECT 'https://s' || (page_id % 70) || '.org' AS seed, min(page_id) AS n FROM pages WHERE page_id % 9 <> 0 GROUP BY 1) SELECT 'https://s' || p.page_id || '.org' AS seed, CASE WHEN p.page_id % 2 = 0 THEN 'own' ELSE 'Consulta ' || n || ', x' END AS title FROM pages p LEFT JOIN f ON f.seed = 'https://s' || p.page_id || '.org'"

ROBOTS = [
    ("User-agent: *\nDisallow: /x\nContent-Signal: ai-train=no\n\nUser-agent: GPTBot\nDisallow: /\nUser-agent: CCBot\nDisallow: /y\n", "ai-train=no", "GPTBot"), ("", None, ""), ("User-agent: ClaudeBot\r\nDisallow: / \r\nuser-agent: ccbot\ndisallow:/\n", None, "CCBot ClaudeBot"), ("User-agent: Amazonbot\nAllow: /\n", None, ""),
]


def _robots(spark, sf):
    k = F.col("page_id")
    rows = table(spark, sf, "pages").select("page_id", _pick([r for r, _, _ in ROBOTS], k % len(ROBOTS)).alias("r"))
    found = rows.select("page_id", rights.robots_signals("r").alias("s"))
    return found.select("page_id", F.col("s.content_signal").alias("signal"), F.array_join(F.array_sort("s.ai_bots_blocked"), " ").alias("bots"))


ROBOTS_SQL = "SELECT page_id, ([" + ", ".join("NULL" if s is None else f"'{s}'" for _, s, _ in ROBOTS) + f"]::VARCHAR[])[page_id % {len(ROBOTS)} + 1] AS signal, ([" + ", ".join(f"'{b}'" for _, _, b in ROBOTS) + f"])[page_id % {len(ROBOTS)} + 1] AS bots FROM pages"


def _allowed(spark, sf):
    text = "User-agent: *\nDisallow: /en/1\nDisallow: /*.html$\nAllow: /en/12\nCrawl-delay: 3\nUser-agent: other\nDisallow: /"
    pages = table(spark, sf, "pages").select("page_id", F.concat(F.lit("http://r.org"), U.path("url")).alias("url"))
    robots = spark.createDataFrame([("r.org", text)], "host string, robots string")
    return rights.allowed(pages, robots, "bot").select("page_id", "allowed")


ALLOWED_SQL = "SELECT page_id, CASE WHEN starts_with(p, '/en/12') THEN NOT (ends_with(p, '.html') AND length('/*.html$') > length('/en/12')) WHEN ends_with(p, '.html') THEN false ELSE NOT starts_with(p, '/en/1') END AS allowed FROM (SELECT page_id, regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) AS p FROM pages)"

ANSWERS = ['say {"a": {"b": 1}} now', "none", "{broken", 'x {"a": 1} y {"b": 2}', '{"a": "}"}']


def _json(spark, sf):
    return table(spark, sf, "events").select("event_id", T.json_of(_pick(ANSWERS, F.col("event_id") % len(ANSWERS))).alias("answer"))


def _evidence(spark, sf):
    body = F.concat(F.lit("word "), F.expr("repeat('pad ', cast(doc_id % 40 as int))"), F.lit("All  Rights\nReserved by us "), F.expr("repeat('tail ', cast(doc_id % 50 as int))"))
    found = table(spark, sf, "documents").select("doc_id", F.explode(T.phrase_evidence(body, ["all rights reserved", "cc by"])).alias("p"))
    return found.select("doc_id", "p.phrase", F.col("p.evidence").alias("evidence"))


EVIDENCE_SQL = "SELECT doc_id, 'all rights reserved' AS phrase, substr(t, greatest(1, instr(lower(t), 'all rights reserved') - 80), least(instr(lower(t), 'all rights reserved') - 1, 80) + 19 + 120) AS evidence FROM (SELECT doc_id, trim('word ' || repeat('pad ', (doc_id % 40)::INT) || 'All Rights Reserved by us ' || repeat('tail ', (doc_id % 50)::INT)) AS t FROM documents)"


def _ledger_round_trip(spark, sf):
    """The derived ledger appended in two parts and read again, by day's decisions."""
    folder = _folder(spark, "ledger")
    rows = ledger(spark, sf)
    for part in (0, 1):
        ledgers.append(rows.where(F.col("seq") % 2 == part), folder)
    return ledgers.read(spark, folder).groupBy("seed", "decision").agg(F.count("*").alias("n"), F.sum("ts").cast("long").alias("ts"), F.count("reason").alias("reasons"))


def _ledger_stream(spark, sf):
    """The same ledger as a stream of files, counted by decision."""
    from lexloom.streaming import panel

    folder = _folder(spark, "ledger")
    ledgers.append(ledger(spark, sf), folder)
    return panel.to_table(ledgers.stream(spark, folder).groupBy("decision").agg(F.count("*").alias("n")), _folder(spark, "tail"))


def _saved_batches(spark, sf):
    """Documents saved by two streams one after the other, the second with texts of the first: each content is kept once."""
    store, source = _folder(spark, "store"), _folder(spark, "incoming")
    docs = documents(spark, sf).select("url", "text", "doc_id")
    for part in (0, 1):
        docs.where(F.col("doc_id") % 2 == part).drop("doc_id").write.mode("append").parquet(source)
        stream = spark.readStream.schema("url string, text string").parquet(source)
        stores.save_batches(stream, store, f"{store}-progress").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{store}/documents").agg(F.count("*").alias("docs"), F.countDistinct("doc_id").alias("ids"), F.countDistinct("content_hash").alias("contents"))


SAVED_SQL = r"WITH t AS (SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS t FROM documents), n AS (SELECT count(DISTINCT t) FILTER (length(t) >= 200) AS contents, count(*) FILTER (length(t) < 200 OR t IS NULL) AS short FROM t) SELECT contents + short AS docs, contents + short AS ids, contents FROM n"


def _analyses(spark, sf):
    folder = _folder(spark, "analysis")
    k = F.col("page_id")
    rows = table(spark, sf, "pages").select(F.concat(F.lit("https://a.org/"), k % 100).alias("url"), k.alias("n"))
    artifacts.save_analyses(artifacts.analyses(rows.where(k < 100), "plan"), folder)
    artifacts.save_analyses(artifacts.analyses(rows.where(k.between(100, 149)), "plan"), folder)
    artifacts.save_analyses(artifacts.analyses(rows, "pagemap"), folder)
    return artifacts.read_analyses(spark, folder, "plan").select("doc_id", F.get_json_object("body", "$.n").cast("long").alias("n"))


def _progress(spark, sf):
    """Domains with a done mark, appended in two runs; those left are the work."""
    folder = _folder(spark, "progress")
    domains = table(spark, sf, "pages").select(U.bare_host("url").alias("domain"), "page_id")
    for part in (0, 1):
        artifacts.mark_done(spark, domains.where(F.col("page_id") % 10 == part), folder)
    return report.seeds_by_domain(table(spark, sf, "pages").select("url"), artifacts.done(spark, folder))


PROGRESS_SQL = r"WITH p AS (SELECT page_id, regexp_replace(lower(regexp_extract(url, '://([^/?#]*)', 1)), '^www\.', '') AS domain FROM pages) SELECT domain, count(*) AS n_seeds FROM p WHERE domain NOT IN (SELECT domain FROM p WHERE page_id % 10 < 2) GROUP BY 1"


def _queue(spark, sf):
    """Queued files of which some engines read the text, one fails and one gives nothing."""

    def fails(body, lang):
        raise ValueError("no text")

    scans.ENGINES.update({"echo": lambda body, lang: body.decode() + " " + lang, "fails": fails, "empty": lambda body, lang: " "})
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), F.lit("old").alias("text"), "doc_id").toDF("doc_id", "text", "n")
    queue = docs.where("n % 3 = 0").select("doc_id", F.encode(F.concat(F.lit("read "), "doc_id"), "UTF-8").alias("body"), _pick(["echo", "fails", "empty", "missing"], F.col("n") % 4).alias("engine"))
    fresh, left = artifacts.processed_queue(queue, docs)
    return fresh.select("doc_id", "text", "ocr_status").join(left.select("doc_id", "error"), "doc_id", "left")


QUEUE_SQL = (
    "SELECT doc_id::VARCHAR AS doc_id, CASE WHEN doc_id % 12 = 0 THEN 'read ' || doc_id || ' spa' ELSE 'old' END AS text, CASE WHEN doc_id % 12 = 0 THEN 'done' ELSE 'pending' END AS ocr_status, "
    "CASE WHEN doc_id % 3 = 0 THEN ([NULL, 'ValueError: no text', 'empty result', 'KeyError: ''missing'''])[doc_id % 4 + 1] END AS error FROM documents"
)


def _kinds(spark, sf):
    k = F.col("event_id")
    body = F.encode(_pick(["%PDF-1.4", "PK", "<html>", ""], k % 4), "ISO-8859-1")
    body = F.when(k % 4 == 1, F.concat(body, F.lit(bytes([3, 4])))).when(k % 9 == 0, F.lit(bytes.fromhex("D0CF11E0A1B11AE1"))).otherwise(body)
    kind = _pick(["text/html", "Application/PDF; x", "application/msword", None, "application/vnd.openxmlformats-officedocument.wordprocessingml.document"], k % 5)
    url = F.when(k % 3 == 0, "http://a/x.DOCX?y").otherwise("http://a/x")
    return table(spark, sf, "events").select("event_id", scans.is_pdf(kind, body).alias("pdf"), scans.is_word(kind, body, url).alias("word"))


KINDS_SQL = "SELECT event_id, event_id % 5 = 1 OR (event_id % 4 = 0 AND event_id % 9 <> 0) AS pdf, event_id % 5 IN (2, 4) OR (event_id % 9 = 0 AND event_id % 4 <> 1) OR (event_id % 4 = 1 AND event_id % 3 = 0) AS word FROM events"


def _sitemaps(spark, sf):
    """Sites by number whose robots.txt, index or usual place lists their pages."""
    k = F.col("page_id")
    site = F.concat(F.lit("https://m"), k, F.lit(".org"))
    rows = table(spark, sf, "pages").select("page_id", site.alias("site"))
    pages = lambda n: F.array_join(F.transform(F.sequence(F.lit(1), n), lambda j: F.concat(F.lit("<url><loc> "), F.col("site"), F.lit("/p"), j, F.lit(" </loc></url>"))), "")
    sheet = F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), pages(k % 5 + 1), F.lit("</urlset>"))
    index = F.concat(F.lit("<sitemapindex><sitemap><loc>"), F.col("site"), F.lit("/deep.xml</loc></sitemap></sitemapindex>"))
    files = rows.select(F.when(k % 3 == 0, F.concat("site", F.lit("/own.xml"))).when(k % 3 == 1, F.concat("site", F.lit("/deep.xml"))).otherwise(F.concat("site", F.lit("/sitemap.xml"))).alias("url"), sheet.alias("text"))
    files = files.unionByName(rows.where(k % 3 == 1).select(F.concat("site", F.lit("/sitemap.xml")).alias("url"), index.alias("text"))).unionByName(rows.where(k % 7 == 0).select(F.concat("site", F.lit("/sitemap_index.xml")).alias("url"), F.lit("<broken").alias("text")))
    sites = rows.select("site", F.when(k % 3 == 0, F.concat(F.lit("Sitemap: "), "site", F.lit("/own.xml"))).alias("robots"))
    return fetch.sitemap_pages(sites, files, limit=4)


SITEMAP_SQL = "WITH s AS (SELECT page_id, 'https://m' || page_id || '.org' AS site FROM pages) SELECT site, site || '/p' || j AS url FROM s, (SELECT unnest(range(1, 6)) AS j) WHERE j <= page_id % 5 + 1 AND j <= 4"


def _store_stats(spark, sf):
    kind = _pick(["html_static", "pdf", "docx", "html_dynamic"], F.col("doc_id") % 4)
    docs = table(spark, sf, "documents").select(kind.alias("source_type"), T.count_words("text").alias("words"))
    return report.corpus_counts(docs, ["source_type"]).where("dimension = 'source_type'").select(F.col("value").alias("source_type"), "docs", "words")


def _joined(spark, sf):
    """The index with what its documents' metadata and texts say; a text may be missing, metadata may not."""
    docs = documents(spark, sf)
    index, meta = docs.where("doc_id % 5 <> 0").select("doc_id", "url"), docs.where("doc_id % 7 <> 0").select("doc_id", "domain", "lang")
    texts = docs.where("doc_id % 3 <> 0").select("doc_id", "text")
    return report.described(index, meta, texts).select("doc_id", "domain", F.length("text").alias("chars"))


def _hints(spark, sf):
    k = F.col("event_id")
    return table(spark, sf, "events").select("event_id", F.array_join(scans.hints(F.when(k % 10 > 0, k % 60), F.when(k % 4 > 0, (k % 21) / 20)), " ").alias("hints"))


def _queue_engine_bench(spark, sf):
    """Three engines' texts of each document: each pair's F1, averaged by engine and by pair."""
    docs = table(spark, sf, "documents").where("doc_id % 5 = 0").select("doc_id", F.array_join(F.slice(F.split("text", r"\s+"), 1, 60), " ").alias("t"))
    texts = docs.select("doc_id", F.explode(F.create_map(F.lit("a"), F.col("t"), F.lit("b"), F.concat("t", F.lit(" extra words")), F.lit("c"), F.concat(F.lit("noise "), "t")))).toDF("doc_id", "engine", "text")
    return report.engine_agreement(texts).select("engine_a", "engine_b", "docs", F.round("f1", 4).alias("f1"))


BENCH_SQL = r"""WITH d AS (SELECT doc_id, list_filter(regexp_extract_all(lower(array_to_string(regexp_split_to_array(text, '\s+')[1:60], ' ')), '[\p{L}\p{N}_]+'), lambda x: true) AS t FROM documents WHERE doc_id % 5 = 0), e AS (SELECT doc_id, 'a' AS e, t FROM d UNION ALL SELECT doc_id, 'b', t || ['extra', 'words'] FROM d UNION ALL SELECT doc_id, 'c', ['noise'] || t FROM d),
u AS (SELECT doc_id, e, unnest(t) AS w FROM e), c AS (SELECT doc_id, e, w, count(*) AS n FROM u GROUP BY ALL), s AS (SELECT doc_id, e, sum(n) AS n FROM c GROUP BY ALL), p AS (SELECT a.doc_id, a.e AS x, b.e AS y, a.n + b.n AS n FROM s a JOIN s b ON a.doc_id = b.doc_id AND a.e < b.e),
i AS (SELECT p.doc_id, x, y, p.n, coalesce(sum(least(q.n, r.n)), 0) AS i FROM p JOIN c q ON q.doc_id = p.doc_id AND q.e = x JOIN c r ON r.doc_id = p.doc_id AND r.e = y AND r.w = q.w GROUP BY ALL)
SELECT x AS engine_a, y AS engine_b, count(*) AS docs, round(avg(2 * i / n), 4) AS f1 FROM i GROUP BY ALL"""

API = '{"resultList": {"result": [{"source": "MED", "id": "1", "title": "One. ", "isOpenAccess": "Y", "hasPDF": "N"}, {"source": "PMC", "id": "2", "title": "Two", "isOpenAccess": "N", "hasPDF": "Y"}]}}'


def _api(spark, sf):
    queries = table(spark, sf, "pages").select(F.concat(F.lit("q"), "page_id").alias("query"))
    return artifacts.api_results(queries, lambda q, size: API if int(q[1:]) % 2 else "{}")


QUERIES = {
    "spider_log": (_spider, "SELECT DISTINCT 'http://www.a.org/p' || (event_id // 2) AS url FROM events WHERE event_id % 5 < 2"),
    "run_log_events": (
        lambda spark, sf: logs.run_events(_log(spark, sf)),
        "SELECT e AS event, count(*) AS n FROM (SELECT (['pages_analysed', 'rendered', 'saved', 'without_text', 'robots', 'ocr_queued', 'too_large', 'hubs', 'failures', 'failures', 'blocked', NULL, 'pages_analysed', NULL])[event_id % 14 + 1] AS e FROM events) WHERE e IS NOT NULL GROUP BY e",
    ),
    "run_log_kinds": (lambda spark, sf: logs.run_kinds(_log(spark, sf)), "SELECT k AS page_kind, count(*) AS n FROM (SELECT CASE event_id % 14 WHEN 0 THEN 'listing' WHEN 12 THEN 'article' END AS k FROM events) WHERE k IS NOT NULL GROUP BY k"),
    "run_log_seconds": (lambda spark, sf: logs.run_seconds(_log(spark, sf)), "SELECT ((max(event_id) - min(event_id)) % 86400)::INT AS seconds FROM events"),
    "run_log_sections": (lambda spark, sf: logs.run_sections(_log(spark, sf)), "SELECT 'News' AS section, 4 AS documents FROM events WHERE event_id % 14 = 13"),
    "free_form_sheet": (_sheet, SHEET_SQL),
    "ordered_links": (_ordered, ORDERED_SQL),
    "seed_titles": (_seed_file, SEEDS_SQL),
    "robots_signals": (_robots, ROBOTS_SQL),
    "robots_allowed": (_allowed, ALLOWED_SQL),
    "json_answers": (_json, "SELECT event_id, (['{\"a\": {\"b\": 1}}', NULL, NULL, NULL, '{\"a\": \"}\"}'])[event_id % 5 + 1] AS answer FROM events"),
    "rights_evidence": (_evidence, EVIDENCE_SQL),
    "ledger_round_trip": (
        _ledger_round_trip,
        f"WITH {LEDGER_SQL} SELECT seed, decision, count(*) AS n, sum(ts)::BIGINT AS ts, count(reason) AS reasons FROM visits GROUP BY ALL",
    ),
    "ledger_stream": (_ledger_stream, f"WITH {LEDGER_SQL} SELECT decision, count(*) AS n FROM visits GROUP BY ALL"),
    "saved_batches": (_saved_batches, SAVED_SQL),
    "analysis_sink": (_analyses, "SELECT substr(sha256('https://a.org/' || (page_id % 100)), 1, 16) AS doc_id, max(page_id) AS n FROM pages WHERE page_id < 150 GROUP BY 1"),
    "progress_pending": (_progress, PROGRESS_SQL),
    "ocr_queue": (_queue, QUEUE_SQL),
    "file_kinds": (_kinds, KINDS_SQL),
    "sitemap_pages": (_sitemaps, SITEMAP_SQL),
    "store_stats": (_store_stats, r"SELECT (['html_static', 'pdf', 'docx', 'html_dynamic'])[doc_id % 4 + 1] AS source_type, count(*) AS docs, sum(len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')))::BIGINT AS words FROM documents GROUP BY 1"),
    "described_documents": (_joined, f"WITH {DOCUMENTS_SQL} SELECT doc_id, domain, CASE WHEN doc_id % 3 <> 0 THEN length(text) END::INT AS chars FROM docs WHERE doc_id % 5 <> 0 AND doc_id % 7 <> 0"),
    "ocr_hints": (
        _hints,
        "SELECT event_id, CASE WHEN coalesce(CASE WHEN event_id % 10 > 0 THEN event_id % 60 END, 0) <= 30 THEN 'ocrmypdf vision_model' ELSE 'batch_workers managed_service' END || CASE WHEN event_id % 4 > 0 AND event_id % 21 / 20 > 0.9 THEN ' check_orientation' ELSE '' END AS hints FROM events",
    ),
    "engine_agreement": (_queue_engine_bench, BENCH_SQL),
    "literature_api": (_api, "SELECT 'q' || page_id AS query, (['MED', 'PMC'])[j] AS ext_source, j::VARCHAR AS ext_id, (['One', 'Two'])[j] AS title, j = 1 AS open_access, j = 2 AS has_pdf FROM pages, (SELECT unnest([1, 2]) AS j) WHERE page_id % 2 = 1"),
}
