"""Stand-ins for a crawl's tables, derived from the data folders, as frames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.session import table

SITES, PLACES = 12, 613
SECTIONS = ["news", "docs", "tag", "blog", "data"]
OUTCOMES = ["enqueued", "enqueued", "saved", "listing", "rejected", "not_fetched", "http_error", "saved", "duplicate", "blocked", "hub", "enqueued", "no_document"]
ENDINGS = ["", "?a=1&a=2", "/cart", "/cartelera", "/file.PDF", "/bitstreams/9/download", "?x=%3Fy", "/data.csv", "?b=2&a=1&utm_source=z&c", "//x//index.html"]


def _pick(values: list[str], at) -> F.Column:
    return F.get(F.array(*[F.lit(v) for v in values]), at.cast("int"))


def _sql_pick(values: list[str], at: str) -> str:
    return "([" + ", ".join(f"'{v}'" for v in values) + f"])[({at})::INT + 1]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with domain, url and title (the first line)."""
    docs = table(spark, sf_dir, "documents")
    url = F.concat(F.lit("https://"), "source", F.lit(".example/"), F.col("doc_id").cast("string"))
    return docs.select("doc_id", "text", "lang", F.concat("source", F.lit(".example")).alias("domain"), url.alias("url"), F.element_at(F.split("text", "\n"), 1).alias("title"), "source")


DOCUMENTS_SQL = """docs AS (
  SELECT doc_id, text, lang, source || '.example' AS domain, 'https://' || source || '.example/' || doc_id AS url,
         split_part(text, chr(10), 1) AS title, source FROM documents)"""


def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page URLs without their fragment, with one of ten endings each."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    bare = F.regexp_replace("url", "[?#].*$", "")
    return pages.select("page_id", "url", F.concat(bare, _pick(ENDINGS, F.col("page_id") % 10)).alias("variant"))


URLS_SQL = "urls AS (SELECT page_id, url, regexp_replace(url, '[?#].*$', '') || " + _sql_pick(ENDINGS, "page_id % 10") + " AS variant FROM pages)"


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visits, one for each event."""
    e = table(spark, sf_dir, "events")
    site = F.concat(F.lit("site"), (F.col("user_id") % SITES).cast("string"), F.lit(".example"))
    place = (F.col("event_id") * 7) % PLACES
    ending = F.when(place % 11 == 0, ".csv").otherwise("")
    url = F.concat(F.lit("https://www."), site, F.lit("/"), _pick(SECTIONS, F.col("event_id") % 5), F.lit("/"), place.cast("string"), ending)
    decision = _pick(OUTCOMES, F.col("event_id") % 13)
    odd = F.col("event_id") % 2 == 1
    reason = F.when(decision == "rejected", F.when(odd, "offsite").otherwise("depth")).when(decision == "not_fetched", "budget").when(decision == "http_error", "404")
    kind = F.when((decision == "enqueued") & (F.col("event_id") % 3 < 2), F.when(F.col("event_id") % 3 == 0, "sitemap").otherwise("bfs")).when((decision == "listing") & odd, "new_items")
    seed = F.concat(F.lit("https://"), site)
    return e.select(F.col("event_id").alias("seq"), F.unix_timestamp(F.col("ts").cast("timestamp")).cast("double").alias("ts"), seed.alias("seed"), url.alias("url"), decision.alias("decision"), reason.alias("reason"), F.when(decision == "enqueued", seed).alias("via"), kind.alias("kind"), "value")


LEDGER_SQL = (
    "visits AS (SELECT *, CASE WHEN decision = 'rejected' THEN CASE WHEN seq % 2 = 1 THEN 'offsite' ELSE 'depth' END WHEN decision = 'not_fetched' THEN 'budget' WHEN decision = 'http_error' THEN '404' END AS reason, "
    "CASE WHEN decision = 'enqueued' THEN seed END AS via, "
    "CASE WHEN decision = 'enqueued' AND seq % 3 = 0 THEN 'sitemap' WHEN decision = 'enqueued' AND seq % 3 = 1 THEN 'bfs' WHEN decision = 'listing' AND seq % 2 = 1 THEN 'new_items' END AS kind FROM ("
    f"SELECT event_id AS seq, floor(epoch(ts))::DOUBLE AS ts, value, 'https://site' || (user_id % {SITES}) || '.example' AS seed, 'site' || (user_id % {SITES}) || '.example' AS host, "
    f"'https://www.site' || (user_id % {SITES}) || '.example/' || {_sql_pick(SECTIONS, 'event_id % 5')} || '/' || (event_id * 7 % {PLACES}) || CASE WHEN (event_id * 7 % {PLACES}) % 11 = 0 THEN '.csv' ELSE '' END AS url, "
    f"{_sql_pick(OUTCOMES, 'event_id % 13')} AS decision FROM events))"
)
OUTCOME_LIST = "('saved', 'duplicate', 'listing', 'hub', 'no_document', 'blocked', 'robots', 'http_error', 'throttle', 'already_saved', 'too_large', 'empty', 'offsite_html', 'extract_error')"
#: Visits by URL: the fetch of a saved page counts, else the last.
COLLAPSED_SQL = (
    "keyed AS (SELECT *, replace(url, '://www.', '://') AS key FROM visits), by_url AS (SELECT key, "
    "arg_min(kind, seq) FILTER (decision = 'enqueued' AND kind IS NOT NULL) AS kind, arg_min(via, seq) FILTER (decision = 'enqueued' AND via IS NOT NULL) AS via, "
    f"CASE WHEN bool_or(decision = 'saved') THEN 'saved' ELSE arg_max(decision, seq) FILTER (decision IN {OUTCOME_LIST}) END AS \"fetch\", "
    f"CASE WHEN bool_or(decision = 'saved') THEN NULL ELSE arg_max(coalesce(reason, '-'), seq) FILTER (decision IN {OUTCOME_LIST}) END AS reason0, "
    "arg_max(reason, seq) FILTER (decision = 'not_fetched') AS not_fetched, arg_max(reason, seq) FILTER (decision = 'rejected') AS rejected FROM keyed GROUP BY key), "
    "collapsed AS (SELECT key, kind, via, \"fetch\", nullif(reason0, '-') AS reason, not_fetched, rejected FROM by_url)"
)


def inventories(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    """Two inventories of URLs that overlap: a sitemap and a spider's, which is 40 places on."""
    docs = table(spark, sf_dir, "documents")

    def listed(at):
        place = at % PLACES
        return F.concat(F.lit("https://site"), (at % SITES).cast("string"), F.lit(".example/"), _pick(SECTIONS, at % 5), F.lit("/"), place.cast("string"), F.when(place % 11 == 0, ".csv").otherwise(""))

    return [("sitemap", docs.select(listed(F.col("doc_id")).alias("url"))), ("wget", docs.select(listed(F.col("doc_id") + 40).alias("url")))]


INVENTORY_SQL = (
    "placed AS (SELECT doc_id AS n, 'sitemap' AS source FROM documents UNION ALL SELECT doc_id + 40, 'wget' FROM documents), "
    f"listed AS (SELECT source, 'https://site' || (n % {SITES}) || '.example/' || {_sql_pick(SECTIONS, 'n % 5')} || '/' || (n % {PLACES}) || CASE WHEN (n % {PLACES}) % 11 = 0 THEN '.csv' ELSE '' END AS key FROM placed), "
    "inventory AS (SELECT key, min(source) AS source FROM listed GROUP BY key), "
    "classed AS (SELECT *, CASE WHEN key LIKE '%/tag/%' THEN 'utility' WHEN key LIKE '%.csv' THEN 'not_extractable' ELSE 'content' END AS class FROM inventory)"
)


def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree over the pages: the parent of page k is page (k - 1) div 3."""
    pages = table(spark, sf_dir, "pages").select("page_id")
    name = lambda c: F.concat(F.lit("n"), c.cast("string"))
    return pages.select(name(F.col("page_id")).alias("url"), F.when(F.col("page_id") > 0, name(F.floor((F.col("page_id") - 1) / 3))).alias("via"), "page_id")


TREE_SQL = "nodes AS (SELECT 'n' || page_id AS url, CASE WHEN page_id > 0 THEN 'n' || ((page_id - 1) // 3) END AS via, page_id FROM pages)"
