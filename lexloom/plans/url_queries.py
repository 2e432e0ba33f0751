"""URL functions over all pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexloom.functions import url as U
from lexloom.functions import vocab
from lexloom.plans.fixtures import URLS_SQL, urls
from lexloom.session import table

EXCLUDES = ["/cart", "/login", ".jpg", "?x="]
HINTS = ["/en/", "/fr/"]
HOST = r"regexp_replace(lower(regexp_extract({0}, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)), '^www\.', '')"
PATH = r"regexp_extract({0}, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
QUERY = r"regexp_extract({0}, '^[^?#]*\?([^#]*)', 1)"


def _of(make):
    return lambda spark, sf: urls(spark, sf).select("page_id", *make())


def _sql(columns: str) -> str:
    return f"WITH {URLS_SQL} SELECT page_id, {columns} FROM urls"


def doc_ids(spark, sf):
    return table(spark, sf, "pages").select("page_id", U.doc_id("url").alias("doc_id"))


def url_host(spark, sf):
    return table(spark, sf, "pages").select("page_id", U.bare_host("url").alias("host"), U.path("url").alias("path"), U.query("url").alias("query"))


def pages_per_host(spark, sf):
    return table(spark, sf, "pages").groupBy(U.bare_host("url").alias("host")).agg(F.count("*").alias("n_pages"))


def url_scope(spark, sf):
    seed = F.lit("https://www.example.org/")
    rows = table(spark, sf, "pages")
    return rows.select("page_id", U.same_site("url", seed).alias("same_site"), U.same_site("url", seed, subdomains=False, aliases=["m.ththre.example.com"]).alias("exact"), U.same_site("url", seed, whole_labels=False).alias("by_ending"))


NORMAL = rf"""WITH {URLS_SQL}, parts AS (
  SELECT page_id, lower(regexp_extract(variant, '^([a-z]+):', 1)) AS scheme, {HOST.format('variant')} AS host,
         regexp_replace({PATH.format('variant')}, '/+', '/', 'g') AS p0, {QUERY.format('variant')} AS q FROM urls
), placed AS (
  SELECT page_id, scheme, host, q, CASE WHEN p0 IN ('', '/') THEN '/' ELSE regexp_replace(p0, '/$', '') END AS p1 FROM parts
), pairs AS (
  SELECT *, coalesce(nullif(regexp_replace(p1, '/index\.(html|php|htm)$', ''), ''), '/') AS p,
         list_sort(list_transform(list_filter(string_split(q, '&'), lambda kv: kv <> '' AND split_part(kv, '=', 1) NOT IN ('utm_source', 'utm_medium', 'utm_campaign', 'utm_term', 'utm_content', 'fbclid', 'gclid')),
           lambda kv: CASE WHEN contains(kv, '=') THEN kv ELSE kv || '=' END)) AS kept FROM placed
)
SELECT page_id, scheme || '://' || host || p || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS normalized FROM pairs"""

UTILITY = vocab.UTILITY_PATTERN
_any = lambda where, hints: "(" + " OR ".join(f"contains({where}, '{h}')" for h in hints) + ")"
_ends = lambda hints: "(" + " OR ".join(f"ends_with(split_part(lower(variant), '?', 1), '{h}')" for h in hints) + ")"

#: What a counter of 20 becomes in the candidate that is tried first.
COUNTERS = [(n, f"?{n}=21") for n in vocab.PAGE_PARAMETERS] + [(n, f"?{n}=40") for n in vocab.OFFSET_PARAMETERS] + [("other", "?other=20&page=2")]
_h = "http://h.org"
COUNTED = [
    (f"{_h}/n?page=3", [f"{_h}/n?page=4"]), (f"{_h}/n?Paged=2", [f"{_h}/n?Paged=3"]), (f"{_h}/n?offset=40&cat=3", [f"{_h}/n?offset=80&cat=3"]), (f"{_h}/n?start=0", []), (f"{_h}/blog/page/4/", [f"{_h}/blog/page/5/"]), (f"{_h}/blog/Seite/9", [f"{_h}/blog/Seite/10"]),
    (f"{_h}/n", [f"{_h}/n/page/2/", f"{_h}/n?page=2", f"{_h}/n?p=2"]), (f"{_h}/n/?c=1", [f"{_h}/n/page/2/?c=1", f"{_h}/n/?c=1&page=2", f"{_h}/n/?c=1&p=2"]), (f"{_h}/n?p=1545", [f"{_h}/n?p=1546"]), (f"{_h}/n?q=a+b&pg=1", [f"{_h}/n?q=a+b&pg=2"]),
]
FILES = [
    ("GUIA_EDUCATIVA_2020.pdf", "Guia Educativa 2020"), ("file_2.pdf", None), ("Informe%20anual%20(1).docx", "Informe anual"), ("el+plan+--+final+(2).PDF", "el plan final"), ("abc.pdf", None), ("articles-90118_archivo_01.pdf", None), ("plan-de-accion.odt", "plan-de-accion"), ("x/", None), ("LEY.rtf", None), ("a%zz_memoria.doc", "a%zz memoria"),
]


def _case(values):
    return F.get(F.array(*[F.lit(v) for v in values]), (F.col("page_id") % len(values)).cast("int"))


def _encoded(spark, sf):
    """The variants with a parameter that must be decoded and encoded again."""
    more = F.concat("variant", F.when(F.col("variant").contains("?"), "&").otherwise("?"), F.lit("w=a%20b+c*~%C3%A9&v="), F.col("page_id"))
    return urls(spark, sf).select("page_id", U.normalize_encoded(more).alias("normalized"))


ENCODED = (
    NORMAL.replace("urls AS (", "bare_urls AS (", 1).replace("parts AS (", "urls AS (SELECT page_id, url, variant || CASE WHEN contains(variant, '?') THEN '&' ELSE '?' END || 'w=a%20b+c*~%C3%A9&v=' || page_id AS variant FROM bare_urls), parts AS (", 1)
    .replace("lambda kv: CASE WHEN contains(kv, '=') THEN kv ELSE kv || '=' END", "lambda kv: [url_decode(replace(split_part(kv, '=', 1), '+', '%20')), url_decode(replace(CASE WHEN contains(kv, '=') THEN substr(kv, instr(kv, '=') + 1) ELSE '' END, '+', '%20'))]")
    .replace("array_to_string(kept, '&')", "array_to_string(list_transform(kept, lambda p: replace(url_encode(p[1]), '%20', '+') || '=' || replace(url_encode(p[2]), '%20', '+')), '&')")
)

QUERIES = {
    "doc_ids": (doc_ids, "SELECT page_id, substr(sha256(url), 1, 16) AS doc_id FROM pages"),
    "url_host": (url_host, f"SELECT page_id, {HOST.format('url')} AS host, {PATH.format('url')} AS path, {QUERY.format('url')} AS query FROM pages"),
    "pages_per_host": (pages_per_host, f"SELECT {HOST.format('url')} AS host, count(*) AS n_pages FROM pages GROUP BY 1"),
    "url_scope": (url_scope, f"SELECT page_id, h = 'example.org' OR ends_with(h, '.example.org') AS same_site, h IN ('example.org', 'm.ththre.example.com') AS exact, ends_with(h, 'example.org') AS by_ending FROM (SELECT page_id, {HOST.format('url')} AS h FROM pages)"),
    "url_normalize": (_of(lambda: [U.normalize("variant").alias("normalized")]), NORMAL),
    "url_query_trap": (
        _of(lambda: [U.is_query_trap("variant").alias("trap")]),
        f"WITH {URLS_SQL}, q AS (SELECT page_id, {QUERY.format('variant')} AS q FROM urls), n AS (SELECT page_id, q, list_transform(list_filter(string_split(q, '&'), lambda x: x <> ''), lambda x: split_part(x, '=', 1)) AS names FROM q) SELECT page_id, contains(q, '?') OR contains(lower(q), '%3f') OR len(names) <> len(list_distinct(names)) AS trap FROM n",
    ),
    "url_excluded": (_of(lambda: [U.is_excluded("variant", EXCLUDES).alias("excluded")]), _sql(r"regexp_matches(lower(variant), '/(cart|login)(/|\?|#|$)') OR contains(lower(variant), '.jpg') OR contains(lower(variant), '?x=') AS excluded")),
    "url_content_hint": (_of(lambda: [U.looks_like_content("variant", HINTS).alias("content")]), _sql(_any(f"lower({PATH.format('variant')})", HINTS) + " AS content")),
    "url_document": (
        _of(lambda: [U.is_document("variant").alias("document"), U.looks_like_document("variant").alias("download"), U.is_extractable("variant").alias("extractable")]),
        _sql(f"{_ends(vocab.DOCUMENT_EXTENSIONS)} AS document, {_ends(vocab.DOCUMENT_EXTENSIONS)} OR regexp_matches(variant, '{vocab.DOWNLOAD_PATTERN}') AS download, NOT {_ends(vocab.DATA_EXTENSIONS)} AS extractable"),
    ),
    "url_utility": (
        lambda spark, sf: urls(spark, sf).select("page_id", U.is_utility("url").alias("utility"), U.is_utility("variant").alias("variant_utility")),
        f"WITH {URLS_SQL} SELECT page_id, regexp_matches(url, '{UTILITY}') AS utility, regexp_matches(variant, '{UTILITY}') AS variant_utility FROM urls",
    ),
    "page_category": (
        lambda spark, sf: table(spark, sf, "pages").select("page_id", U.category("url").alias("category")),
        f"SELECT page_id, CASE WHEN {_any('h', vocab.SCIENCE_HINTS)} THEN 'scientific' WHEN {_any('h', vocab.GOVERNMENT_HINTS)} THEN 'government' WHEN {_any('h', vocab.NEWS_HINTS)} OR {_any('p', vocab.NEWS_HINTS)} THEN 'news' "
        f"WHEN contains(h, 'blog') OR contains(p, '/blog') OR contains(h, 'medium.com') THEN 'blog' ELSE 'generic' END AS category FROM (SELECT page_id, lower(regexp_extract(url, '://([^/?#]*)', 1)) AS h, lower({PATH.format('url')}) AS p FROM pages)",
    ),
    "paging_method": (
        _of(lambda: [U.paging_method("url").alias("method")]),
        _sql(r"CASE WHEN regexp_extract(" + QUERY.format("url") + r", '(?:^|&)([A-Za-z_]+)=\d+', 1) <> '' THEN '?' || regexp_extract(" + QUERY.format("url") + r", '(?:^|&)([A-Za-z_]+)=\d+', 1) || '=N' WHEN regexp_matches(" + PATH.format("url") + r", '(?i)/(page|pagina|p[áa]g|pag)/\d+/?$') THEN '/page/N/' WHEN " + QUERY.format("url") + " <> '' THEN 'query opaca' ELSE 'número en la ruta' END AS method"),
    ),
    "next_page_urls": (
        lambda spark, sf: table(spark, sf, "pages").select("page_id", F.posexplode(U.next_pages(F.regexp_replace("url", "#.*$", ""))).alias("k", "next_url")),
        r"""WITH u AS (SELECT page_id, regexp_replace(url, '#.*$', '') AS url FROM pages), numbered AS (
          SELECT page_id, 0 AS k, regexp_replace(url, 'page=\d+', 'page=' || (regexp_extract(url, '[?&]page=(\d+)', 1)::INT + 1)) AS next_url FROM u WHERE regexp_matches(url, '[?&]page=\d+')
        ), bare AS (SELECT page_id, split_part(url, '?', 1) AS base, split_part(url, '?', 2) AS q FROM u WHERE NOT regexp_matches(url, '[?&]page=\d+'))
        SELECT * FROM numbered UNION ALL
        SELECT page_id, 0, base || CASE WHEN ends_with(base, '/') THEN '' ELSE '/' END || 'page/2/' || CASE WHEN q = '' THEN '' ELSE '?' || q END FROM bare UNION ALL
        SELECT page_id, 1, base || '?' || CASE WHEN q = '' THEN '' ELSE q || '&' END || 'page=2' FROM bare UNION ALL
        SELECT page_id, 2, base || '?' || CASE WHEN q = '' THEN '' ELSE q || '&' END || 'p=2' FROM bare""",
    ),
    "url_normalize_encoded": (_encoded, ENCODED),
    "next_page": (
        lambda spark, sf: table(spark, sf, "pages").select("page_id", U.next_page(F.concat(F.lit("http://h.org/l"), _case([f"?{n}=20" for n, _ in COUNTERS]))).alias("next_url")),
        "SELECT page_id, 'http://h.org/l' || (['" + "', '".join(v for _, v in COUNTERS) + f"'])[page_id % {len(COUNTERS)} + 1] AS next_url FROM pages",
    ),
    "next_page_counters": (
        lambda spark, sf: table(spark, sf, "pages").select("page_id", F.array_join(U.next_pages(_case([u for u, _ in COUNTED])), " ").alias("urls")),
        "SELECT page_id, (['" + "', '".join(" ".join(v) for _, v in COUNTED) + f"'])[page_id % {len(COUNTED)} + 1] AS urls FROM pages",
    ),
    "file_titles": (
        lambda spark, sf: table(spark, sf, "pages").select("page_id", U.title_from_file_name(F.concat(F.lit("http://h.org/d/"), _case([n for n, _ in FILES]))).alias("title")),
        "SELECT page_id, ([" + ", ".join("NULL" if t is None else f"'{t}'" for _, t in FILES) + f"]::VARCHAR[])[page_id % {len(FILES)} + 1] AS title FROM pages",
    ),
    "page_category_citation": (
        lambda spark, sf: table(spark, sf, "pages").select("page_id", U.category("url", F.col("page_id") % 3 == 0).alias("category")),
        f"SELECT page_id, CASE WHEN page_id % 3 = 0 OR {_any('h', vocab.SCIENCE_HINTS)} THEN 'scientific' WHEN {_any('h', vocab.GOVERNMENT_HINTS)} THEN 'government' WHEN {_any('h', vocab.NEWS_HINTS)} OR {_any('p', vocab.NEWS_HINTS)} THEN 'news' "
        f"WHEN contains(h, 'blog') OR contains(p, '/blog') OR contains(h, 'medium.com') THEN 'blog' ELSE 'generic' END AS category FROM (SELECT page_id, lower(regexp_extract(url, '://([^/?#]*)', 1)) AS h, lower({PATH.format('url')}) AS p FROM pages)",
    ),
}
