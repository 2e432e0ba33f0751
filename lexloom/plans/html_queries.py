"""HTML rules over built pages, whose outcome SQL can tell from the numbers they are built by."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexloom.functions import text as T
from lexloom.functions import url as U
from lexloom.html import frames, pages
from lexloom.html.documents import reconciled
from lexloom.operators import audit
from lexloom.session import table
from lexloom.sources import artifacts

def listings(spark, sf):
    """Pages that list documents: page g holds the first 3 to 10 of documents 10 g to 10 g + 9 as cards."""
    snippet = F.btrim(F.repeat(F.lit("word "), (12 + F.col("doc_id") % 12).cast("int")))
    card = F.concat(F.lit('<li class="card"><h3><a href="/d/'), F.col("doc_id"), F.lit('">Item '), F.col("doc_id"), F.lit("</a></h3><p>"), snippet, F.lit("</p></li>"))
    docs = table(spark, sf, "documents").select("doc_id", F.floor(F.col("doc_id") / 10).alias("page"))
    held = docs.where(F.col("doc_id") % 10 < 3 + F.col("page") % 8).groupBy("page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", card.alias("c")))), lambda x: x["c"]), "").alias("cards"), F.count("*").alias("n"))
    html = F.concat(F.lit('<html><body><nav><a href="/home">Home page</a></nav><main><ul>'), "cards", F.lit("</ul></main></body></html>"))
    return held.where("n >= 3").select(F.col("page").alias("page_id"), F.concat(F.lit("https://site.example/list/"), F.col("page")).alias("url"), html.alias("html"))


LISTINGS_SQL = (
    "cards AS (SELECT doc_id // 10 AS page_id, doc_id, length('Item ' || doc_id) + 5 * (12 + doc_id % 12) AS chars FROM documents WHERE doc_id % 10 < 3 + (doc_id // 10) % 8), "
    "g AS (SELECT page_id, count(*) AS n, sum(chars) AS chars, avg(chars) AS mean, stddev_pop(chars) AS spread, min(doc_id) AS first, max(doc_id % 12) AS k, list('https://site.example/d/' || doc_id ORDER BY doc_id) AS urls FROM cards GROUP BY 1 HAVING count(*) >= 3), "
    "s AS (SELECT *, round(0.35 * least(n / 10, 1) + 0.30 + 0.20 * least(mean / 300, 1) + 0.15 * greatest(0, 1 - spread / (2 * mean)), 3) AS score, chars + n - 1 AS root_chars FROM g), "
    "m AS (SELECT *, CASE WHEN n >= 4 AND score >= 0.5 AND chars / (root_chars + 10) >= 0.4 THEN 'listing' WHEN root_chars >= 1200 THEN 'article' ELSE 'navigation' END AS kind FROM s)"
)


def _maps(spark, sf):
    return frames.page_maps(listings(spark, sf), "page_id")


def _kinds(spark, sf):
    return _maps(spark, sf).select("page_id", "page_kind", "text_chars", "root_selector", "root_chars", "paragraph_chars", "group_items", "group_score")


def _items(spark, sf):
    return _maps(spark, sf).select("page_id", F.posexplode("listing_items").alias("k", "i")).select("page_id", "k", F.col("i.title").alias("title"), F.col("i.url").alias("url"), F.length("i.snippet").alias("chars"))


def _picked(htmls, url="http://h.org/l"):
    """Return every page with one of the given sources, by its number."""

    def rows(spark, sf):
        source = F.get(F.array(*[F.lit(h) for h in htmls]), (F.col("page_id") % len(htmls)).cast("int"))
        return table(spark, sf, "pages").select("page_id", F.lit(url).alias("url"), source.alias("html"))

    return rows


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, (list, tuple)):
        return "[" + ", ".join(map(_literal, value)) + "]"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def _told(values, name: str, kind: str = "VARCHAR") -> str:
    """Return the expression of the value that each case must give."""
    return f"([{', '.join(map(_literal, values))}]::{kind}[])[page_id % {len(values)} + 1] AS {name}"


CARDS = "".join(f"<article><h3><a href='/n/{k}'>N {k}</a></h3><a href='/n/{k}'>Ver más »</a></article>" for k in range(10))
_numbers = lambda *n: "<div>" + "".join(f"<a href='/v/{k}'>{k}</a>" for k in n) + "</div>"
_h = "http://h.org"
PAGING = [
    ("<a rel='next' href='/l/2'>x</a>", [f"{_h}/l/2"], False), ("<a href='?page=2'>2</a>", [f"{_h}/l?page=2"], False), ("<a href='?offset=20'>more</a>", [f"{_h}/l?offset=20"], False),
    ("<a href='/l/page/2/'>older</a>", [f"{_h}/l/page/2/"], False), ("<a href='/l/seite/2'>weiter</a>", [f"{_h}/l/seite/2"], False), ("<a href='/n'>Página siguiente</a>", [f"{_h}/n"], False), ("<a href='/n'>Load more</a>", [f"{_h}/n"], False),
    ("<a href='http://other.org/l?page=2'>next</a>", [], False), ("<a href='/m'>Ver más</a>" * 4, [], False), ("<a href='/m'>Ver más</a>", [f"{_h}/m"], False), (_numbers(1, 2, 3), [f"{_h}/v/1", f"{_h}/v/2", f"{_h}/v/3"], False),
    (_numbers(2022, 2023, 2024), [], False), (_numbers(1, 2), [], False), (_numbers(1, 2, 4), [], False), ("<div class='pagination'><button>2</button></div>", [], True), ("<div class='btn-next'><button>2</button></div>", [], False),
    (CARDS + "<nav class='pager'><a href='/l/page/2/'>Después »</a></nav>", [f"{_h}/l/page/2/"], False), ("<a href='/x'>Anterior</a>", [], False),
]
_padded = ["<p>" + "some words that fill this page up " * 4 + "</p>" + h for h, _, _ in PAGING]

_article = "<body><main><p>" + "words of an article " * 80 + "</p></main>{}</body>"
FULL = [
    ("<a href='/a.pdf'>Get it</a><a href='/menu'>Menu</a>", [f"{_h}/a.pdf|pdf|true"]), ("<a href='/bitstreams/1/x'>Get</a>", [f"{_h}/bitstreams/1/x|download|true"]), ("<a href='http://x.org/f'>Full text</a>", ["http://x.org/f|fulltext|false"]),
    ("<a href='http://x.org/f'>Full text</a><a href='/b.pdf'>B</a>", [f"{_h}/b.pdf|pdf|true", "http://x.org/f|fulltext|false"]), ("<a href='/a.pdf'>PDF</a><div><h3>Full text links</h3><a href='/here'>Publisher</a></div>", [f"{_h}/here|fulltext|true"]),
    ("<a href='/l'>texto completo</a>", []), ("<a href='#x'>full text</a>", []), ("<a href='#free'>pdf</a>", []), ("<a href='mailto:a@b'>download</a>", []), ("<a href='/l#view'>Texto completo</a>", [f"{_h}/l#view|fulltext|true"]),
]

# Heads: what each states, with the title, authors, date, licence, site and canonical address that must be found.
_ld = lambda body: f"<script type='application/ld+json'>{body}</script>"
HEADS = [
    ("<html lang='es'><title>Only this</title>", "Only this", [], None, None, None, "es", None, False),
    ("<title>Site</title><meta property='og:title' content='Open title'>", "Open title", [], None, None, None, None, None, False),
    ("<meta name='citation_title' content='Cited'><meta name='citation_author' content='One'><meta name='citation_author' content='Two'><meta name='citation_date' content='2020-01-02'>", "Cited", ["One", "Two"], "2020-01-02", None, None, None, None, True),
    (_ld('{"@type": "NewsArticle", "headline": "Headed", "datePublished": "2024-05-06", "author": [{"name": "Ann"}, {"name": "Bob"}], "license": {"url": "http://l.org"}, "publisher": {"name": "Paper"}}'), "Headed", ["Ann", "Bob"], "2024-05-06", "http://l.org", "Paper", None, None, False),
    (_ld('{"@graph": [{"@type": "Organization", "headline": "No"}, {"@type": "WebPage", "headline": "In a graph"}]}'), "In a graph", [], None, None, None, None, None, False),
    (_ld("{broken") + _ld('[{"@type": "Thing"}, {"@type": "Report", "author": "Cy, Di", "license": "none"}]'), None, ["Cy", "Di"], None, None, None, None, None, False),
    ("<meta name='author' content=' Ed '><meta name='dc.date' content='1999'><link rel='canonical' href='http://h.org/c'><a rel='license nofollow' href='/by'>x</a>", None, ["Ed"], "1999", "/by", None, None, "http://h.org/c", False),
    ("<title>News of the site</title><body><h1>A heading that shares nothing</h1><a href='https://creativecommons.org/licenses/by/4.0/'>CC</a>", "A heading that shares nothing", [], None, "https://creativecommons.org/licenses/by/4.0/", None, None, None, False),
    ("<title>Heading words here</title><body><h1>A heading with words in it</h1><meta property='og:site_name' content='Here'><meta property='og:locale' content='fr'>", "Heading words here", [], None, None, "Here", "fr", None, False),
    ("<title>Site</title><h1>Short</h1>", "Site", [], None, None, None, None, None, False),
]

RENDER = [
    ("<article>" + "real text " * 60 + "</article>", False), ("<div id='root'></div>", True), ("<div>This site requires JavaScript</div>" + "x " * 200, True), ("<noscript>Please enable JavaScript</noscript>" + "x " * 300, True),
    ("<noscript>enable javascript</noscript>" + "word " * 400, False), ("<script>s = 'enable javascript'</script>" + "word " * 150, False), ("<nav>" + "link " * 300 + "</nav><div id='app'></div>", True), ("<div id='app'>" + "word " * 150 + "</div>", False),
    ("<div data-v-app>" + "word " * 50 + "</div>", True), ("<script></script>" * 11 + "word " * 50, True), ("<script></script>" * 10 + "word " * 50, False), ("tiny", True),
]

RIGHTS = [
    ("<meta name='robots' content='noai, nofollow'>", True, [], None, []), ("<a rel='license' href='/l'>x</a>", False, [f"{_h}/l"], None, []), ("<a href='https://creativecommons.org/licenses/by/4.0/'>CC</a>" * 2, False, ["https://creativecommons.org/licenses/by/4.0/"], None, []),
    ("<p>© 2024 Me. All</p>", False, [], "© 2024 Me", []), ("<a href='/t'>Aviso legal</a><a href='http://o.org/t'>Terms of use</a>", False, [], None, [f"Aviso legal|{_h}/t"]), ("<p>none</p>", False, [], None, []),
    ("".join(f"<a href='/t{k}'>Términos {k}</a>" for k in range(5)), False, [], None, [f"Términos {k}|{_h}/t{k}" for k in range(3)]),
]

DIGESTS = [
    ("<title>" + "t" * 130 + "</title><h1>One</h1><h4>No</h4><h3>Three</h3>", "t" * 120, ["One", "Three"], []), ("<a href='/a'>News</a><a href='/b'>NEWS</a><a href='/c'>x</a><a>none</a><a href='/d'>" + "l" * 41 + "</a>", "", [], ["News"]),
    ("".join(f"<h2>H {k}</h2><a href='/{k}'>Label {k}</a>" for k in range(25)), "", [f"H {k}" for k in range(12)], [f"Label {k}" for k in range(20)]),
]


def _paged(spark, sf):
    maps = frames.page_maps(_picked(_padded)(spark, sf), "page_id")
    return maps.select("page_id", F.array_join("pagination_urls", " ").alias("urls"), F.col("pagination_js_only").alias("js_only"))


def _full(spark, sf):
    maps = frames.page_maps(_picked([_article.format(h) for h, _ in FULL])(spark, sf), "page_id")
    shown = F.transform("fulltext_links", lambda x: F.concat_ws("|", x["url"], x["kind"], x["same_site"].cast("string")))
    return maps.select("page_id", F.array_join(shown, " ").alias("links"))


def _heads(spark, sf):
    found = frames.head_metadata(_picked([h for h, *_ in HEADS])(spark, sf), "page_id")
    return found.select("page_id", "title", F.array_join("authors", ", ").alias("authors"), "published_date", "license_url", "site_name", "language", "canonical", "has_citation")


def _rendered(spark, sf):
    return frames.extracted(_picked(["<body>" + h + "</body>" for h, _ in RENDER])(spark, sf), "page_id").select("page_id", "needs_rendering")


def _rights(spark, sf):
    found = frames.rights_signals(_picked([h for h, *_ in RIGHTS])(spark, sf), "page_id")
    return found.select("page_id", "meta_noai", F.array_join("license_links", " ").alias("licenses"), "copyright_line", F.array_join(F.transform("legal_pages", lambda x: F.concat_ws("|", x["label"], x["url"])), " ").alias("legal"))


def _digests(spark, sf):
    found = frames.extracted(_picked([h for h, *_ in DIGESTS])(spark, sf), "page_id").select("page_id", "digest.*")
    return found.select("page_id", "title", F.array_join("headings", "|").alias("headings"), F.array_join("labels", "|").alias("labels"))


PLAIN_SQL = r"trim(regexp_replace(regexp_replace(text, '[<>&]', ' ', 'g'), '\s+', ' ', 'g'))"


def articles(spark, sf):
    """Documents as pages: the text without signs that mean something in HTML, as one paragraph of an article."""
    docs = table(spark, sf, "documents").select("doc_id", T.collapse(F.regexp_replace("text", "[<>&]", " ")).alias("plain"))
    html = F.concat(F.lit("<html><head>"), F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("<link rel='canonical' href='https://c.org/"), "doc_id", F.lit("'>"))).otherwise(""), F.lit("</head><body><nav>menu</nav><article><p>"), "plain", F.lit("</p></article></body></html>"))
    return docs.select("doc_id", F.concat(F.lit("https://d.org/"), "doc_id").alias("url"), html.alias("html"), "plain")


def _extracted(spark, sf):
    found = frames.extracted(articles(spark, sf).withColumnRenamed("doc_id", "n"), "n")
    return found.select("n", "doc_id", "n_words", F.length("markdown").alias("chars"), "needs_rendering")


def _coverage(spark, sf):
    """Every third document's text is cut to a fifth, as if the rest had not been found."""
    rows = articles(spark, sf)
    maps = frames.page_maps(rows, "doc_id")
    part = F.when(F.col("doc_id") % 3 == 0, F.substring("plain", F.lit(1), F.floor(F.length("plain") / 5).cast("int"))).otherwise(F.col("plain"))
    return audit.low_coverage(rows.select("doc_id", part.alias("text")), maps).select("doc_id", F.round("coverage", 4).alias("coverage"))


def _links(spark, sf):
    found = frames.page_links(table(spark, sf, "pages"), "page_id")
    every = [found.select("page_id", F.lit(d).alias("document"), F.posexplode(c).alias("k", "link")) for c, d in (("html_links", False), ("document_links", True))]
    return every[0].unionByName(every[1])


def _sections(spark, sf):
    found = frames.page_sections(table(spark, sf, "pages"), "page_id").select("page_id", F.posexplode("sections").alias("k", "s"))
    return found.select("page_id", "k", F.col("s.name").alias("name"), F.col("s.url").alias("url"), F.col("s.path_depth").alias("depth"), F.col("s.is_media").alias("media"))


_anchors = (
    "a AS (SELECT page_id, regexp_extract(url, '^(https?://[^/?#]*)', 1) AS base, regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) AS here, unnest(regexp_extract_all(html, '<a [^>]*href=\"[^\"]*\"[^>]*>[^<]*</a>')) AS tag, generate_subscripts(regexp_extract_all(html, '<a [^>]*href=\"[^\"]*\"[^>]*>[^<]*</a>'), 1) AS i FROM pages), "
    "t AS (SELECT page_id, i, base, here, replace(regexp_extract(tag, 'href=\"([^\"]*)\"', 1), '&amp;', '&') AS href, trim(regexp_replace(replace(regexp_extract(tag, '>([^<]*)</a>', 1), '&amp;', '&'), '\\s+', ' ', 'g')) AS label FROM a)"
)
LINKS_SQL = (
    f"WITH {_anchors}, l AS (SELECT page_id, i, base || regexp_replace(regexp_replace(href, '#.*$', ''), '^/$', '') AS link FROM t WHERE href <> '' AND NOT starts_with(href, '#')), f AS (SELECT page_id, link, min(i) AS i FROM l GROUP BY ALL), "
    "d AS (SELECT *, regexp_matches(split_part(lower(link), '?', 1), '\\.(pdf|docx|doc|odt|rtf)$') OR regexp_matches(link, '(?i)/download(/|$|\\?)|/bitstreams?/|[?&](download|attachment|file)=|/attachments?/') AS document FROM f) "
    "SELECT page_id, document, (row_number() OVER (PARTITION BY page_id, document ORDER BY i) - 1)::INT AS k, link FROM d"
)
_re = lambda p: p.pattern.replace("'", "''")
SECTIONS_SQL = (
    f"WITH {_anchors}, p AS (SELECT *, regexp_replace(regexp_extract(href, '^([^?#]*)', 1), '/+$', '') AS path, split_part(href, '#', 2) AS fragment FROM t), "
    "s AS (SELECT *, list_filter(string_split(path, '/'), lambda x: x <> '') AS steps FROM p), "
    f"ok AS (SELECT * FROM s WHERE length(label) BETWEEN 2 AND 40 AND NOT regexp_matches(label, '(?i){_re(pages.NO_SECTION)}') AND NOT regexp_matches(path, '(?i){_re(pages.NO_SECTION_PATH)}') AND fragment = '' AND len(steps) BETWEEN 1 AND 3 AND path <> regexp_replace(here, '/+$', '') "
    f"AND (len(steps) = 1 OR NOT regexp_matches(steps[-1], '(?i){_re(pages.ARTICLE_FILE)}'))), "
    f"f AS (SELECT *, row_number() OVER (PARTITION BY page_id, lower(path) ORDER BY i) AS nth, regexp_matches(label, '(?i){_re(pages.MEDIA)}') OR regexp_matches(path, '(?i){_re(pages.MEDIA)}') AS media FROM ok), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY media, len(steps), i) - 1 AS k FROM f WHERE nth = 1) SELECT page_id, k::INT AS k, label AS name, base || href AS url, len(steps)::INT AS depth, media FROM r WHERE k < 12"
)

TITLES = [("Site", "A heading that says more"), ("A heading", "A heading that says more"), (None, "A heading that says more"), ("Site", "Short one"), (None, "Short one"), ("Más noticias", "Las noticias de hoy en casa")]


def _reconciled(spark, sf):
    out = F.get(F.array(*[F.lit(reconciled(a, b)) for a, b in TITLES]), (F.col("page_id") % len(TITLES)).cast("int"))
    return table(spark, sf, "pages").select("page_id", out.alias("title"))


def _absolute(spark, sf):
    hrefs = ["../c#d", "mailto:x", "/", "ftp://x", None, "x?y=1#z", "//other.org/p", "http://other.org", "#top", "javascript:go()", "?q=2"]
    href = F.get(F.array(*[F.lit(h) for h in hrefs]), (F.col("page_id") % len(hrefs)).cast("int"))
    return table(spark, sf, "pages").select("page_id", U.absolute(F.lit("http://h.org/a/b"), href).alias("link"))


QUERIES = {
    "listing_page_kind": (
        _kinds,
        f"WITH {LISTINGS_SQL} SELECT page_id, kind AS page_kind, (root_chars + 10)::INT AS text_chars, 'body > main > ul' AS root_selector, root_chars::INT AS root_chars, (5 * (12 + k) - 1)::INT AS paragraph_chars, n::INT AS group_items, score AS group_score FROM m",
    ),
    "listing_page_items": (
        _items,
        f"WITH {LISTINGS_SQL}, i AS (SELECT c.page_id, c.doc_id, c.chars, row_number() OVER (PARTITION BY c.page_id ORDER BY c.doc_id) - 1 AS k FROM cards c JOIN m USING (page_id) WHERE kind = 'listing' OR (n >= 5 AND score >= 0.65)) SELECT page_id, k::INT AS k, 'Item ' || doc_id AS title, 'https://site.example/d/' || doc_id AS url, chars::INT AS chars FROM i",
    ),
    "listing_summary": (lambda spark, sf: artifacts.listing_summary(_maps(spark, sf)), f"WITH {LISTINGS_SQL} SELECT 'https://site.example/list/' || page_id AS url, n::INT AS n_items, false AS pagination_js_only FROM m WHERE kind = 'listing'"),
    "page_landmarks": (
        lambda spark, sf: _maps(spark, sf).select("page_id", F.posexplode("landmarks").alias("k", "x")).select("page_id", "k", F.col("x.tag").alias("tag"), F.col("x.selector").alias("selector"), F.col("x.chars").alias("chars")),
        f"WITH {LISTINGS_SQL} SELECT page_id, 0 AS k, 'main' AS tag, 'body > main' AS selector, root_chars::INT AS chars FROM m UNION ALL SELECT page_id, 1, 'nav', 'body > nav', 9 FROM m",
    ),
    "pagination_links": (_paged, f"SELECT page_id, {_told([' '.join(u) for _, u, _ in PAGING], 'urls')}, {_told([j for *_, j in PAGING], 'js_only', 'BOOLEAN')} FROM pages"),
    "fulltext_links": (_full, f"SELECT page_id, {_told([' '.join(x) for _, x in FULL], 'links')} FROM pages"),
    "head_metadata_cases": (
        _heads,
        "SELECT page_id, " + ", ".join([_told([h[1] for h in HEADS], "title"), _told([", ".join(h[2]) for h in HEADS], "authors"), _told([h[3] for h in HEADS], "published_date"), _told([h[4] for h in HEADS], "license_url"), _told([h[5] for h in HEADS], "site_name"), _told([h[6] for h in HEADS], "language"), _told([h[7] for h in HEADS], "canonical"), _told([h[8] for h in HEADS], "has_citation", "BOOLEAN")]) + " FROM pages",
    ),
    "title_reconciled": (_reconciled, f"SELECT page_id, {_told(['A heading that says more', 'A heading', 'A heading that says more', 'Site', None, 'Más noticias'], 'title')} FROM pages"),
    "needs_rendering": (_rendered, f"SELECT page_id, {_told([r for _, r in RENDER], 'needs_rendering', 'BOOLEAN')} FROM pages"),
    "home_rights_signals": (
        _rights,
        "SELECT page_id, " + ", ".join([_told([r[1] for r in RIGHTS], "meta_noai", "BOOLEAN"), _told([" ".join(r[2]) for r in RIGHTS], "licenses"), _told([r[3] for r in RIGHTS], "copyright_line"), _told([" ".join(r[4]) for r in RIGHTS], "legal")]) + " FROM pages",
    ),
    "page_digest": (_digests, "SELECT page_id, " + ", ".join([_told([d[1] for d in DIGESTS], "title"), _told(["|".join(d[2]) for d in DIGESTS], "headings"), _told(["|".join(d[3]) for d in DIGESTS], "labels")]) + " FROM pages"),
    "article_extract": (
        _extracted,
        f"WITH p AS (SELECT doc_id AS n, {PLAIN_SQL} AS t FROM documents), w AS (SELECT *, CASE WHEN t = '' THEN 0 ELSE len(string_split(t, ' ')) END::INT AS n_words FROM p) "
        "SELECT n, substr(sha256(CASE WHEN n % 2 = 0 THEN 'https://c.org/' || n ELSE 'https://d.org/' || n END), 1, 16) AS doc_id, n_words, CASE WHEN n_words >= 80 THEN length(t) END::INT AS chars, length(t) + CASE WHEN t = '' THEN 4 ELSE 5 END < 100 AS needs_rendering FROM w",
    ),
    "low_coverage": (
        _coverage,
        f"WITH p AS (SELECT doc_id, {PLAIN_SQL} AS t FROM documents), c AS (SELECT doc_id, t, length(trim(CASE WHEN doc_id % 3 = 0 THEN substr(t, 1, length(t) // 5) ELSE t END)) / length(t) AS coverage FROM p WHERE length(t) >= 1500) SELECT doc_id, round(coverage, 4) AS coverage FROM c WHERE coverage < 0.35",
    ),
    "page_links": (_links, LINKS_SQL),
    "page_sections": (_sections, SECTIONS_SQL),
    "url_absolute": (_absolute, "SELECT page_id, " + _told(["http://h.org/c", None, "http://h.org", None, None, "http://h.org/a/x?y=1", "http://other.org/p", "http://other.org", None, None, "http://h.org/a/b?q=2"], "link") + " FROM pages"),
}
