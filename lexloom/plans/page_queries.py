"""What HTML pages hold; the marks that SQL can see have an oracle, the trees are tested with pytest."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexloom.functions import text as T
from lexloom.functions import vocab
from lexloom.html import frames
from lexloom.plans import fixtures
from lexloom.session import table

VISIBLE = "len(list_filter(regexp_split_to_array(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script>', ' ', 'g'), '(?is)<style\\b.*?</style>', ' ', 'g'), '(?is)<noscript\\b.*?</noscript>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\\s+'), lambda w: w <> ''))"


def _pages(spark, sf):
    return table(spark, sf, "pages")


def _hrefs(spark, sf):
    """Raw targets of links, as the markup has them."""
    return _pages(spark, sf).select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit('<a [^>]*href="([^"]*)"'), 1)).alias("k", "href"))


def _blocked(spark, sf):
    """A mark is put into every third page and a blocking status given to every eleventh."""
    marks = vocab.CHALLENGE_MARKS
    mark = F.get(F.array(*[F.lit(m) for m in marks]), (F.col("page_id") % len(marks)).cast("int"))
    put = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("<p>"), mark, F.lit("</p>"))).when(F.col("page_id") % 3 == 1, F.concat(F.lit("<p>x"), mark, F.lit("s</p>"))).otherwise("")
    rows = _pages(spark, sf).select("page_id", F.concat(put, "html").alias("html"), F.when(F.col("page_id") % 11 == 0, 429).otherwise(200).alias("status"))
    return rows.select("page_id", frames.block_kind(F.col("status"), F.col("html")).alias("kind"))


_marks = "(" + "|".join(m.replace(".", r"\.") for m in vocab.CHALLENGE_MARKS) + ")"
BLOCKED_SQL = (
    "WITH m AS (SELECT page_id, html AS h0, ([" + ", ".join(f"'{m}'" for m in vocab.CHALLENGE_MARKS) + f"])[page_id % {len(vocab.CHALLENGE_MARKS)} + 1] AS mark FROM pages), p AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN '<p>' || mark || '</p>' WHEN 1 THEN '<p>x' || mark || 's</p>' ELSE '' END || h0 AS html FROM m) "
    f"SELECT page_id, CASE WHEN page_id % 11 = 0 THEN 'http_block' WHEN regexp_matches(lower(substr(html, 1, 20000)), '(^|[^\\p{{L}}\\p{{N}}_-]){_marks}($|[^\\p{{L}}\\p{{N}}_-])') AND {VISIBLE} <= 250 THEN 'captcha' ELSE '' END AS kind FROM p"
)


def _from_documents(spark, sf):
    docs = fixtures.documents(spark, sf)
    pairs = docs.select(F.col("doc_id").alias("a"), "text").join(docs.select((F.col("doc_id") - 20).alias("a"), F.col("text").alias("other")), "a")
    return pairs.select("a", T.character_similarity("text", "other").alias("similarity"))


QUERIES = {
    "visible_words": (lambda spark, sf: _pages(spark, sf).select("page_id", T.visible_words("html").alias("words")), f"SELECT page_id, {VISIBLE}::INT AS words FROM pages"),
    "page_hrefs": (_hrefs, "WITH a AS (SELECT page_id, regexp_extract_all(html, '<a [^>]*href=\"([^\"]*)\"', 1) AS h FROM pages) SELECT page_id, unnest(range(0, len(h)))::INT AS k, unnest(h) AS href FROM a"),
    "page_language": (
        lambda spark, sf: frames.head_metadata(_pages(spark, sf), "page_id").select("page_id", "language"),
        "SELECT page_id, nullif(regexp_extract(html, '<html[^>]*lang=\"([^\"]*)\"', 1), '') AS language FROM pages",
    ),
    "block_check": (_blocked, BLOCKED_SQL),
    "page_map": (lambda spark, sf: frames.page_maps(_pages(spark, sf), "page_id"), None),
    "head_metadata": (lambda spark, sf: frames.head_metadata(_pages(spark, sf), "page_id"), None),
    "page_extract": (lambda spark, sf: frames.extracted(_pages(spark, sf), "page_id"), None),
    "page_rights_signals": (lambda spark, sf: frames.rights_signals(_pages(spark, sf), "page_id"), None),
    "character_similarity": (_from_documents, None),
}
