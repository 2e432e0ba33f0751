"""Text functions, dedup, audit, rights and export over all documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexloom.functions import text as T
from lexloom.functions import vocab
from lexloom.operators import audit, dedup, report, rights, scans
from lexloom.plans.fixtures import DOCUMENTS_SQL, documents
from lexloom.session import table

TOKENS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}_]+')"
FLAT = r"trim(regexp_replace({0}, '\s+', ' ', 'g'))"
SPLIT = r"list_filter(regexp_split_to_array({0}, '\s+'), lambda w: w <> '')"
#: Lines that a tenth of a source's documents hold count as common (at four tenths these tables have none).
SHARE = 0.1


def _docs(*columns):
    return lambda spark, sf: table(spark, sf, "documents").select("doc_id", *[c() for c in columns])


def near_duplicate_pairs(spark, sf):
    pairs, _ = dedup.near_duplicates(table(spark, sf, "documents"))
    return pairs.select("a", "b", F.round("jaccard", 2).alias("jaccard"))


def near_duplicate_members(spark, sf):
    """Every document that takes part: its class and whether anything repeats it or comes near it."""
    pairs, members = dedup.near_duplicates(table(spark, sf, "documents"))
    partner = dedup.with_partner(pairs, members).withColumn("partner", F.lit(True))
    return members.join(partner, "doc_id", "left").select("doc_id", "class_id", "class_size", F.coalesce("partner", F.lit(False)).alias("partner"))


def token_f1_pairs(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    left = docs.select(F.col("doc_id").alias("a"), F.col("text").alias("a_text"), (F.col("doc_id") + 20).alias("b"))
    pairs = left.join(docs.select(F.col("doc_id").alias("b"), F.col("text").alias("b_text")), "b")
    return report.token_f1(pairs).select("a", "b", F.round("f1", 6).alias("f1"))


def _common(spark, sf):
    return audit.boilerplate_lines(documents(spark, sf), SHARE)


def strip_boilerplate(spark, sf):
    done = audit.strip_boilerplate(documents(spark, sf).withColumn("text", F.btrim("text")), _common(spark, sf))
    return done.where("removed_lines > 0").select("doc_id", "removed_lines", F.length("text").alias("chars"))


def audit_flags(spark, sf):
    docs = documents(spark, sf)
    ids = dedup.with_partner(*dedup.near_duplicates(docs))
    titles = audit.title_flags(docs)
    status = docs.withColumn("http_status", F.when(F.col("doc_id") % 97 == 0, 404).otherwise(200))
    return audit.flags({
        "near_duplicate": ids, "boilerplate": audit.boilerplate_ratio(docs, _common(spark, sf), 0.05), "language_mismatch": audit.language_mismatch(docs),
        "generic_title": titles.where("flag = 'generic_title'"), "duplicated_title": titles.where("flag = 'duplicated_title'"), "linky": audit.linky(docs), "http_error": audit.http_errors(status),
    })


def _verdicts(spark, sf):
    """Signals of each source, derived from its number."""
    sources = table(spark, sf, "documents").select("source").distinct().withColumn("n", F.regexp_extract("source", r"(\d+)$", 1).cast("int"))
    k = F.col("n") % 8
    none = F.array().cast("array<string>")
    given = lambda at, value: F.when(k == at, F.array(F.lit(value))).otherwise(none)
    domain = F.when(k == 5, F.concat("source", F.lit(".gob.cl"))).otherwise(F.concat("source", F.lit(".example")))
    rows = sources.select("n", domain.alias("domain"), F.when(k == 0, "search=yes, AI-train=no").alias("cs"), given(1, "GPTBot").alias("bots"), given(2, "https://creativecommons.org/licenses/by/4.0/").alias("links"), F.when(k == 3, "© 2024 All Rights Reserved").when(k == 4, "© 2024 Someone").alias("line"), given(6, "queda prohibida").alias("found"), (k == 7).alias("tdm"))
    return rows.select("n", "domain", rights.verdict(F.col("domain"), F.col("cs"), F.col("bots"), F.col("tdm"), F.lit(False), F.col("links"), F.col("line"), F.col("found")).alias("verdict"))


VERDICTS_SQL = r"""verdicts AS (
  SELECT n, CASE WHEN n % 8 = 5 THEN source || '.gob.cl' ELSE source || '.example' END AS domain,
         (['tdm-o-ai-reservado', 'tdm-o-ai-reservado (bloquea bots de IA)', 'cc-license', 'todos-los-derechos-reservados', 'copyright-declarado-sin-terminos-visibles',
           'sector-publico (revisar política de datos abiertos)', 'todos-los-derechos-reservados', 'tdm-o-ai-reservado'])[n % 8 + 1] AS verdict
  FROM (SELECT DISTINCT source, regexp_extract(source, '(\d+)$', 1)::INT AS n FROM documents))"""
PARTITION_SQL = "CASE WHEN starts_with(verdict, 'cc-license') OR starts_with(verdict, 'sector-publico') THEN 'permisivo' WHEN starts_with(verdict, 'todos-los') THEN 'derechos_reservados' WHEN starts_with(verdict, 'tdm') THEN 'reservado_ia' ELSE 'revisar' END"


def _export(spark, sf):
    docs = documents(spark, sf).withColumn("text", F.when(F.col("doc_id") % 50 != 7, F.col("text")))
    return rights.export_rows(docs, _verdicts(spark, sf))


EXPORT_SQL = rf"""{DOCUMENTS_SQL}, {VERDICTS_SQL}, parts AS (SELECT domain, {PARTITION_SQL} AS part FROM verdicts), rows AS (
  SELECT doc_id, url, CASE WHEN doc_id % 50 <> 7 THEN text END AS text, coalesce(part, 'revisar') AS partition FROM docs LEFT JOIN parts USING (domain)
), judged AS (
  SELECT doc_id, partition, CASE WHEN text IS NULL THEN 0 ELSE len({SPLIT.format('text')}) END::INT AS words, text IS NULL AS gone FROM rows
), export AS (SELECT doc_id, partition, words, CASE WHEN gone THEN 'sin_texto' WHEN words < 50 THEN 'texto_corto' END AS skipped FROM judged)"""


def corpus_report(spark, sf):
    docs = documents(spark, sf).withColumns({"words": T.count_words("text"), "size": F.when(F.length("text") > 1000, "long").otherwise("short")})
    return report.corpus_counts(docs, ["domain", "lang", "size"])


def ocr_triage(spark, sf):
    """Each source is a file of up to 50 pages: its documents, with an image share by number."""
    pages = table(spark, sf, "documents").select(F.col("source").alias("doc_id"), F.col("doc_id").alias("page"), F.when((F.regexp_extract("source", r"(\d+)$", 1).cast("int") % 2 == 0) & (F.col("doc_id") % 3 != 0), "").otherwise(F.col("text")).alias("text"), ((F.col("doc_id") % 4) / 3).alias("image_ratio"))
    out = scans.triage(pages)
    return out.select("doc_id", "pages", F.round("avg_chars", 6).alias("avg_chars"), F.round("avg_image_ratio", 6).alias("avg_image_ratio"), "without_text", "needs_ocr", scans.engine(F.col("avg_image_ratio"), F.col("bad_text_ratio"), F.col("avg_chars")).alias("engine"))


_langs = {k: ", ".join(f"'{w}'" for w in v) for k, v in vocab.STOPWORDS.items()}
LANG_SQL = "scored AS (SELECT *, " + ", ".join(f"len(list_filter(w, lambda x: x IN ({v}))) AS {k}" for k, v in _langs.items()) + " FROM (SELECT doc_id, source, text, regexp_extract_all(lower(text), '[a-záéíóúñãõç]+')[1:4000] AS w FROM documents)), told AS (SELECT doc_id, source, text, CASE WHEN greatest(es, en, pt) <= 5 THEN '?' WHEN es = greatest(es, en, pt) THEN 'es' WHEN en = greatest(es, en, pt) THEN 'en' ELSE 'pt' END AS detected FROM scored)"
MISMATCH_SQL = LANG_SQL + ", long AS (SELECT * FROM told WHERE length(text) > 300), majority AS (SELECT source, detected AS majority FROM (SELECT source, detected, row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, detected) AS r FROM long GROUP BY source, detected) WHERE r = 1), mismatch AS (SELECT doc_id, detected, majority FROM long JOIN majority USING (source) WHERE detected <> '?' AND majority <> '?' AND detected <> majority)"
LINES_SQL = "lines AS (SELECT doc_id, source || '.example' AS domain, trim(line) AS line FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE length(trim(line)) > 25), totals AS (SELECT source || '.example' AS domain, count(*) AS docs FROM documents GROUP BY 1 HAVING count(*) >= 5), common AS (SELECT domain, line, count(DISTINCT doc_id) AS n_docs, count(DISTINCT doc_id) / any_value(docs) AS share FROM lines JOIN totals USING (domain) GROUP BY domain, line HAVING count(DISTINCT doc_id) / any_value(docs) >= 0.1), ratios AS (SELECT doc_id, count(*) FILTER (c.line IS NOT NULL) / count(*) AS ratio FROM lines l LEFT JOIN common c ON l.domain = c.domain AND l.line = c.line GROUP BY doc_id)"
TITLES_SQL = "titled AS (SELECT doc_id, source, trim(split_part(text, chr(10), 1)) AS t FROM documents), titles AS (SELECT doc_id, CASE WHEN length(t) < 8 OR source = lower(t) THEN 'generic_title' WHEN n > 1 THEN 'duplicated_title' END AS flag, n AS n_titles FROM (SELECT *, count(*) OVER (PARTITION BY t) AS n FROM titled))"
PAIRS_SQL = (
    "toks AS (SELECT doc_id, " + TOKENS.format("text") + " AS t FROM documents WHERE length(text) > 400), every AS (SELECT DISTINCT doc_id, array_to_string(t[i:i + 4], ' ') AS s FROM (SELECT doc_id, t, unnest(range(1, len(t) - 3)) AS i FROM toks WHERE len(t) >= 5)), "
    "named AS (SELECT doc_id, list(s ORDER BY s) AS k FROM every GROUP BY doc_id), members AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY k) AS class_id, count(*) OVER (PARTITION BY k) AS class_size FROM named), sh AS (SELECT doc_id, s FROM every WHERE doc_id IN (SELECT class_id FROM members)), "
    "sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id), inter AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL), "
    "pairs AS (SELECT a, b, i / (p.n + q.n - i) AS jaccard FROM inter JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE i / (p.n + q.n - i) >= 0.7), "
    "partnered AS (SELECT *, class_size > 1 OR class_id IN (SELECT a FROM pairs UNION SELECT b FROM pairs) AS partner FROM members)"
)
FLAGS_SQL = f"{PAIRS_SQL}, {LINES_SQL}, {MISMATCH_SQL}, {TITLES_SQL}, flags AS (SELECT doc_id, 'near_duplicate' AS flag FROM partnered WHERE partner UNION ALL SELECT doc_id, 'boilerplate' FROM ratios WHERE ratio > 0.05 UNION ALL SELECT doc_id, 'language_mismatch' FROM mismatch UNION ALL SELECT doc_id, flag FROM titles WHERE flag IS NOT NULL UNION ALL SELECT doc_id, 'http_error' FROM documents WHERE doc_id % 97 = 0)"
WORDY = r"""list_filter({0}, lambda w: NOT regexp_full_match(w, '[\d.,;:%$€°#/()\[\]\-–]+'))"""
WORDY_SQL = "WITH w AS (SELECT doc_id, " + WORDY.format(SPLIT.format("text")) + " AS w FROM documents), g AS (SELECT doc_id, len(w) AS n, len(list_filter(w, lambda x: regexp_full_match(trim(x, '.,;:()[]\"''¡!¿?%'), '[{1}]{{3,}}'))) AS good FROM w) SELECT doc_id, {0} FROM g"



def _planted(spark, sf):
    """Documents with two lines put before half of the texts of each source, and short texts for every tenth, so that the rules' own shares are reached."""
    docs = documents(spark, sf)
    put = F.when(F.col("doc_id") % 4 < 2, F.concat(F.lit("This line stands on every second page\nAnd this one is the menu of the site\n"))).otherwise("")
    body = F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("Own line number of the document "), F.col("doc_id"))).otherwise(F.col("text"))
    return docs.withColumn("text", F.concat(put, body))


PLANTED_SQL = "planted AS (SELECT doc_id, source, CASE WHEN doc_id % 4 < 2 THEN 'This line stands on every second page' || chr(10) || 'And this one is the menu of the site' || chr(10) ELSE '' END || CASE WHEN doc_id % 10 = 0 THEN 'Own line number of the document ' || doc_id ELSE text END AS text FROM documents), " + LINES_SQL.replace("FROM documents", "FROM planted").replace(">= 0.1", ">= 0.4")

QUERIES = {
    "boilerplate_lines_planted": (lambda spark, sf: audit.boilerplate_lines(_planted(spark, sf)), f"WITH {PLANTED_SQL} SELECT domain, line, n_docs, share FROM common"),
    "boilerplate_ratio_planted": (lambda spark, sf: audit.boilerplate_ratio(_planted(spark, sf), audit.boilerplate_lines(_planted(spark, sf))).select("doc_id", F.round("ratio", 6).alias("ratio")), f"WITH {PLANTED_SQL} SELECT doc_id, round(ratio, 6) AS ratio FROM ratios WHERE ratio > 0.3"),
    "content_dedup": (lambda spark, sf: dedup.content_groups(table(spark, sf, "documents")), f"SELECT substr(sha256(t), 1, 32) AS content_hash, min(doc_id) AS kept_doc_id, count(*) AS n_docs FROM (SELECT doc_id, {FLAT.format('text')} AS t FROM documents) WHERE length(t) >= 200 GROUP BY 1"),
    "dedup_aliases": (lambda spark, sf: dedup.aliases(table(spark, sf, "documents")), f"SELECT doc_id, kept AS kept_doc_id FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS kept FROM (SELECT doc_id, {FLAT.format('text')} AS t FROM documents) WHERE length(t) >= 200) WHERE doc_id <> kept"),
    "word_counts": (_docs(lambda: T.count_words("text").alias("words"), lambda: T.token_estimate("text").cast("long").alias("tokens")), f"SELECT doc_id, len({SPLIT.format('text')})::INT AS words, length(text) // 4 AS tokens FROM documents"),
    "token_estimate_by_source": (lambda spark, sf: table(spark, sf, "documents").groupBy("source").agg(F.sum(T.token_estimate("text")).cast("long").alias("tokens"), F.count("*").alias("docs")), "SELECT source, sum(length(text) // 4)::BIGINT AS tokens, count(*) AS docs FROM documents GROUP BY 1"),
    "body_without_front_matter": (
        lambda spark, sf: table(spark, sf, "documents").select("doc_id", F.length(T.body_of(F.concat(F.when(F.col("doc_id") % 2 == 0, "---\na: 1\n---\n").otherwise(""), "text"))).alias("chars")),
        "SELECT doc_id, (length(text) + CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END)::INT AS chars FROM documents",
    ),
    "shingle_counts": (_docs(lambda: F.size(T.shingles("text")).alias("shingles")), "WITH t AS (SELECT doc_id, " + TOKENS.format("text") + " AS t FROM documents) SELECT doc_id, CASE WHEN len(t) < 5 THEN 0 ELSE len(list_distinct(list_transform(range(1, len(t) - 3), lambda i: array_to_string(t[i:i + 4], ' ')))) END::INT AS shingles FROM t"),
    "near_duplicate_pairs": (near_duplicate_pairs, f"WITH {PAIRS_SQL} SELECT a, b, round(jaccard, 2) AS jaccard FROM pairs"),
    "near_duplicate_members": (near_duplicate_members, f"WITH {PAIRS_SQL} SELECT doc_id, class_id, class_size, partner FROM partnered"),
    "detect_language": (_docs(lambda: T.detect_language("text").alias("detected")), f"WITH {LANG_SQL} SELECT doc_id, detected FROM told"),
    "language_mismatch": (lambda spark, sf: audit.language_mismatch(documents(spark, sf)), f"WITH {MISMATCH_SQL} SELECT doc_id, detected, majority FROM mismatch"),
    "boilerplate_lines": (lambda spark, sf: _common(spark, sf), f"WITH {LINES_SQL} SELECT domain, line, n_docs, share FROM common"),
    "boilerplate_ratio": (lambda spark, sf: audit.boilerplate_ratio(documents(spark, sf), _common(spark, sf), 0.05), f"WITH {LINES_SQL} SELECT doc_id, ratio FROM ratios WHERE ratio > 0.05"),
    "strip_boilerplate": (
        strip_boilerplate,
        f"WITH {LINES_SQL}, lists AS (SELECT domain, list(line) AS common FROM common GROUP BY domain), cut AS (SELECT doc_id, string_split(trim(text), chr(10)) AS ls, common FROM documents JOIN lists ON lists.domain = source || '.example'), "
        "kept AS (SELECT doc_id, len(ls) AS n, list_filter(ls, lambda x: NOT list_contains(common, trim(x))) AS k FROM cut), clean AS (SELECT doc_id, n - len(k) AS removed_lines, trim(regexp_replace(array_to_string(k, chr(10)), '\\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10)) AS t FROM kept) "
        f"SELECT doc_id, removed_lines::INT AS removed_lines, length(t)::INT AS chars FROM clean WHERE removed_lines > 0 AND len({SPLIT.format('t')}) >= 30",
    ),
    "title_flags": (lambda spark, sf: audit.title_flags(documents(spark, sf)), f"WITH {TITLES_SQL} SELECT doc_id, flag, n_titles FROM titles WHERE flag IS NOT NULL"),
    "title_frequency": (lambda spark, sf: documents(spark, sf).groupBy(F.btrim("title").alias("title")).agg(F.count("*").alias("n")).where("n > 1"), "SELECT trim(split_part(text, chr(10), 1)) AS title, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1"),
    "link_ratio": (
        lambda spark, sf: table(spark, sf, "documents").select("doc_id", F.round(T.link_ratio(F.concat(F.lit("[home](http://a.b/"), "source", F.lit(") "), "text")), 6).alias("ratio")),
        "SELECT doc_id, round((length('[home](http://a.b/' || source || ')')) / length('[home](http://a.b/' || source || ') ' || text), 6) AS ratio FROM documents",
    ),
    "audit_flags": (lambda spark, sf: audit.suspects(audit_flags(spark, sf)), f"WITH {FLAGS_SQL} SELECT doc_id, count(*) AS n_flags, list_sort(list_distinct(list(flag))) AS flags FROM flags GROUP BY doc_id"),
    "audit_summary": (
        lambda spark, sf: audit.summary(documents(spark, sf), audit_flags(spark, sf)),
        f"WITH {FLAGS_SQL}, t AS (SELECT count(*) AS n FROM documents), f AS (SELECT count(DISTINCT doc_id) AS n FROM flags) SELECT 'documents' AS name, n FROM t UNION ALL SELECT 'flagged', n FROM f UNION ALL SELECT 'clean', t.n - f.n FROM t, f UNION ALL SELECT flag, count(*) FROM flags GROUP BY flag",
    ),
    "wordy_ratio": (_docs(lambda: F.round(T.wordy_ratio("text"), 6).alias("ratio")), WORDY_SQL.format("CASE WHEN n < 10 THEN 0.0 ELSE round(good / n, 6) END AS ratio", "A-Za-zÁÉÍÓÚÑáéíóúñüÜ")),
    "page_wordy_ratio": (_docs(lambda: F.round(T.page_wordy_ratio("text"), 6).alias("ratio")), WORDY_SQL.format("CASE WHEN n >= 30 THEN round(good / n, 6) END AS ratio", "A-Za-zÁÉÍÓÚÑáéíóúñüÜçÇàèìòùâêîôûäëïöü")),
    "token_f1_pairs": (
        token_f1_pairs,
        "WITH t AS (SELECT doc_id, unnest(" + TOKENS.format("text") + ") AS w FROM documents), c AS (SELECT doc_id, w, count(*) AS n FROM t GROUP BY ALL), s AS (SELECT doc_id, sum(n) AS n FROM c GROUP BY 1), p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 20), i AS (SELECT p.a, p.b, sum(least(x.n, y.n)) AS i FROM p JOIN c x ON x.doc_id = p.a JOIN c y ON y.doc_id = p.b AND x.w = y.w GROUP BY ALL) "
        "SELECT p.a, p.b, round(coalesce(2 * coalesce(i.i, 0) / (coalesce(x.n, 0) + coalesce(y.n, 0)), 0), 6) AS f1 FROM p LEFT JOIN i ON i.a = p.a AND i.b = p.b LEFT JOIN s x ON x.doc_id = p.a LEFT JOIN s y ON y.doc_id = p.b WHERE x.n IS NOT NULL OR y.n IS NOT NULL",
    ),
    "rights_phrases": (
        lambda spark, sf: table(spark, sf, "documents").select("doc_id", F.explode(rights.phrases("text")).alias("phrase")),
        "SELECT doc_id, phrase FROM documents, (SELECT unnest([" + ", ".join(f"'{p}'" for p in vocab.RIGHTS_PHRASES) + f"]) AS phrase) WHERE contains(lower({FLAT.format('text')}), phrase)",
    ),
    "rights_verdict": (lambda spark, sf: _verdicts(spark, sf).select("domain", "verdict", rights.partition_of(F.col("verdict")).alias("partition")), f"WITH {VERDICTS_SQL} SELECT domain, verdict, {PARTITION_SQL} AS partition FROM verdicts"),
    "rights_summary": (
        lambda spark, sf: rights.verdict_summary(_verdicts(spark, sf), documents(spark, sf).groupBy("domain").agg(F.count("*").alias("docs"))),
        f"WITH {DOCUMENTS_SQL}, {VERDICTS_SQL}, n AS (SELECT domain, count(*) AS docs FROM docs GROUP BY 1) SELECT verdict, count(*) AS domains, coalesce(sum(docs), 0)::BIGINT AS docs FROM verdicts LEFT JOIN n USING (domain) GROUP BY 1",
    ),
    "export_partition": (lambda spark, sf: _export(spark, sf).select("doc_id", "partition", "words", "skipped"), f"WITH {EXPORT_SQL} SELECT doc_id, partition, words, skipped FROM export"),
    "export_manifest": (lambda spark, sf: rights.manifest(_export(spark, sf)), f"WITH {EXPORT_SQL} SELECT coalesce(skipped, partition) AS name, CASE WHEN skipped IS NULL THEN 'partition' ELSE 'skipped' END AS kind, count(*) AS documents, sum(words)::BIGINT AS words FROM export GROUP BY 1, 2"),
    "corpus_report": (
        corpus_report,
        f"WITH {DOCUMENTS_SQL}, w AS (SELECT domain, lang, CASE WHEN length(text) > 1000 THEN 'long' ELSE 'short' END AS size, len({SPLIT.format('text')}) AS words FROM docs) "
        "SELECT 'total' AS dimension, '' AS value, count(*) AS docs, sum(words)::BIGINT AS words FROM w UNION ALL SELECT 'domain', domain, count(*), sum(words)::BIGINT FROM w GROUP BY domain UNION ALL SELECT 'lang', split_part(lang, '-', 1), count(*), sum(words)::BIGINT FROM w GROUP BY 2 UNION ALL SELECT 'size', size, count(*), sum(words)::BIGINT FROM w GROUP BY size",
    ),
    "largest_documents": (
        lambda spark, sf: report.largest(table(spark, sf, "documents").select("doc_id", T.count_words("text").alias("words")), 20),
        f"SELECT doc_id, len({SPLIT.format('text')})::INT AS words FROM documents ORDER BY words DESC, doc_id LIMIT 20",
    ),
    "ocr_triage": (
        ocr_triage,
        "WITH p AS (SELECT source AS doc_id, doc_id AS page, CASE WHEN regexp_extract(source, '(\\d+)$', 1)::INT % 2 = 0 AND doc_id % 3 <> 0 THEN '' ELSE text END AS text, doc_id % 4 / 3 AS image_ratio, count(*) OVER (PARTITION BY source) AS n, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS k FROM documents), "
        "s AS (SELECT * FROM p WHERE n <= 8 OR list_contains(list_transform(range(0, 8), lambda i: round_even(i * (n - 1) / 7, 0)::INT), k)), "
        "w AS (SELECT *, " + WORDY.format(SPLIT.format("text")) + " AS toks FROM s), r AS (SELECT *, CASE WHEN len(toks) >= 30 THEN len(list_filter(toks, lambda x: regexp_full_match(trim(x, '.,;:()[]\"''¡!¿?%'), '[A-Za-zÁÉÍÓÚÑáéíóúñüÜçÇàèìòùâêîôûäëïöü]{3,}'))) / len(toks) END AS wordy FROM w), "
        "a AS (SELECT doc_id, any_value(n) AS pages, avg(length(trim(text, ' ' || chr(10) || chr(9) || chr(13)))) AS c, avg(image_ratio) AS i, count(*) FILTER (length(trim(text, ' ' || chr(10) || chr(9) || chr(13))) < 20) AS without_text, count(*) AS m, coalesce(count(*) FILTER (wordy < 0.45) / nullif(count(wordy), 0), 0) AS bad FROM r GROUP BY doc_id) "
        "SELECT doc_id, pages, round(c, 6) AS avg_chars, round(i, 6) AS avg_image_ratio, without_text, (c < 120 AND i > 0.5) OR without_text / m > 0.5 OR (i > 0.85 AND c < 360) OR bad > 0.5 AS needs_ocr, CASE WHEN i > 0.5 OR bad > 0.5 OR c < 50 THEN 'paddle_vl' ELSE 'rapidocr' END AS engine FROM a",
    ),
}
