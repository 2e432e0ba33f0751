"""Operators on small tables with known results."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.functions import text as T
from lexloom.operators import audit, coverage, crawl, dedup, report, rights, scans


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_near_duplicates_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(300)]
    docs = [" ".join(rng.choice(words, 150)) for _ in range(12)]
    for k in range(20):
        w = docs[k % 12].split()
        for at in rng.integers(0, 150, int(rng.integers(0, 6))):
            w[at] = f"x{k}"
        docs.append(" ".join(w))
    docs += [docs[3], docs[3], "short"]
    df = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    sets = {k: {tuple(d.split()[i : i + 5]) for i in range(len(d.split()) - 4)} for k, d in enumerate(docs) if len(d) > 400}
    want = [(a, b, round(len(sets[a] & sets[b]) / len(sets[a] | sets[b]), 6)) for a, b in itertools.combinations(sorted(sets), 2) if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.7]
    pairs, members = dedup.near_duplicates(df)
    got = dedup.expanded(pairs, members).withColumn("jaccard", F.round("jaccard", 6))
    partners = {d for a, b, _ in want for d in (a, b)}
    assert {r[0] for r in dedup.with_partner(pairs, members).collect()} == partners and pairs.where("a >= b").isEmpty()
    assert {r["doc_id"]: r["class_size"] for r in members.collect()}[3] == 3
    assert rows(got, "a", "b", "jaccard") == sorted(want, key=str) and len(want) > 15


def test_content_dedup_keeps_one_and_short_texts(spark):
    long = "word " * 60
    df = spark.createDataFrame([(1, long), (2, "---\nx\n---\n" + long), (3, "short"), (4, "short")], "doc_id long, text string")
    assert rows(dedup.deduplicated(df), "doc_id") == [(1,), (3,), (4,)] and rows(dedup.aliases(df), "doc_id", "kept_doc_id") == [(2, 1)]


LEDGER = [
    ("https://www.s.org/a", "enqueued", None, "sitemap"), ("https://s.org/a", "saved", None, None), ("https://s.org/a/", "http_error", "500", None), ("https://s.org/b", "enqueued", None, "bfs"),
    ("https://s.org/b", "http_error", "404", None), ("https://s.org/c", "rejected", "depth", None), ("https://s.org/d", "hub", None, None), ("https://s.org/d", "saved", None, None), ("https://s.org/e", "enqueued", None, None), ("https://s.org/e", "not_fetched", "budget", None),
]


def test_coverage(spark):
    ledger = spark.createDataFrame([(k, float(k), "https://s.org", u, d, r, None, kind) for k, (u, d, r, kind) in enumerate(LEDGER)], "seq long, ts double, seed string, url string, decision string, reason string, via string, kind string")
    by_url = coverage.collapse(ledger)
    assert rows(by_url, "key", "fetch", "reason") == [("https://s.org/a", "saved", None), ("https://s.org/b", "http_error", "404"), ("https://s.org/c", None, None), ("https://s.org/d", "saved", None), ("https://s.org/e", None, None)]
    assert rows(coverage.funnel(by_url), "outcome", "n_urls") == [("http_error", 1), ("not_fetched", 1), ("rejected:depth", 1), ("saved", 2)]
    known = spark.createDataFrame([("https://s.org/a",)], "url string")
    assert dict(rows(coverage.funnel(coverage.collapse(ledger, index_urls=known)), "outcome", "n_urls"))["duplicate"] == 1
    assert coverage.collapse(ledger, host="other.org").count() == 0
    inventory = spark.createDataFrame([(f"https://s.org/{x}", "map") for x in ("a", "b", "c", "x", "tag/y", "t.csv")], "key string, source string")
    m = coverage.metrics(inventory, by_url).first().asDict()
    assert (m["inventory_content"], m["inventory_utility"], m["inventory_not_extractable"], m["reach_pct"], m["fetch_pct"], m["recall_pct"], m["precision_pct"], m["saved_outside"]) == (4, 1, 1, 75.0, 50.0, 25.0, 50.0, 1)
    assert rows(coverage.missing(inventory, by_url), "key", "stage", "why") == [("https://s.org/b", "descartada", "http_error (404)"), ("https://s.org/c", "rechazada", "depth"), ("https://s.org/x", "no_vista", "el crawl nunca llegó a esta URL")]
    assert coverage.metrics(inventory.limit(0), by_url).first()["reach_pct"] is None


def test_saturation(spark):
    ledger = spark.createDataFrame([(k, float(k), "s", "u", d, None, None, "new_items" if d == "listing" else None) for k, d in enumerate(["saved", "hub", "hub", "listing", "hub", "hub", "enqueued", "hub"])], "seq long, ts double, seed string, url string, decision string, reason string, via string, kind string")
    assert rows(coverage.saturation(ledger, 3), "seq", "barren", "saturated") == [(0, 0, False), (1, 1, False), (2, 2, False), (3, 0, False), (4, 1, False), (5, 2, False), (7, 3, True)]


def test_boilerplate(spark):
    common = "This line stands on every page of it"
    docs = spark.createDataFrame([(k, "d.org", f"{common}\n{'own words here ' * 12}{k}\n{common}") for k in range(6)] + [(9, "e.org", common)], "doc_id long, domain string, text string")
    lines = audit.boilerplate_lines(docs)
    assert rows(lines, "domain", "line", "n_docs") == [("d.org", common, 6)]
    assert rows(audit.boilerplate_ratio(docs, lines), "doc_id", "ratio") == [(k, 2 / 3) for k in range(6)]
    done = audit.strip_boilerplate(docs, lines)
    assert rows(done, "doc_id", "removed_lines") == [*((k, 2) for k in range(6)), (9, 0)]
    assert audit.strip_boilerplate(done.drop("removed_lines"), lines).where("removed_lines > 0").count() == 0


def test_audit_rules(spark):
    docs = spark.createDataFrame([(1, "site.org", "Site", "x", 200), (2, "site.org", "A longer title", "[a](b) " * 60, 404), (3, "site.org", "A longer title", "x", None), (4, "site.org", None, "x", 200)], "doc_id long, domain string, title string, text string, http_status int")
    assert rows(audit.title_flags(docs), "doc_id", "flag") == [(1, "generic_title"), (2, "duplicated_title"), (3, "duplicated_title"), (4, "generic_title")]
    assert rows(audit.linky(docs), "doc_id") == [(2,)] and rows(audit.http_errors(docs), "doc_id") == [(2,)]
    flagged = audit.flags({"linky": audit.linky(docs), "http_error": audit.http_errors(docs)})
    assert rows(audit.summary(docs, flagged), "name", "n") == [("clean", 3), ("documents", 4), ("flagged", 1), ("http_error", 1), ("linky", 1)]
    maps = spark.createDataFrame([(1, "article", 2000), (2, "article", 900), (3, "listing", 9000)], "doc_id long, page_kind string, root_chars int")
    assert rows(audit.low_coverage(docs, maps), "doc_id") == [(1,)]


def test_frontier(spark):
    targets = [("https://h.org/1", 0, False, False, False), ("https://h.org/noticia", 0, False, False, False), ("https://h.org/3", 0, False, False, True), ("https://x.org/d.pdf", 0, True, False, False), ("https://h.org/item", 0, False, True, False), ("https://x.org/", 0, False, False, False), ("https://h.org/deep", 9, False, False, False), ("https://h.org/cart", 0, False, False, False), ("https://h.org/?a=1&a=2", 0, False, False, False), ("https://h.org/1", 9, True, False, False)]
    df = spark.createDataFrame([(*t, k) for k, t in enumerate(targets)], "url string, depth int, hint_pdf boolean, from_listing boolean, from_sitemap boolean, pos int")
    admitted = crawl.admission(df, F.lit("https://www.h.org"), 5, ["/cart"], ["noticia"])
    assert dict(rows(admitted.where("reason IS NOT NULL"), "url", "reason")) == {"https://x.org/": "offsite", "https://h.org/deep": "depth", "https://h.org/cart": "excluded", "https://h.org/?a=1&a=2": "trap"}
    order = [r["url"] for r in crawl.emission(admitted, 3).orderBy("turn").collect()]
    assert order == ["https://x.org/d.pdf", "https://h.org/item", "https://h.org/noticia", "https://h.org/3", "https://h.org/1"]
    assert [r["decision"] for r in crawl.emission(admitted, 3).orderBy("turn").collect()] == ["fetch"] * 3 + ["not_fetched"] * 2
    assert crawl.admission(df, F.lit("https://h.org"), 5, exhaustive=True).where("reason = 'depth'").count() == 0


def test_plan_and_refinement(spark):
    cases = [("listing", 3, 0, 0), ("article", 0, 9, 9), ("navigation", 0, 3, 0), ("navigation", 0, 1, 10), ("listing", 2, 0, 0)]
    df = spark.createDataFrame(cases, "kind string, items int, sections int, sitemap int").select(crawl.plan(*[F.col(c) for c in ("kind", "items", "sections", "sitemap")]).alias("p")).select("p.*")
    assert [r["strategy"] for r in df.collect()] == ["listing", "directed", "sections", "sitemap", "bfs"]
    refined = df.where("low_confidence").select(crawl.refined(F.col("strategy"), F.col("low_confidence"), F.lit("sections")), crawl.refined(F.col("strategy"), F.col("low_confidence"), F.lit("nonsense")))
    assert refined.first()[:] == ("sections", "bfs")


def test_provenance(spark):
    nodes = spark.createDataFrame([("seed", None), ("section", "seed"), ("item", "section"), ("pdf", "item"), ("x", "y"), ("y", "x")], "url string, via string")
    paths = crawl.provenance_paths(nodes)
    got = dict(rows(paths, "url", "path"))
    assert got["pdf"] == ["seed", "section", "item", "pdf"] and got["x"] == ["y", "x"] and got["seed"] == ["seed"]
    docs = spark.createDataFrame([("pdf", 10), ("section", 5)], "url string, words int")
    assert dict((u, (d, w)) for u, d, w in rows(crawl.branch_totals(paths, docs), "url", "branch_docs", "branch_words"))["seed"] == (2, 15)
    assert [r["line"] for r in crawl.rendered_tree(paths.where("path[0] = 'seed'")).collect()][:2] == ["seed", "  section"]
    links = spark.createDataFrame([("http://a/", "http://a/1"), ("http://a/1", "http://a/2"), ("http://a/2", "http://a/"), ("http://a/1", "http://b/"), ("http://a/", "http://a/x.css")], "via string, url string")
    assert rows(crawl.breadth_first(links, spark.createDataFrame([("http://a/",)], "url string"), 3), "url", "depth") == [("http://a/", 0), ("http://a/1", 1), ("http://a/2", 2)]


def test_rights(spark):
    robots = "User-agent: *\nDisallow: /x\nContent-Signal: ai-train=no\n\nUser-agent: GPTBot\nDisallow: /\nUser-agent: CCBot\nDisallow: /y\n"
    signal = spark.createDataFrame([(robots,)], "r string").select(rights.robots_signals("r").alias("s")).first()["s"]
    assert signal["content_signal"] == "ai-train=no" and signal["ai_bots_blocked"] == ["GPTBot"]
    rules, delay = rights.robots_rules("User-agent: *\nDisallow: /p*.html$\nAllow: /p/ok\nCrawl-delay: 3", "bot")
    assert delay == 3.0 and [rights.robots_allows(rules, p) for p in ("/p1.html", "/p1.html?x", "/p/ok", "/p/ok.html")] == [False, True, True, False]
    docs = spark.createDataFrame([(k, f"http://{h}/", t) for k, (h, t) in enumerate([("cc.org", "w " * 60), ("www.cc.org", "w " * 60), ("ai.org", "w " * 60), ("cc.org", "short"), ("cc.org", None)])], "doc_id long, url string, text string")
    verdicts = spark.createDataFrame([("CC.org", "cc-license"), ("ai.org", "tdm-o-ai-reservado (bloquea bots de IA)")], "domain string, verdict string")
    out = rights.export_rows(docs, verdicts)
    assert rows(rights.manifest(out), "name", "documents") == [("permisivo", 1), ("reservado_ia", 1), ("revisar", 1), ("sin_texto", 1), ("texto_corto", 1)]


def test_scans(spark):
    text = "real words that anybody can read here " * 6
    pages = [("ok", k, text, 0.0) for k in range(20)] + [("scan", k, "", 1.0) for k in range(3)] + [("noise", k, "x9 q;; 1a " * 30, 0.1) for k in range(4)]
    got = {r["doc_id"]: r for r in scans.triage(spark.createDataFrame(pages, "doc_id string, page int, text string, image_ratio double")).collect()}
    assert [got[d]["needs_ocr"] for d in ("ok", "scan", "noise")] == [False, True, True] and got["ok"]["sampled"] == 8
    scans.ENGINES["echo"] = lambda body, lang: body.decode() + lang
    queue = spark.createDataFrame([("a", bytearray(b"x"), "echo"), ("b", bytearray(b"y"), "none")], "doc_id string, body binary, engine string")
    assert rows(scans.work_queue(queue), "doc_id", "text", "error") == [("a", "xspa", None), ("b", None, "KeyError: 'none'")]
    signals = spark.createDataFrame([(0.6, 0.0, 500.0), (0.0, 0.0, 500.0), (None, None, None), (0.0, 0.6, 500.0)], "i double, b double, c double")
    assert [r[0] for r in signals.select(scans.engine(F.col("i"), F.col("b"), F.col("c"))).collect()] == ["paddle_vl", "rapidocr", "rapidocr", "paddle_vl"]


def test_near_duplicates_deal_out_little(spark):
    import random

    rnd = random.Random(3)
    texts = [[f"w{rnd.randrange(9000)}" for _ in range(300)] for _ in range(150)]
    for k in range(60):  # near copies of a few changed words, some of them under the threshold, and exact ones
        text = list(texts[k])
        for _ in range(k % 30):
            text[rnd.randrange(300)] = f"x{rnd.randrange(99)}"
        texts.append(text)
    docs = spark.createDataFrame([(k, "a common line on all pages of it " + " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string").repartition(4).localCheckpoint()
    store, size = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)

    def dealt():
        stages = store.stageList(None, False, False, size, None)
        return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()))

    before = dealt()
    pairs, members = dedup.near_duplicates(docs)
    found = {(r["a"], r["b"]): r["jaccard"] for r in pairs.collect()}
    sets = {r["doc_id"]: frozenset(r["s"]) for r in docs.select("doc_id", T.shingle_hashes("text").alias("s")).collect()}
    assert dealt() - before < 30 * sum(map(len, sets.values()))  # bytes a shingle
    first = {}
    for k in sorted(sets):
        first.setdefault(sets[k], k)
    brute = {(a, b): len(s & t) / len(s | t) for s, a in first.items() for t, b in first.items() if a < b and len(s & t) / len(s | t) >= 0.7}
    assert found == pytest.approx(brute) and 5 < len(brute) < 60
    assert sorted(rows(members, "doc_id", "class_id")) == [(k, first[sets[k]]) for k in sorted(sets)]


def test_token_f1_deals_out_no_tokens(spark):
    pairs = spark.createDataFrame([(1, 2, "a a b", "A b b a 1"), (1, 2, "a", "ñ"), (3, 4, None, "x"), (5, 6, "", None), (7, 8, "q q q", "q q")], "a int, b int, a_text string, b_text string")
    out = report.token_f1(pairs).withColumn("f1", F.round("f1", 6))
    assert rows(out, "a", "b", "f1") == [(1, 2, 0.6), (3, 4, 0.0), (7, 8, 0.8)]
    assert out._jdf.queryExecution().sparkPlan().toString().count("Join") == 0  # the tokens of a pair meet in its row


def test_reports(spark):
    pairs = spark.createDataFrame([(1, 2, "a a b", "a b b"), (3, 4, "x", "y")], "a int, b int, a_text string, b_text string")
    assert rows(report.token_f1(pairs).withColumn("f1", F.round("f1", 4)), "a", "f1") == [(1, 0.6667), (3, 0.0)]
    docs = spark.createDataFrame([("a", "en-GB", 3), ("a", None, 4)], "domain string, lang string, words int")
    assert rows(report.corpus_counts(docs, ["domain", "lang"]), "dimension", "value", "docs", "words") == [("domain", "a", 2, 7), ("lang", "?", 1, 4), ("lang", "en", 1, 3), ("total", "", 2, 7)]
    assert T.SPACE
