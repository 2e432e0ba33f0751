"""Walking sites, settings, the panel and what a run leaves, on small cases."""

import json
import time

import pytest
from pyspark.sql import functions as F

from lexloom import config
from lexloom.operators import expansion, scans
from lexloom.session import cut_lineage, shared_folder, written
from lexloom.sources import artifacts
from lexloom.streaming import panel


def test_settings(spark, tmp_path):
    text = "seeds: [http://a]\ndiscovery:\n  mode: auto\n  max_depth: 5\n  content_hints: [/news/]\nlabel: x\n"
    s = config.parse(text)
    assert (s.seeds, s.discovery.mode, s.discovery.max_depth, s.discovery.content_hints, s.extraction.min_words, s.extra) == (("http://a",), "auto", 5, ("/news/",), 80, {"label": "x"})
    assert config.parse("", s) == s and config.parse("discovery: {max_depth: 1}", s).discovery.mode == "auto"
    with pytest.raises(ValueError, match="max_dept"):
        config.parse("discovery: {max_dept: 1}")
    with pytest.raises(ValueError, match="mapping"):
        config.parse("- a")
    changed = config.with_overrides(s, {"use_sitemaps": "false", "mode": "sections"})
    assert changed.discovery.use_sitemaps is False and changed.discovery.mode == "auto" and s.discovery.use_sitemaps
    (tmp_path / "c.yaml").write_text(text)
    assert config.load(spark, str(tmp_path / "c.yaml")) == s


PAGES = "seed string, url string, depth int, pos int, page_kind string, listing_items array<string>, pagination_urls array<string>, pagination_js_only boolean"


def test_listings_are_capped_and_probed_only_for_new_items(spark):
    rows = [("s", "http://s/1", 0, 1, "listing", ["a", "b"], [], True), ("s", "http://s/2", 0, 2, "listing", ["a", "b"], [], True), ("s", "http://s/3", 1, 3, "listing", ["c"], ["p"], False), ("s", "http://s/4", 0, 4, "listing", ["d"], ["q"], False)]
    out = expansion.listing_expansion(spark.createDataFrame(rows, PAGES), 3).collect()
    got = sorted((r["via"], r["url"], r["kind"], r["depth"]) for r in out)
    assert ("http://s/1", "http://s/1?page=2", "pagination_probe", 0) in got and not any(v == "http://s/2" and k == "pagination_probe" for v, _, k, _ in got)
    # The third is the last that is expanded: its items count, its pager does not; the fourth is passed over.
    assert [g for g in got if g[0] == "http://s/3"] == [("http://s/3", "c", "listing_item", 2)] and not any(g[0] == "http://s/4" for g in got)
    first = {r["url"]: r["via"] for r in expansion.discovered(expansion.listing_expansion(spark.createDataFrame(rows, PAGES), 3)).collect()}
    assert first["a"] == "http://s/1"


def test_probe_follows_what_is_declared_else_what_may_come(spark):
    site = [("http://a/l", 200, ["1", "2"], []), ("http://a/l?page=2", 200, ["3"], []), ("http://a/l?page=3", 200, ["3"], []), ("http://a/l?page=4", 200, ["9"], []), ("http://b/l", 404, [], [])]
    pages = spark.createDataFrame(site, "url string, status int, items array<string>, pagination_urls array<string>")
    out = expansion.pagination_walk(spark.createDataFrame([("http://a/l",), ("http://b/l",), ("http://none/",)], "url string"), pages)
    assert [(r["n"], r["url"], r["new_items"], r["synthesized"]) for r in out.orderBy("n").collect()] == [(1, "http://a/l", 2, False), (2, "http://a/l?page=2", 1, True), (3, "http://a/l?page=3", 0, True)]


def test_panel_state(spark):
    ledger = spark.createDataFrame([(1, 10.0, "http://a/", "http://a/", "blocked", "captcha"), (2, 20.0, "http://b/", "http://b/x", "saved", None)], "seq int, ts double, seed string, url string, decision string, reason string")
    docs = spark.createDataFrame([("b", 0.0, 10, 400, "pdf"), ("b", 700.0, 5, 3000, "x")], "domain string, ts double, words int, chars int, source_type string")
    rows = panel.domain_rows(ledger, docs, spark.createDataFrame([("a",), ("c",)], "domain string"), spark.createDataFrame([("www.a",)], "domain string"), 100.0)
    got = {r["domain"]: r for r in rows.collect()}
    assert [(got[d]["status"], got[d]["seed_close"], got[d]["tps"]) for d in "abc"] == [("terminado", "blocked: captcha", None), ("activo", "", 1.2), ("pendiente", "", None)]
    assert json.loads(panel.state_json(rows).where("domain = 'b'").first()["value"])["pdf"] == 1
    rates = panel.projected(panel.rates(spark.createDataFrame([(1200, 0.0, 600.0), (5, 0.0, 10.0)], "tokens int, first_ts double, last_ts double")))
    assert [(r["tokens_per_second"], r["projected_tokens"]) for r in rates.collect()] == [(2.0, 172800), (None, None)]


def test_clock_ends_a_seed(spark, tmp_path):
    """The budget is of the engine's clock: the second row comes after it and finds the seed out of time."""
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema("seed string, ts double, decision string, kind string").json(f"{tmp_path}/in")
    found = []
    states = panel.saturation(stream, window=3, budget_seconds=0.5, by_clock=True)
    query = states.writeStream.foreachBatch(lambda batch, _: found.extend(r["state"] for r in batch.collect())).outputMode("update").option("checkpointLocation", f"{tmp_path}/progress").trigger(processingTime="1 second").start()
    try:
        for k in (1, 2):
            (tmp_path / "in" / f"{k}.json").write_text(json.dumps({"seed": "s", "ts": 1.0, "decision": "hub"}))
            until = time.time() + 60
            while len(found) < k and time.time() < until:
                time.sleep(0.2)
            time.sleep(0.6)
    finally:
        query.stop()
    assert found[0] == "open" and "out_of_time" in found[1:]


def test_saturation_by_time_whatever_the_order_of_arrival(spark, tmp_path):
    (tmp_path / "in").mkdir()
    visits = [{"seed": "s", "ts": float(k), "decision": "saved" if k in (3, 47) else "hub", "kind": None} for k in range(60)]
    (tmp_path / "in" / "1.json").write_text("\n".join(json.dumps(v) for v in reversed(visits)))
    stream = spark.readStream.schema("seed string, ts double, decision string, kind string").json(f"{tmp_path}/in")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # many pieces, the latest first
    try:
        out = panel.to_table(panel.saturation(stream, window=12), f"{tmp_path}/states", "update")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert [tuple(r) for r in out.collect()] == [("s", 60, 12, "saturated")]


def test_new_contents_survive_a_restart(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema("content_hash string").json(f"{tmp_path}/in")
    for k in (1, 2):
        (tmp_path / "in" / f"{k}.json").write_text("\n".join(json.dumps({"content_hash": h}) for h in ("a", "b", str(k))))
        out = panel.to_table(panel.new_contents(stream), f"{tmp_path}/new", "append")
    assert sorted(r[0] for r in out.collect()) == ["1", "2", "a", "b"]


def test_artifacts(spark, tmp_path):
    maps = spark.createDataFrame([("http://a/", "listing", ["x"], True), ("http://b/", "article", [], False)], "url string, page_kind string, listing_items array<string>, pagination_js_only boolean")
    docs = spark.createDataFrame([("a", "en", 3), ("a", "es", 4)], "domain string, lang string, words int")
    report = artifacts.corpus_report(docs, maps, ["domain", "lang"], f"{tmp_path}/r")
    assert report["totals"] == {"documents": 2, "words": 7, "pages_analyzed": 2} and report["by_domain"] == {"a": 2}
    assert json.loads(spark.read.text(f"{tmp_path}/r/report").first()[0]) == report and spark.read.json(f"{tmp_path}/r/listings").count() == 1
    with pytest.raises(ValueError, match="kind"):
        artifacts.analyses(maps, "other")
    assert artifacts.done(spark, f"{tmp_path}/none").count() == 0
    assert not scans.ENGINES.get("none")


def test_tables_in_the_shared_folder(spark):
    rows = spark.range(10).withColumn("x", F.col("id") * 2)
    assert written(rows).agg(F.sum("x")).first()[0] == cut_lineage(rows).agg(F.sum("x")).first()[0] == 90 and shared_folder(spark)
