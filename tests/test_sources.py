"""Sources, sinks and streams on files made here."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from lexloom.operators import rights
from lexloom.sources import datasource, documents, fetch, ledger, logs, seeds
from lexloom.streaming import panel


def test_ledger(spark, tmp_path):
    (tmp_path / "v.jsonl").write_text('{"ts": 1.5, "url": "http://a/", "decision": "saved"}\n{"ts": 2, "url": "http://b/", "deci')
    assert [r["url"] for r in ledger.read(spark, f"{tmp_path}/v.jsonl").collect()] == ["http://a/"]
    assert ledger.read(spark, f"{tmp_path}/none.jsonl").count() == 0
    rows = spark.createDataFrame([(1.23456, "s", "http://a/", "saved", None, None, None)], ledger.SCHEMA)
    ledger.append(rows, f"{tmp_path}/out")
    assert ledger.read(spark, f"{tmp_path}/out").first()["ts"] == 1.235
    with pytest.raises(Exception, match="unknown decision"):
        ledger.append(rows.withColumn("decision", F.lit("nonsense")), f"{tmp_path}/bad")


def test_seeds(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿Titulo,URL\nOne long title,http://a/\nTwo,http://b/\nAgain,http://a/\n,x\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("http://a/,x\nhttp://b/,y\n")
    (tmp_path / "c.txt").write_text("# note\nhttp://a/\n\nhttp://a/\nhttp://b/\n")
    got = seeds.read(spark, f"{tmp_path}/a.csv")
    assert [(r["url"], r["context"]) for r in got.orderBy("pos").collect()] == [("http://a/", {"Titulo": "One long title"}), ("http://b/", {"Titulo": "Two"})]
    assert [r["context"] for r in seeds.read(spark, f"{tmp_path}/b.csv").orderBy("pos").collect()] == [{"col1": "x"}, {"col1": "y"}]
    assert seeds.read(spark, f"{tmp_path}/c.txt").count() == 2
    docs = spark.createDataFrame([("http://a/", None), ("http://b/", None), ("http://a/", "own")], "seed string, title string")
    assert sorted(r["title"] or "" for r in seeds.with_context_title(docs, got).collect()) == ["", "One long title", "own"]


def test_sheets(spark):
    sheet = spark.createDataFrame([(1, "Museum", "see https://m.org/ and www.n.org/x."), (2, None, "HTTPS://M.org"), (3, "Library", "no link"), (4, "", "l.org")], "row int, institution string, text string")
    got = [(r["institution"], r["url"], r["is_home"]) for r in seeds.from_free_form(sheet).orderBy("row", "url").collect()]
    assert ("Museum", "https://m.org/", True) in got and ("Museum", "https://www.n.org/x", False) in got and ("Library", "https://l.org", True) in got
    links = spark.createDataFrame([(1, "A", "a.org", None, None), (2, "B", "https://b.org/x", None, None), (3, "C", "https://c.org", None, "Se prohíben copias"), (None, "D", "d.org", None, None), (4, "A", "https://a.org/", None, None)], "n int, institution string, url string, permission string, comment string")
    assert sorted((r["url"], r["class"]) for r in seeds.from_ordered(links).collect()) == [("https://a.org", "home"), ("https://b.org/x", "deep"), ("https://c.org", "restricted")]


def test_logs(spark):
    lines = ["2024 URL: http://a.org/x 200 OK", "URL:http://a.org/y [12/12] -> \"y\" [1]", "URL:http://a.org/z [12] -> \"z\"", "URL: http://a.org/n 404 Not Found", "noise", "URL: http://b.org/ 200 OK", "2024 URL: http://a.org/x 200 OK"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert sorted(r["url"] for r in logs.spider_urls(df, "a.org").collect()) == ["http://a.org/x", "http://a.org/y", "http://a.org/z"]
    run = ["23:59:50 PageMap x: kind=listing items=3", "23:59:59 Guardado x", "00:00:10 render falló", "Sección 'News': 4 documentos"]
    log = spark.createDataFrame(list(enumerate(run)), "pos int, value string")
    assert {r["event"]: r["n"] for r in logs.run_events(log).collect()} == {"pages_analysed": 1, "saved": 1, "failures": 1}
    assert logs.run_seconds(log).first()[0] == 20 and logs.run_kinds(log).first()[:] == ("listing", 1) and logs.run_sections(log).first()[:] == ("News", 4)


def test_fetching(spark):
    calls = []

    def flaky(url):
        calls.append(url)
        if len(calls) < 3:
            raise OSError
        return fetch.Answer(url, 200, "text/html", "<p>x</p>")

    waits = []
    assert fetch.Retrying(flaky, 3, waits.append).fetch("u").status == 200 and waits == [2.0, 4.0]
    calls.clear()
    assert fetch.Retrying(flaky, 2, waits.append).fetch("u").blocked == "network"
    static, full = fetch.TableFetcher({"u": "<div id='root'></div>"}), fetch.TableFetcher({"u": "<p>rendered</p>"})
    assert fetch.Adaptive(static, full).fetch("u").html == "<p>rendered</p>" and fetch.Adaptive(static, fetch.TableFetcher({})).fetch("u").html == "<div id='root'></div>"
    got = fetch.fetched(spark.createDataFrame([("u",), ("v",)], "url string"), lambda: fetch.TableFetcher({"u": "x"})).collect()
    assert {r["url"]: r["status"] for r in got} == {"u": 200, "v": 404}
    clock = iter([0.0, 0.5, 10.0])
    throttle = fetch.Throttle(quota=3, delay=2.0, clock=lambda: next(clock))
    assert [throttle.wait("http://a/") for _ in range(3)] == [0.0, 1.5, 0.0] and not throttle.admits("http://a/") and throttle.admits("http://b/")
    maps = {"http://a/s.xml": "<sitemapindex><sitemap><loc>http://a/t.xml</loc></sitemap></sitemapindex>", "http://a/t.xml": "<urlset><url><loc>http://a/1</loc></url><url><loc>http://a/2</loc></url></urlset>"}
    files = spark.createDataFrame(list(maps.items()), "url string, text string")
    sites = spark.createDataFrame([("http://a", "Sitemap: http://a/s.xml"), ("http://b", None)], "site string, robots string")
    assert sorted(r["url"] for r in fetch.sitemap_pages(sites, files).collect()) == ["http://a/1", "http://a/2"]
    hinted = spark.createDataFrame([("a", "http://a/x", 1), ("a", "http://a/noticia/y", 2), ("a", "http://a/z", 3)], "site string, url string, pos int")
    assert [r["url"] for r in fetch.content_first(hinted, ["/noticia/"], 2).orderBy("pos").collect()] == ["http://a/x", "http://a/noticia/y"]
    robots = spark.createDataFrame([("a", "User-agent: *\nDisallow: /x")], "host string, robots string")
    allowed = rights.allowed(spark.createDataFrame([("http://a/x",), ("http://a/y",), ("http://b/x",)], "url string"), robots, "bot")
    assert {r["url"]: r["allowed"] for r in allowed.collect()} == {"http://a/x": False, "http://a/y": True, "http://b/x": True}


def word_file(text):
    out = io.BytesIO()
    ns = "xmlns:w='http://schemas.openxmlformats.org/wordprocessingml/2006/main'"
    with zipfile.ZipFile(out, "w") as file:
        file.writestr("word/document.xml", f"<w:document {ns}><w:body><w:p><w:pPr><w:pStyle w:val='Heading1'/></w:pPr><w:r><w:t>Head</w:t></w:r></w:p><w:p><w:r><w:t>{text}</w:t></w:r></w:p></w:body></w:document>")
        file.writestr("docProps/core.xml", "<c xmlns:d='x'><d:title>Named</d:title></c>")
    return out.getvalue()


def test_word_files(spark):
    text, properties, status = documents.word_text(word_file("word " * 30))
    assert text.startswith("# Head\n\nword") and properties == {"title": "Named"} and status == "ok"
    assert documents.word_text(word_file("few"))[2] == "raw_only" and documents.word_text(bytes.fromhex("D0CF11E0A1B11AE1"))[2] == "raw_only" and documents.word_text(b"no")[2] == "not_word"
    files = spark.createDataFrame([("a.docx", bytearray(word_file("word " * 30))), ("b", None)], "path string, content binary")
    assert {r["path"]: r["status"] for r in documents.word_files(files).collect()} == {"a.docx": "ok", "b": "not_word"}


def test_store_and_export(spark, tmp_path):
    docs = spark.createDataFrame([("http://a/", "word " * 60), ("http://b/", "word  " * 60), ("http://c/", "short")], "url string, text string")
    documents.save(docs, f"{tmp_path}/s")
    assert spark.read.parquet(f"{tmp_path}/s/documents").count() == 2 and spark.read.parquet(f"{tmp_path}/s/aliases").count() == 1
    verdicts = spark.createDataFrame([("a", "cc-license")], "domain string, verdict string")
    rights.write_export(rights.export_rows(docs, verdicts), f"{tmp_path}/e")
    assert sorted(r["partition"] for r in spark.read.json(f"{tmp_path}/e/data").collect()) == ["permisivo", "revisar"]


def test_streams(spark, tmp_path):
    def put(name, rows):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text("\n".join(json.dumps(dict(zip(("ts", "seed", "url", "decision"), r, strict=True))) for r in rows))

    put("1.json", [(60.0 * k, "s", f"http://a/{k}", "hub" if k else "saved") for k in range(5)])
    stream = ledger.stream(spark, f"{tmp_path}/in")
    live = panel.to_table(panel.per_minute(stream), f"{tmp_path}/minutes").collect()
    assert sorted(r["n"] for r in live) == [1] * 5
    counters = panel.to_table(panel.domain_counters(stream), f"{tmp_path}/counters").first()
    assert (counters["fetched"], counters["saved"]) == (5, 1)
    states = panel.to_table(panel.saturation(stream, window=4, budget_seconds=1000), f"{tmp_path}/states", "update").collect()
    assert states[-1][:] == ("s", 5, 4, "saturated")
    (tmp_path / "docs").mkdir()
    texts = spark.readStream.schema("url string, text string").json(f"{tmp_path}/docs")
    (tmp_path / "docs" / "1.json").write_text("\n".join(json.dumps({"url": f"http://a/{k}", "text": "word " * 60}) for k in range(3)))
    for turn in range(2):
        documents.save_batches(texts, f"{tmp_path}/store", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
        (tmp_path / "docs" / "2.json").write_text(json.dumps({"url": f"http://b/{turn}", "text": "word  " * 60}))
    assert spark.read.parquet(f"{tmp_path}/store/documents").count() == 1


def test_saved_batches_write_one_file_of_keys_for_each_shard(spark, tmp_path, request):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # tasks stay apart, as those of large batches do
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled"))
    (tmp_path / "in").mkdir()
    texts = spark.readStream.schema("url string, text string").json(f"{tmp_path}/in")
    for turn in range(2):
        rows = [{"url": f"http://{turn}/{k}", "text": f"{(k + 10 * turn) // 2} " + "word " * (60 if k % 5 else 6)} for k in range(30)] + [{"url": f"http://{turn}/1", "text": "other " * 60}]
        for part in range(4):  # as many tasks
            (tmp_path / "in" / f"{turn}-{part}.json").write_text("\n".join(map(json.dumps, rows[part::4])))
        documents.save_batches(texts, f"{tmp_path}/store", f"{tmp_path}/cp", prefix=1).trigger(availableNow=True).start().awaitTermination()
        shards = list((tmp_path / "store" / "keys").glob("shard=*"))
        assert shards and all(len(list(s.glob("*.parquet"))) <= turn + 1 for s in shards)
    out = spark.read.parquet(f"{tmp_path}/store/documents").collect()
    held = [r["content_hash"] for r in out if r["content_hash"]]
    long = {(k + 10 * turn) // 2 for turn in range(2) for k in range(30) if k % 5}
    assert len(held) == len(set(held)) and len(long) - 1 <= len(held) <= len(long) + 1  # of a repeated address one text stays
    assert len({r["doc_id"] for r in out}) == len(out) == len(held) + 12 and all(r["words"] for r in out)


def table_fetcher():
    return fetch.TableFetcher({"http://a/1": "<p>one</p>", "http://b/1": "<p>two</p>"})


def test_pages_as_a_data_source(spark):
    datasource.register(spark)
    urls = json.dumps(["http://a/1", "http://a/2", "http://b/1"])
    dealt = datasource.PagesReader(json.loads(urls), "x:y", 8).partitions()
    assert [p.urls for p in dealt] == [["http://a/1", "http://a/2"], ["http://b/1"]]
    rows = datasource.PagesReader(json.loads(urls), f"{table_fetcher.__module__}:table_fetcher", 8)
    assert [r[:2] for p in dealt for r in rows.read(p)] == [("http://a/1", 200), ("http://a/2", 404), ("http://b/1", 200)]
    assert spark.read.format("lexloom_pages").option("fetcher", "lexloom.sources.fetch:empty_site").option("urls", urls).load().where("status = 404").count() == 3
    with pytest.raises(Exception, match="fetcher"):
        spark.read.format("lexloom_pages").load().count()
