"""URL rules through Bloom cascades against a brute-force version."""

import numpy as np

from lexloom.llm import urlfilter


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit)[:3] if fit else None
    return host, path, best and best[2], ("block" if any(x[3] == "block" for x in fit if x[:3] == best) else "allow")


URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/x?y#z", "http://example.org", "https://example.org/en/12", "https://a.b.example.org/en/1", "http://com/fr/", "http://a.com/FR/", "http://notexample.org/es/", "x://y.com/de/?a://b", "http://é.com/de/ü", "http://a.com?/de/", "http://a.org#/", "http://u@a.com:80/de/"]


def test_rules_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    rules = [*urlfilter.RULES, ("example.org", "", "block"), ("both.net", "/x", "allow"), ("both.net", "/x", "block")]
    rules += [(f"h{k}.net", f"/{k % 7}/", ("allow", "block")[k % 2]) for k in range(400)]
    urls = URLS + [f"http://s{rng.integers(9)}.h{rng.integers(900)}.net/{rng.integers(9)}/page" for _ in range(3000)] + ["http://both.net/xy"]
    df = spark.createDataFrame([(k, u, "x") for k, u in enumerate(urls)] + [(0, None, "x")], "page_id long, url string, _keys string").repartition(4)
    out = urlfilter.url_filter(df, spark.createDataFrame(rules, "host string, path string, verdict string"))
    got = sorted(((r["page_id"], r["_host"], r["_path"], r["_rule"], r["_verdict"]) for r in out.collect()), key=str)
    assert got == sorted([(k, *brute(u, rules)) for k, u in enumerate(urls)] + [(0, "", "", None, "allow")], key=str)
    assert {r["_keys"] for r in out.collect()} == {"x"}
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {(r["_rule"], r["_verdict"]) for r in urlfilter.url_filter(df, none).collect()} == {(None, "allow")}
    assert urlfilter.url_filter(df.limit(0), none).count() == 0


def test_split_rules(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "PART_RULES", 2)
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    out = urlfilter.url_filter(df, spark.createDataFrame(list(urlfilter.RULES), "host string, path string, verdict string"))
    assert {(r["page_id"], r["_rule"], r["_verdict"]) for r in out.collect()} == {(k, *brute(u, urlfilter.RULES)[2:]) for k, u in enumerate(URLS)}


def test_cascade_is_exact_with_tiny_filters():
    keys = urlfilter.hashes([f"k{i}" for i in range(20_000)])
    listed, rest = keys[:500], keys[500:]
    first = urlfilter.Bloom.of(listed, 0, 3.0)
    levels = urlfilter.deepen(first, listed, rest[first.passes(rest)], 3.0)
    assert len(levels) > 3 and urlfilter.holds(levels, listed).all() and not urlfilter.holds(levels, rest).any()
