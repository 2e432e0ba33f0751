"""URL and text functions on small cases."""

import hashlib

import pytest
from pyspark.sql import functions as F

from lexloom.functions import text as T
from lexloom.functions import url as U


def values(spark, rows, make, schema="x string"):
    df = spark.createDataFrame([(k, *(r if isinstance(r, tuple) else (r,))) for k, r in enumerate(rows)], f"k int, {schema}")
    return [r[0] for r in df.orderBy("k").select(make().alias("v")).collect()]


def test_hosts_and_sites(spark):
    assert values(spark, ["https://WWW.A.org:8080/x", "a.org/x", None, ""], lambda: U.bare_host("x")) == ["a.org:8080", "", None, ""]
    pairs = [("https://a.b.org/", "https://www.b.org"), ("https://notb.org/", "https://b.org"), ("https://c.org", "https://b.org"), ("https://b.org", "https://b.org")]
    assert values(spark, pairs, lambda: U.same_site("x", "y"), "x string, y string") == [True, False, False, True]
    assert values(spark, pairs, lambda: U.same_site("x", "y", whole_labels=False), "x string, y string") == [True, True, False, True]
    assert values(spark, pairs, lambda: U.same_site("x", "y", False, ["c.org"]), "x string, y string") == [False, False, True, True]
    assert values(spark, ["http://a.org/"], lambda: U.doc_id("x")) == [hashlib.sha256(b"http://a.org/").hexdigest()[:16]]


def test_normalisation(spark):
    cases = {
        "HTTPS://WWW.A.org//b//c/?utm_source=x&z=1&a=2#f": "https://a.org/b/c?a=2&z=1",
        "http://a.org": "http://a.org/", "http://a.org/index.html": "http://a.org/", "http://a.org/x/index.php": "http://a.org/x", "http://a.org/?q": "http://a.org/?q=",
    }
    assert values(spark, list(cases), lambda: U.normalize("x")) == list(cases.values())
    assert values(spark, list(cases), lambda: U.normalize_encoded("x")) == list(cases.values())
    assert values(spark, list(cases.values()), lambda: U.normalize("x")) == list(cases.values())  # idempotent
    assert values(spark, ["http://a.org/?x=a b&y=%C3%A9"], lambda: U.normalize_encoded("x")) == ["http://a.org/?x=a+b&y=%C3%A9"]


def test_traps_exclusions_kinds(spark):
    assert values(spark, ["http://a/?p=x?p=y", "http://a/?a=1%3Fa", "http://a/?a=1&a=2", "http://a/?a=1&b=2", "http://a/"], lambda: U.is_query_trap("x")) == [True, True, True, False, False]
    assert values(spark, ["http://a/cart", "http://a/cart/x", "http://a/cart?y", "http://a/cartelera", "http://a/x.JPG", "http://a/b?share=1"], lambda: U.is_excluded("x", ["/cart", ".jpg", "?share="])) == [True, True, True, False, True, True]
    assert values(spark, ["http://a/x"], lambda: U.is_excluded("x", [])) == [False]
    assert values(spark, ["http://a/b.PDF?x=1", "http://a/bitstreams/1/download", "http://a/b.html"], lambda: U.looks_like_document("x")) == [True, True, False]
    assert values(spark, ["http://a/tag/x", "http://a/?s=q", "http://a/a.css", "http://a/article/7"], lambda: U.is_utility("x")) == [True, True, True, False]
    assert values(spark, ["http://arxiv.org/1", "http://x.gob.cl/", "http://x.cl/noticias/1", "http://blog.x.org", "http://x.org"], lambda: U.category("x")) == ["scientific", "government", "news", "blog", "generic"]


def test_pages_and_links(spark):
    cases = {
        "http://a/l?page=3": ["http://a/l?page=4"], "http://a/l?start=20": ["http://a/l?start=40"], "http://a/l?start=0": [], "http://a/page/2/": ["http://a/page/3/"],
        "http://a/l": ["http://a/l/page/2/", "http://a/l?page=2", "http://a/l?p=2"], "http://a/l?p=1545": ["http://a/l?p=1546"], "http://a/l?offset=40&cat=3": ["http://a/l?offset=80&cat=3"],
        "http://a/l?Paged=2": ["http://a/l?Paged=3"], "http://a/l?page=x": ["http://a/l?page=x"], "http://a/b/PAGINA/9?q=a%20b": ["http://a/b/PAGINA/10?q=a%20b"], "http://a/l/?c=1": ["http://a/l/page/2/?c=1", "http://a/l/?c=1&page=2", "http://a/l/?c=1&p=2"],
    }
    assert values(spark, list(cases), lambda: U.next_pages("x")) == list(cases.values())
    assert values(spark, ["http://a/l", "http://a/l?start=0"], lambda: U.next_page("x")) == ["http://a/l?page=2", None]
    pairs = [("http://a/b/", "../c#d"), ("http://a/b", "mailto:x"), ("http://a", "/"), ("http://a", "ftp://x"), ("http://a", None)]
    assert values(spark, pairs, lambda: U.absolute("x", "y"), "x string, y string") == ["http://a/c", None, "http://a", None, None]
    assert values(spark, ["http://a/GUIA_EDUCATIVA_2020.pdf", "http://a/file_2.pdf", "http://a/Informe%20anual%20(1).docx"], lambda: U.title_from_file_name("x")) == ["Guia Educativa 2020", None, "Informe anual"]
    assert values(spark, ["http://a/a%zz_informe.pdf", "http://a/el+plan+--+final+(2).PDF", "http://a/", None, "http://a/abc.pdf"], lambda: U.title_from_file_name("x")) == ["a%zz informe", "el plan final", None, None, None]


def test_words(spark):
    assert values(spark, ["uno dos tres", "日本語のテスト", "abc 日本 def", "a b", ""], lambda: T.count_words("x")) == [3, 7, 4, 2, 0]
    assert values(spark, ["---\nt: x\n---\nbody", "plain", "---no end"], lambda: T.body_of("x")) == ["\nbody", "plain", "---no end"]
    assert values(spark, ["x", "word " * 60, "word  " * 60], lambda: T.content_hash("x"))[0] is None
    same = values(spark, ["word " * 60, "---\nm\n---\nword\n " * 1 + "word " * 59], lambda: T.content_hash("x"))
    assert same[0] == same[1] and len(same[0]) == 32
    assert values(spark, ["a b c d e f a b c d e", "a b"], lambda: T.shingles("x")) == [["a b c d e", "b c d e f", "c d e f a", "d e f a b", "e f a b c", "f a b c d"], []]
    assert values(spark, ["el la los de que y en", "the of and to in a is", "xx yy"], lambda: T.detect_language("x")) == ["es", "en", "?"]
    assert values(spark, ["<p>one two<script>a b c</script> three</p>"], lambda: T.visible_words("x")) == [3]
    assert values(spark, ['say {"a": 1} now', "no"], lambda: T.json_of("x")) == ['{"a": 1}', None]


@pytest.mark.parametrize(("text", "want"), [("uno dos. " * 20 + "11 22", 1.0), ("x9 " * 40, 0.0), ("a b", None)])
def test_page_wordy_ratio(spark, text, want):
    assert values(spark, [text], lambda: T.page_wordy_ratio("x")) == [want]


def test_phrase_evidence(spark):
    got = values(spark, ["Aviso:  Todos los derechos reservados 2024"], lambda: T.phrase_evidence("x", ["todos los derechos reservados", "cc by"]))[0]
    assert [(r["phrase"], r["evidence"]) for r in got] == [("todos los derechos reservados", "Aviso: Todos los derechos reservados 2024")]


def test_lines_are_stripped_once(spark):
    body = "Common line of the site here\n" + "word " * 40 + "\nCommon line of the site here"
    make = lambda: F.struct(*T.strip_lines("x", F.array(F.lit("Common line of the site here"))))
    (clean, gone), (short, none) = values(spark, [body, "Common line of the site here\nfew"], make)
    assert gone == 2 and none == 0 and short.startswith("Common") and values(spark, [clean], make)[0][1] == 0


def test_matching_blocks_equal_difflib():
    import random
    from difflib import SequenceMatcher

    rnd = random.Random(7)
    for turn in range(400):
        letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJ"[: (1, 2, 4, 12, 36)[turn % 5]]
        weights = [rnd.random() ** 4 + 0.003 for _ in letters]
        a, b = ("".join(rnd.choices(letters, weights, k=rnd.choice([0, 1, 20, 199, 200, 450]))) for _ in "ab")
        if turn % 2:
            b = a[len(a) // 3 :] + "x" + a[: len(a) // 2]
        assert T.matched_characters(a, b) == sum(m.size for m in SequenceMatcher(None, a, b).get_matching_blocks())
    # What is repeated less than a hundredth is looked up: no rescan of all characters for each block.
    text = "".join(rnd.choices("etaoin shrdlu", k=4000))
    a, b = ("".join(c if k % 40 else rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ") for k, c in enumerate(text)) for _ in "ab")
    reads = 0

    class Counted(str):
        def __getitem__(self, at):
            nonlocal reads
            reads += 1
            return str.__getitem__(self, at)

    T.matched_characters(Counted(a), b)
    assert reads < 4 * len(a)
