"""Text functions as columns. Words are runs of letters, digits and underscores of any script."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from lexloom.functions import vocab

#: White space as Python's str.split sees it.
SPACE = r"(?U)\s+"
CJK = "[一-鿿぀-ヿ가-힯]"
TOKEN = r"[\p{L}\p{N}_]+"


def _col(text: Column | str) -> Column:
    return F.col(text) if isinstance(text, str) else text


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once for ``body``: inside a lambda a plain expression would be computed for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def split_words(text: Column | str) -> Column:
    """Return the parts between white space."""
    return F.filter(F.split(_col(text), SPACE), lambda w: w != "")


def collapse(text: Column | str) -> Column:
    return F.array_join(split_words(text), " ")


def tokens(text: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(TOKEN), 0)


def numbered(words: Column) -> Column:
    """Return each of ``words`` with how many equal ones stand before it, if any, so that sets of these intersect as multisets of words do."""

    def made(s: Column) -> Column:
        first = F.filter(F.transform(s, lambda w, i: F.when(F.coalesce(F.get(s, i - 1) != w, F.lit(True)), i)), lambda i: i.isNotNull())
        run = lambda starts: F.transform(starts, lambda at, k: F.transform(F.sequence(at, F.coalesce(F.get(starts, k + 1), F.size(s)) - 1), lambda i: F.when(i == at, F.get(s, i)).otherwise(F.concat(F.get(s, i), F.lit(" "), i - at))))
        return F.flatten(let(first, run))

    return let(F.sort_array(words), made)


def count_words(text: Column | str) -> Column:
    """Count words; each Chinese, Japanese or Korean character is one."""
    return F.regexp_count(_col(text), F.lit(CJK)) + F.size(split_words(F.regexp_replace(_col(text), CJK, " ")))


def token_estimate(text: Column | str) -> Column:
    return F.floor(F.length(_col(text)) / 4)


def body_of(text: Column | str) -> Column:
    """Return ``text`` without front matter between two lines of three dashes."""
    t = _col(text)
    end = F.locate("---", t, 4)
    return F.when(t.startswith("---") & (end > 0), F.substring(t, end + 3, F.length(t))).otherwise(t)


def content_hash(text: Column | str) -> Column:
    """Return 32 hex digits for the collapsed body, or null if it has fewer than 200 characters."""
    flat = collapse(body_of(text))
    return F.when(F.length(flat) >= 200, F.substring(F.sha2(flat, 256), 1, 32))


def shingles(text: Column | str, n: int = 5) -> Column:
    """Return the distinct ``n``-token shingles of ``text`` as strings."""

    def made(words: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(1))), lambda i: F.array_join(F.slice(words, i, n), " "))
        return F.when(F.size(words) >= n, F.array_distinct(parts)).otherwise(F.array().cast("array<string>"))

    return let(tokens(text), made)


def shingle_hashes(text: Column | str, n: int = 5) -> Column:
    """Return the sorted, distinct 64-bit hashes of the ``n``-token shingles of ``text``."""

    def made(words: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - n + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, n)))
        return F.when(F.size(words) >= n, F.sort_array(F.array_distinct(parts))).otherwise(F.array().cast("array<long>"))

    return let(tokens(text), made)


def detect_language(text: Column | str) -> Column:
    """Return es, en or pt by function words among the first 4000 words; ``?`` for up to 5 hits.

    The words are found once and each list's hits are counted once.
    """
    words = F.slice(F.regexp_extract_all(F.lower(_col(text)), F.lit("[a-záéíóúñãõç]+"), 0), 1, 4000)
    names = list(vocab.STOPWORDS)
    count = lambda w, listed: F.size(F.filter(w, lambda x: x.isin(listed)))
    hits = let(words, lambda w: F.array(*[count(w, vocab.STOPWORDS[n]) for n in names]))
    first_best = lambda h: F.when(F.array_max(h) <= 5, "?").otherwise(F.element_at(F.array(*[F.lit(n) for n in names]), F.array_position(h, F.array_max(h)).cast("int")))
    return F.when(_col(text).isNotNull(), let(hits, first_best)).otherwise("?")


def link_ratio(text: Column | str) -> Column:
    """Return the share of characters in Markdown links."""
    links = F.regexp_extract_all(_col(text), F.lit(r"\[[^\]]*\]\([^)]*\)"), 0)
    return F.aggregate(links, F.lit(0), lambda a, x: a + F.length(x)) / F.length(_col(text))


def _wordy(text: Column | str, letters: str) -> tuple[Column, Column]:
    words = F.filter(split_words(text), lambda w: ~w.rlike(vocab.NUMERIC_TOKEN))
    good = F.filter(words, lambda w: F.btrim(w, F.lit(vocab.WORD_EDGES)).rlike(f"^[{letters}]{{3,}}$"))
    return F.size(words), F.size(good)


def page_wordy_ratio(text: Column | str) -> Column:
    """Return the share of words among non-numeric tokens, null for fewer than 30."""
    many, good = _wordy(text, "A-Za-zÁÉÍÓÚÑáéíóúñüÜçÇàèìòùâêîôûäëïöü")
    return F.when(many >= 30, good / many)


def wordy_ratio(text: Column | str) -> Column:
    """Return the same share with fewer accented letters, 0 for fewer than 10 tokens."""
    many, good = _wordy(text, "A-Za-zÁÉÍÓÚÑáéíóúñüÜ")
    return F.when(many < 10, 0.0).otherwise(good / many)


def visible_words(html: Column | str) -> Column:
    """Count what is left of a page's words without scripts, styles and tags."""
    t = _col(html)
    for tag in ("script", "style", "noscript"):
        t = F.regexp_replace(t, rf"(?is)<{tag}\b.*?</{tag}>", " ")
    return F.size(split_words(F.regexp_replace(t, r"<[^>]+>", " ")))


def strip_lines(body: Column | str, common: Column) -> tuple[Column, Column]:
    """Return ``body`` without the lines in ``common`` and how many went; fewer than 30 words left leave it as it is."""
    lines = F.split(_col(body), "\n")
    kept = F.filter(lines, lambda x: ~F.array_contains(common, F.btrim(x)))
    gone = F.size(lines) - F.size(kept)
    clean = F.btrim(F.regexp_replace(F.array_join(kept, "\n"), r"\n{3,}", "\n\n"), F.lit(" \n\t\r"))
    does = (gone > 0) & (F.size(split_words(clean)) >= 30)
    return F.when(does, clean).otherwise(_col(body)), F.when(does, gone).otherwise(0)


def json_of(text: Column | str) -> Column:
    """Return the object from the first to the last brace, or null if that isn't JSON."""
    found = F.regexp_extract(_col(text), r"(?s)\{.*\}", 0)
    # Within brackets, as the parser would pass over whatever follows a whole object.
    return F.when((found != "") & F.try_parse_json(F.concat(F.lit("["), found, F.lit("]"))).isNotNull(), found)


def phrase_evidence(text: Column | str, phrases: list[str], before: int = 80, after: int = 120) -> Column:
    """Return (phrase, evidence) for each of ``phrases`` that ``text`` holds, with what stands around the first."""

    def found(flat: Column) -> Column:
        at = lambda p: F.locate(p, F.lower(flat))
        each = [F.when(at(p) > 0, F.struct(F.lit(p).alias("phrase"), F.substring(flat, F.greatest(at(p) - before, F.lit(1)), F.least(at(p) - 1, F.lit(before)) + len(p) + after).alias("evidence"))) for p in phrases]
        return F.filter(F.array(*each), lambda x: x.isNotNull())

    return let(collapse(text), found)


def _places(text: str, c: str) -> list[int]:
    out, at = [], text.find(c)
    while at >= 0:
        out.append(at)
        at = text.find(c, at + 1)
    return out


def matched_characters(a: str, b: str) -> int:
    """Return the summed sizes of the matching blocks that difflib's SequenceMatcher(None, a, b) finds.

    A block starts from characters that are rare in ``b`` (all are where it has
    under 200) and is then prolonged by any. So what is looked up is the rare ones'
    places: runs of two or more of them are found once, by pairs of characters,
    and cut to each window; where none is left a single one's first place counts.
    """
    if a == b:
        return len(a)
    most = len(b) // 100 + 1 if len(b) >= 200 else len(b)
    places = {c: _places(b, c) for c in set(b) if b.count(c) <= most}
    found = sorted(i for c in places for i in _places(a, c))
    runs, twos, last = [], {}, len(a) - 1
    for i in found:
        if i == last or a[i + 1] not in places:
            continue
        two = a[i : i + 2]
        if two not in twos:
            twos[two] = [j for j in places[two[0]] if b[j + 1 : j + 2] == two[1]]
        for j in twos[two]:
            if i and j and a[i - 1] == b[j - 1] and a[i - 1] in places:
                continue  # within a run that began before
            k = 2
            while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and a[i + k] in places:
                k += 1
            runs.append((i, j, k))
    total, windows = 0, [(0, len(a), 0, len(b), runs)]
    while windows:
        alo, ahi, blo, bhi, runs = windows.pop()
        besti, bestj, best, inside = alo, blo, 0, []
        for i, j, k in runs:
            cut = max(alo - i, blo - j, 0)
            i, j = i + cut, j + cut
            k = min(k - cut, ahi - i, bhi - j)
            if k >= 2:
                inside.append((i, j, k))
                if k > best or (k == best and (i, j) < (besti, bestj)):  # the longest, then the first in a, then in b
                    besti, bestj, best = i, j, k
        if not best:
            for i in found[bisect_left(found, alo) : bisect_left(found, ahi)]:
                js = places[a[i]]
                at = bisect_left(js, blo)
                if at < len(js) and js[at] < bhi:
                    besti, bestj, best = i, js[at], 1
                    break
        enda, endb = besti + best, bestj + best
        while besti > alo and bestj > blo and a[besti - 1] == b[bestj - 1]:
            besti, bestj = besti - 1, bestj - 1
        while enda < ahi and endb < bhi and a[enda] == b[endb]:
            enda, endb = enda + 1, endb + 1
        if enda > besti:
            total += enda - besti
            if alo < besti and blo < bestj:
                windows.append((alo, besti, blo, bestj, inside))
            if enda < ahi and endb < bhi:
                windows.append((enda, ahi, endb, bhi, inside))
    return total


@F.pandas_udf(DoubleType())
def character_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Return the matching-blocks ratio of the first 5000 collapsed characters."""
    flat = lambda t: " ".join((t or "").split())[:5000]
    pairs = [(flat(x), flat(y)) for x, y in zip(a, b, strict=True)]
    return pd.Series([2.0 * matched_characters(x, y) / (len(x) + len(y)) if x or y else 1.0 for x, y in pairs], dtype="float64")
