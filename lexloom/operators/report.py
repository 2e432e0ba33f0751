"""Corpus reports: counts, order of work, run statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.functions import url as U


def corpus_counts(docs: DataFrame, columns: list[str], words: str = "words") -> DataFrame:
    """Return (dimension, value, docs, words) for each column and the total, in one pass.

    Missing values are ``?``; a language counts by what stands before a hyphen.
    """
    value = lambda c: F.coalesce(F.element_at(F.split(c, "-"), 1) if c == "lang" else F.col(c), F.lit("?"))
    pairs = [F.struct(F.lit(c).alias("dimension"), value(c).alias("value")) for c in columns]
    rows = docs.select(F.explode(F.array(F.struct(F.lit("total").alias("dimension"), F.lit("").alias("value")), *pairs)).alias("d"), words)
    return rows.groupBy("d.dimension", "d.value").agg(F.count("*").alias("docs"), F.coalesce(F.sum(words), F.lit(0)).cast("long").alias("words"))


def largest(docs: DataFrame, most: int, words: str = "words", id_col: str = "doc_id") -> DataFrame:
    """Return the ``most`` documents with the most words."""
    return docs.orderBy(F.desc(words), id_col).limit(most)


def seeds_by_domain(seeds: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """Return (domain, n_seeds) of domains that aren't ``done`` (domain)."""
    groups = seeds.groupBy(U.bare_host("url").alias("domain")).agg(F.count("*").alias("n_seeds"))
    return groups if done is None else groups.join(done.select("domain"), "domain", "left_anti")


def run_rates(events: DataFrame) -> DataFrame:
    """Return pages per minute and documents per hour of (pages, documents, seconds)."""
    return events.withColumns({"pages_per_minute": F.round(F.col("pages") / F.nullif(F.col("seconds"), F.lit(0)) * 60, 1), "documents_per_hour": F.round(F.col("documents") / F.nullif(F.col("seconds"), F.lit(0)) * 3600, 1)})


def token_f1(pairs: DataFrame, left: str = "a_text", right: str = "b_text", keys: tuple[str, ...] = ("a", "b")) -> DataFrame:
    """Return the pairs' F1 of their tokens as multisets."""
    from lexloom.functions.text import let, numbered, tokens

    # Rows of the same keys are one pair. Each pair's tokens stay in its row: as rows of their own they would all be dealt out again.
    whole = pairs.groupBy(*keys).agg(*[F.array_join(F.collect_list(c), " ").alias(n) for c, n in ((left, "_a"), (right, "_b"))])
    both = F.array(*[numbered(tokens(n)) for n in ("_a", "_b")])
    f1 = lambda x: F.filter(F.array(2 * F.size(F.array_intersect(x[0], x[1])) / F.nullif(F.size(x[0]) + F.size(x[1]), F.lit(0))), lambda f: f.isNotNull())
    return whole.select(*keys, F.explode(let(both, f1)).alias("f1"))  # exploded and not filtered, which would make the sets twice


def engine_agreement(texts: DataFrame) -> DataFrame:
    """Return (engine_a, engine_b, docs, f1): how well each two engines' texts (doc_id, engine, text) agree, on average over documents.

    The engine that agrees best with the others is the consensus where no true text is known.
    """
    one, two = (texts.select("doc_id", F.col("engine").alias(f"engine_{side}"), F.col("text").alias(f"{side}_text")) for side in "ab")
    pairs = one.join(two, "doc_id").where("engine_a < engine_b")  # a handful of engines for each document
    keys = ("doc_id", "engine_a", "engine_b")
    return token_f1(pairs, keys=keys).groupBy("engine_a", "engine_b").agg(F.count("*").alias("docs"), F.avg("f1").alias("f1"))


def described(index: DataFrame, metadata: DataFrame, texts: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Return the documents of an index with their metadata, which they must have, and their text, which may be missing."""
    return index.join(metadata, id_col).join(texts, id_col, "left")


def external_ids(docs: DataFrame) -> DataFrame:
    """Return ``docs`` with ext_source and ext_id, as an article's URL names them."""
    part = lambda k: F.regexp_extract("url", r"/article/([A-Z]+)/(\w+)", k)
    return docs.withColumns({"ext_source": F.nullif(part(1), F.lit("")), "ext_id": F.nullif(part(2), F.lit(""))})


def compared(api: DataFrame, scraped: DataFrame) -> DataFrame:
    """Return (found_in, n) for article ids of an API and of a crawl."""
    both = api.select("ext_id").distinct().withColumn("x", F.lit(1)).join(scraped.select("ext_id").distinct().withColumn("y", F.lit(1)), "ext_id", "full_outer")
    where = F.when(F.col("y").isNull(), "api").when(F.col("x").isNull(), "scraped").otherwise("both")
    return both.groupBy(where.alias("found_in")).agg(F.count("*").alias("n"))


def probe_summary(pages: DataFrame) -> DataFrame:
    """Return (seed, unique_items, pages, pages_with_new, stopped_at) of a pagination probe (seed, page, item).

    ``stopped_at`` is the third page in a row without a new item, if there is one.
    """
    from pyspark.sql import Window

    first = pages.groupBy("seed", "item").agg(F.min("page").alias("page"))
    per_page = pages.select("seed", "page").distinct().join(first.groupBy("seed", "page").agg(F.count("*").alias("new")), ["seed", "page"], "left")
    order = Window.partitionBy("seed").orderBy("page")
    last_new = F.coalesce(F.max(F.when(F.col("new") > 0, F.col("page"))).over(order), F.lit(0))
    rows = per_page.withColumn("barren", F.col("page") - last_new)
    return rows.groupBy("seed").agg(F.coalesce(F.sum("new"), F.lit(0)).cast("long").alias("unique_items"), F.count("*").alias("pages"), F.count_if(F.col("new") > 0).alias("pages_with_new"), F.min(F.when(F.col("barren") >= 3, F.col("page"))).alias("stopped_at"))
