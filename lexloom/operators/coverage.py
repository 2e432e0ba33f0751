"""Coverage of a crawl against an inventory, from the append-only ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexloom.functions import url as U
from lexloom.functions import vocab


def collapse(ledger: DataFrame, host: str | None = None, index_urls: DataFrame | None = None, seq: str = "seq") -> DataFrame:
    """Return one row for each normalised URL: kind, via, fetch, reason, not_fetched, rejected.

    ``seq`` gives the order of the rows. The first enqueued row with a kind (or
    via) gives it; a saved page stays saved, else the last outcome counts.
    ``index_urls`` (url) turns saved pages that aren't in it to duplicates.
    """
    rows = ledger.where("url IS NOT NULL")
    if host:
        rows = rows.where(U.bare_host("url") == host)
    rows = rows.withColumn("key", U.normalize("url"))
    if index_urls is not None:
        known = index_urls.select(U.normalize("url").alias("key")).distinct().withColumn("_known", F.lit(True))
        rows = rows.join(known, "key", "left").withColumn("decision", F.when((F.col("decision") == "saved") & F.col("_known").isNull(), "duplicate").otherwise(F.col("decision")))
    fetched = F.col("decision").isin(vocab.FETCH_OUTCOMES)
    saved = F.col("decision") == "saved"
    first = lambda c: F.min_by(c, F.when((F.col("decision") == "enqueued") & F.col(c).isNotNull(), F.col(seq)))
    last = lambda c, when: F.max_by(c, F.when(when, F.col(seq)))
    first_saved = F.min_by("reason", F.when(saved, F.col(seq)))
    any_saved = F.max(F.coalesce(saved, F.lit(False)))
    return rows.groupBy("key").agg(
        first("kind").alias("kind"), first("via").alias("via"),
        F.when(any_saved, "saved").otherwise(last("decision", fetched)).alias("fetch"),
        F.when(any_saved, first_saved).otherwise(last("reason", fetched)).alias("reason"),
        last("reason", F.col("decision") == "not_fetched").alias("not_fetched"),
        last("reason", F.col("decision") == "rejected").alias("rejected"),
    )


def funnel(by_url: DataFrame) -> DataFrame:
    """Return (outcome, n_urls): the outcome of a fetch, else not_fetched, rejected:<reason> or enqueued_only."""
    outcome = F.coalesce("fetch", F.when(F.col("not_fetched").isNotNull(), "not_fetched"), F.concat(F.lit("rejected:"), "rejected"), F.lit("enqueued_only"))
    return by_url.groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n_urls"))


def classed_inventory(inventory: DataFrame) -> DataFrame:
    """Return ``inventory`` (key, source) with class: utility, not_extractable or content."""
    return inventory.withColumn("class", F.when(U.is_utility("key"), "utility").when(~U.is_extractable("key"), "not_extractable").otherwise("content"))


def missing(inventory: DataFrame, by_url: DataFrame) -> DataFrame:
    """Return (key, source, stage, why, document) of content that wasn't saved."""
    rows = classed_inventory(inventory).where("class = 'content'").join(by_url.withColumn("_seen", F.lit(True)), "key", "left")
    rows = rows.where(F.coalesce(F.col("fetch") != "saved", F.lit(True)))
    stage = F.when(F.col("_seen").isNull(), "no_vista").when(F.col("fetch").isNotNull(), "descartada").when(F.col("not_fetched").isNotNull(), "sin_descargar").when(F.col("rejected").isNotNull(), "rechazada").otherwise("sin_descargar")
    with_reason = F.concat("fetch", F.coalesce(F.concat(F.lit(" ("), "reason", F.lit(")")), F.lit("")))
    why = F.when(F.col("_seen").isNull(), "el crawl nunca llegó a esta URL").otherwise(F.coalesce(with_reason, "not_fetched", "rejected", F.lit("quedó encolada")))
    return rows.select("key", "source", stage.alias("stage"), why.alias("why"), U.is_document("key").alias("document"))


def missing_reasons(gaps: DataFrame, most: int = 12) -> DataFrame:
    """Return the ``most`` frequent reasons (up to a bracket) of :func:`missing`."""
    reason = F.element_at(F.split("why", r" \("), 1)
    return gaps.groupBy(reason.alias("why")).agg(F.count("*").alias("n_urls")).orderBy(F.desc("n_urls"), "why").limit(most)


def metrics(inventory: DataFrame, by_url: DataFrame) -> DataFrame:
    """Return one row of counts and percentages (one decimal)."""
    rows = classed_inventory(inventory).join(by_url.withColumn("_seen", F.lit(True)), "key", "full_outer")
    content = F.coalesce(F.col("class") == "content", F.lit(False))
    saved = F.coalesce(F.col("fetch") == "saved", F.lit(False))
    listed = F.col("class").isNotNull()
    out = rows.agg(
        F.count_if(listed).alias("inventory_total"), F.count_if(content).alias("inventory_content"),
        F.count_if(F.col("class") == "utility").alias("inventory_utility"), F.count_if(F.col("class") == "not_extractable").alias("inventory_not_extractable"),
        F.count_if(content & F.col("_seen").isNotNull()).alias("seen"), F.count_if(content & F.col("fetch").isNotNull()).alias("fetched"),
        F.count_if(content & saved).alias("saved"), F.count_if(saved).alias("saved_total"), F.count_if(saved & listed).alias("saved_listed"),
    )
    share = lambda a, b: F.round(100 * F.col(a) / F.nullif(F.col(b), F.lit(0)), 1)
    return out.select("*", share("seen", "inventory_content").alias("reach_pct"), share("fetched", "inventory_content").alias("fetch_pct"), share("saved", "inventory_content").alias("recall_pct"), share("saved_listed", "saved_total").alias("precision_pct"), (F.col("saved_total") - F.col("saved_listed")).alias("saved_outside")).drop("saved_listed")


def extra(inventory: DataFrame, by_url: DataFrame) -> DataFrame:
    """Return the keys that were saved but aren't in the inventory."""
    return by_url.where("fetch = 'saved'").select("key").join(inventory.select("key"), "key", "left_anti")


def union_inventories(sources: list[tuple[str, DataFrame]]) -> DataFrame:
    """Return (key, source): the union of inventories (url); the first source that lists a URL counts."""
    every = None
    for k, (name, rows) in enumerate(sources):
        part = rows.select(U.normalize("url").alias("key"), F.lit(k).alias("_k"), F.lit(name).alias("source"))
        every = part if every is None else every.unionByName(part)
    return every.groupBy("key").agg(F.min_by("source", "_k").alias("source"))


def domain_activity(ledger: DataFrame, now: float, seq: str = "seq", quiet: float = 150.0) -> DataFrame:
    """Return counters and status of each domain at the time ``now`` (seconds)."""
    rows = ledger.withColumn("domain", U.bare_host("url"))
    counts = rows.groupBy("domain").agg(
        F.count_if(F.col("decision") == "enqueued").alias("enqueued"), F.count_if(F.col("decision").isin(vocab.FETCH_OUTCOMES)).alias("fetched"),
        F.count_if(F.col("decision") == "saved").alias("saved"), F.count_if(F.col("decision").isin(vocab.FAILURES)).alias("failed"),
        F.max_by("url", seq).alias("last_url"), F.max_by("decision", seq).alias("last_decision"), F.max("ts").alias("last_ts"),
    )
    return counts.withColumn("status", F.when(F.lit(now) - F.col("last_ts") < quiet, "active").otherwise("paused"))


def recent_failures(ledger: DataFrame, most: int = 200, seq: str = "seq") -> DataFrame:
    """Return the latest ``most`` failed rows."""
    return ledger.where(F.col("decision").isin(vocab.FAILURES)).orderBy(F.desc("ts"), F.desc(seq)).limit(most)


def saturation(ledger: DataFrame, window: int = 25, seed: str = "seed", seq: str = "seq") -> DataFrame:
    """Return fetches of each seed with ``barren``, how many there were since the last that yielded, and ``saturated``.

    A saved page yields, and a listing with new items does (``kind`` tells it).
    """
    fetched = ledger.where(F.col("decision").isin(vocab.FETCH_OUTCOMES))
    order = Window.partitionBy(seed).orderBy(seq)
    rows = fetched.withColumn("nth", F.row_number().over(order))
    yields = (F.col("decision") == "saved") | ((F.col("decision") == "listing") & (F.col("kind") == "new_items"))
    last = F.coalesce(F.max(F.when(yields, F.col("nth"))).over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    return rows.withColumn("barren", F.col("nth") - last).withColumn("saturated", F.col("barren") >= window)
