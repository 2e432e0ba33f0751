"""Running state of domains, rates by minute and saturation, over a stream of ledger rows.

The watermark is one hour: rows that come later than that no longer change
windows that have been closed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lexloom.functions import url as U
from lexloom.functions import vocab

WATERMARK = "1 hour"


def per_minute(rows: DataFrame, time: str = "time", width: str = "1 minute", slide: str | None = None, keys: tuple[str, ...] = (), values: dict[str, str] | None = None) -> DataFrame:
    """Return counts (and sums of ``values``: new name to column) of each window; works on streams and tables."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    sums = [F.sum(c).alias(n) for n, c in (values or {}).items()]
    marked = rows.withWatermark(time, WATERMARK) if rows.isStreaming else rows
    return marked.groupBy(window.alias("w"), *keys).agg(F.count("*").alias("n"), *sums).select(F.col("w.start").alias("start"), *keys, "n", *(values or {}))


def domain_counters(rows: DataFrame) -> DataFrame:
    """Return running counters of each domain (update or complete mode)."""
    return rows.groupBy(U.bare_host("url").alias("domain")).agg(
        F.count_if(F.col("decision") == "enqueued").alias("enqueued"), F.count_if(F.col("decision").isin(vocab.FETCH_OUTCOMES)).alias("fetched"),
        F.count_if(F.col("decision") == "saved").alias("saved"), F.count_if(F.col("decision").isin(vocab.FAILURES)).alias("failed"), F.max("ts").alias("last_ts"),
    )


def rates(totals: DataFrame, least_seconds: float = 600) -> DataFrame:
    """Return ``totals`` (tokens, first_ts, last_ts) with tokens per second, null for a time that is too short."""
    span = F.col("last_ts") - F.col("first_ts")
    return totals.withColumn("tokens_per_second", F.when(span >= least_seconds, F.round(F.col("tokens") / span, 2)))


def projected(rates_now: DataFrame, hours: float = 24) -> DataFrame:
    return rates_now.withColumn("projected_tokens", F.round(F.col("tokens_per_second") * hours * 3600).cast("long"))


def saturation(rows: DataFrame, window: int = 25, budget_seconds: float | None = None, by_clock: bool = False) -> DataFrame:
    """Return (seed, fetched, barren, state) after each batch: open, saturated or out_of_time.

    Kept for each seed: fetches, fetches since the last that yielded, and the
    first time. A trigger's rows of a seed come in pieces of any order: what counts
    is their time, so the times of fetches after the latest that yielded are held
    until all have come. The time runs on over all sections of a seed. With ``by_clock``
    the budget is counted from the first batch that holds the seed and a timer
    of the engine's own clock ends it, even if no more rows come.
    """
    schema = "seed string, fetched long, barren long, state string"
    names = ["seed", "fetched", "barren", "state"]

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        fetched, barren, first, ends = state.get if state.exists else (0, 0, float("inf"), 0)
        if state.hasTimedOut:
            yield pd.DataFrame([(key[0], fetched, barren, "out_of_time")], columns=names)
            return
        last, yielded, later = float("-inf"), float("-inf"), pd.Series(dtype="float64")
        for batch in batches:
            first, last = min(first, batch["ts"].min()), max(last, batch["ts"].max())
            visits = batch.fillna({"ts": float("inf")})[batch["decision"].isin(vocab.FETCH_OUTCOMES)]
            yields = (visits["decision"] == "saved") | ((visits["decision"] == "listing") & (visits["kind"] == "new_items"))
            fetched += len(visits)
            if yields.any():
                yielded, barren = max(yielded, visits["ts"][yields].max()), 0
            later = pd.concat([later, visits["ts"]])
            later = later[later > yielded]
        barren += len(later)
        if by_clock and budget_seconds is not None:
            now = state.getCurrentProcessingTimeMs()
            ends = ends or now + int(1000 * budget_seconds)
            late = now >= ends
            if not late:
                state.setTimeoutDuration(max(1, ends - now))
        else:
            late = budget_seconds is not None and last - first > budget_seconds
        state.update((fetched, barren, first, ends))
        yield pd.DataFrame([(key[0], fetched, barren, "out_of_time" if late else "saturated" if barren >= window else "open")], columns=names)

    timeout = GroupStateTimeout.ProcessingTimeTimeout if by_clock else GroupStateTimeout.NoTimeout
    return rows.select("seed", "ts", "decision", "kind").groupBy("seed").applyInPandasWithState(update, schema, "fetched long, barren long, first double, ends long", "update", timeout)


def new_contents(rows: DataFrame, key: str = "content_hash") -> DataFrame:
    """Return the rows of a stream whose content is new; what was seen is kept for good."""
    return rows.dropDuplicates([key])


def to_table(frame: DataFrame, folder: str, mode: str = "complete", trigger: dict | None = None) -> DataFrame:
    """Run a streaming frame over all that is there now and return its table.

    Each batch's whole result replaces the table of ``folder`` (in complete
    mode; else it is added), so that nothing is collected. ``trigger`` is that of
    a query that stays open, such as {"processingTime": "2 seconds"}, which is then
    the age that a snapshot of the table has at most; such a query is not awaited.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(f"{folder}/batch={number}" if mode == "complete" else f"{folder}/batch=0")

    query = frame.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{folder}-progress").trigger(**(trigger or {"availableNow": True})).start()
    if trigger is None:
        query.awaitTermination()
    return snapshot(frame.sparkSession, folder, frame.schema)


def snapshot(spark, folder: str, schema) -> DataFrame:
    """Return the latest whole result that :func:`to_table` has written; none gives no rows."""
    from pyspark.errors import AnalysisException

    try:
        rows = spark.read.parquet(folder)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        return spark.createDataFrame([], schema)
    latest = rows.agg(F.max("batch")).first()[0]  # a batch is a folder: its name is pruned by
    return rows.where(F.col("batch") == latest).drop("batch")


#: The kind of a document's source, by which the panel counts.
SOURCE_KIND = {"pdf": "pdf", "docx": "docx"}


def source_kind(source_type) -> F.Column:
    return F.when(source_type.isin(*SOURCE_KIND), source_type).otherwise("html")


def documents_per_minute(docs: DataFrame, time: str = "time", width: str = "1 minute") -> DataFrame:
    """Return (start, domain, kind, docs, words, tokens) of documents (time, domain, source_type, words, chars); works on streams and tables."""
    rows = docs.withColumns({"kind": source_kind(F.col("source_type")), "tokens": F.floor(F.col("chars") / 4)})
    out = per_minute(rows, time, width, None, ("domain", "kind"), {"words": "words", "tokens": "tokens"})
    return out.select("start", "domain", "kind", F.col("n").alias("docs"), "words", "tokens")


def domain_rows(ledger: DataFrame, docs: DataFrame, seeds: DataFrame, done: DataFrame, now: float, quiet: float = 150.0, least_seconds: float = 600.0, seq: str = "seq") -> DataFrame:
    """Return the panel's row of each domain at the time ``now``: counters of visits and documents, pace, status, why a seed closed.

    ``ledger`` has seq, ts, seed, url, decision, reason; ``docs`` domain, ts,
    words, chars, source_type; ``seeds`` and ``done`` domain. A domain is that of
    the seed. Status: terminado (done), else activo (seen less than ``quiet``
    seconds ago), en pausa, or pendiente for a seed that nothing was seen of.
    """
    own = F.coalesce(F.nullif(U.bare_host("seed"), F.lit("")), U.bare_host("url"))
    is_ = lambda *names: F.col("decision").isin(*names)
    close = F.when((F.col("url") == F.col("seed")) & is_(*vocab.FAILURES, "throttle"), F.concat("decision", F.coalesce(F.concat(F.lit(": "), F.col("reason")), F.lit(""))))
    visits = ledger.withColumns({"domain": own, "_close": close}).groupBy("domain").agg(
        F.count_if(is_("enqueued")).alias("seen"), F.count_if(is_(*vocab.FETCH_OUTCOMES)).alias("fetched"), F.count_if(is_("duplicate")).alias("dup"), F.count_if(is_("listing")).alias("listing"),
        F.count_if(is_("hub", "no_document")).alias("discarded"), F.count_if(is_(*vocab.FAILURES)).alias("fail"), F.max("ts").alias("last"), F.max_by("url", seq).alias("last_url"),
        F.max_by("decision", seq).alias("last_decision"), F.max_by("_close", F.when(F.col("_close").isNotNull(), F.col(seq))).alias("seed_close"),
    )
    kind = source_kind(F.col("source_type"))
    held = docs.groupBy("domain").agg(
        F.count("*").alias("saved"), F.sum("words").cast("long").alias("words"), F.sum(F.floor(F.col("chars") / 4)).cast("long").alias("tokens"), F.min("ts").alias("first_doc"), F.max("ts").alias("last_doc"),
        *[F.count_if(kind == k).alias(k) for k in ("pdf", "html", "docx")],
    )
    finished = done.select(F.regexp_replace("domain", r"^www\.", "").alias("domain")).distinct().withColumn("_done", F.lit(True))
    rows = visits.withColumn("_met", F.lit(True)).join(held, "domain", "full_outer").join(seeds.select("domain").distinct(), "domain", "full_outer").join(finished, "domain", "left")
    age = F.lit(now) - F.coalesce("last", F.lit(0.0))
    met = F.coalesce("_met", F.lit(False)) | F.col("saved").isNotNull()
    status = F.when(F.coalesce("_done", F.lit(False)), "terminado").when(~met, "pendiente").when(age < quiet, "activo").otherwise("en pausa")
    span = F.col("last_doc") - F.col("first_doc")
    pace = F.when(span >= least_seconds, F.round(F.col("tokens") / span, 1))
    counts = ("seen", "fetched", "saved", "words", "tokens", "dup", "fail", "listing", "discarded", "pdf", "html", "docx")
    return rows.select("domain", status.alias("status"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts], pace.alias("tps"), "last_url", "last_decision", F.coalesce("seed_close", F.lit("")).alias("seed_close"))


def key_figures(corpora: dict[str, DataFrame]) -> DataFrame:
    """Return one row for each corpus of :func:`domain_rows` and one for all (``*``): domains by status and sums of the counters."""
    every = None
    for label, rows in corpora.items():
        part = rows.withColumn("corpus", F.lit(label))
        every = part if every is None else every.unionByName(part)
    both = every.withColumn("corpus", F.explode(F.array("corpus", F.lit("*"))))
    sums = [F.sum(c).cast("long").alias(c) for c in ("saved", "words", "tokens", "fetched", "fail")]
    by_status = [F.count_if(F.col("status") == s).alias(n) for n, s in (("done", "terminado"), ("active", "activo"), ("paused", "en pausa"), ("pending", "pendiente"))]
    return both.groupBy("corpus").agg(F.count("*").alias("domains"), *by_status, *sums)


def minute_series(per_minute_rows: DataFrame, now: float, minutes: int = 120) -> DataFrame:
    """Return (minute, docs, tokens) for each of the last ``minutes``, those without documents included."""
    spark = per_minute_rows.sparkSession
    last = int(now // 60)
    clock = spark.range(last - minutes + 1, last + 1).withColumnRenamed("id", "minute")
    sums = per_minute_rows.groupBy(F.floor(F.unix_timestamp("start") / 60).alias("minute")).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    return clock.join(sums, "minute", "left").select("minute", F.coalesce("docs", F.lit(0)).cast("long").alias("docs"), F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"))


def state_json(rows: DataFrame) -> DataFrame:
    """Return (domain, value): each domain's row as JSON, as a page would be sent it."""
    return rows.select("domain", F.to_json(F.struct(*rows.columns)).alias("value"))
