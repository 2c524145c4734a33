"""Structured Streaming forms of the listening operators.

Each function takes a streaming DataFrame and returns either a streaming
DataFrame (to be written by the caller) or a started ``StreamingQuery``.  Event
time columns must be ``timestamp`` for watermarks; ``event_time`` converts the
``timestamp_ntz`` columns of the batch model (session time zone UTC).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beatstream.functions.parse import parse_lines, parse_plays
from beatstream.functions.scalar import hashtags
from beatstream.functions.timeutil import instant_to_ntz, ntz_micros, ntz_to_instant, pane_width
from beatstream.operators.joins import CUSTOMER_ATTRIBUTES, enrich_and_flag, index_document
from beatstream.operators.windows import top_n_per_group
from beatstream.session import shared_path
from beatstream.streaming.sinks import nested_window_result, read_keyed_table, set_add, write_batch_output

DEFAULT_TRIGGER = {"processingTime": "2 seconds"}


def event_time(df: DataFrame, col: str, as_col: str | None = None) -> DataFrame:
    """Event time as ``timestamp`` for watermarks; a ``timestamp_ntz`` wall clock is
    read as UTC, so windows align the same way in every session time zone."""
    c = F.col(col)
    if df.schema[col].dataType.typeName() == "timestamp_ntz":
        c = ntz_to_instant(c)
    return df.withColumn(as_col or col, c)


def ntz(c: Column) -> Column:
    """Back to the data model's ``timestamp_ntz`` (inverse of ``event_time``)."""
    return instant_to_ntz(c)


def start(df: DataFrame, handler: Callable | None = None, checkpoint: str | None = None,
          trigger: dict | None = None, output_mode: str = "append", sink: str = "parquet",
          query_name: str | None = None, path: str | None = None):
    """Start a query: ``foreachBatch(handler)`` when given, else the named sink.

    File sinks write to ``path`` (default: a fresh folder below the shared
    checkpoint root).  The ``memory`` sink keeps the whole result on the driver
    and is meant for small results and tests only.  ``trigger`` follows
    ``DataStreamWriter.trigger`` keywords, e.g. ``{"processingTime": "2 seconds"}``
    (the reference's batch interval) or ``{"availableNow": True}`` for a bounded
    run over what is there.
    """
    spark = df.sparkSession
    w = (df.writeStream.outputMode(output_mode)
           .option("checkpointLocation", checkpoint or shared_path(spark, "ck"))
           .trigger(**(trigger or DEFAULT_TRIGGER)))
    if query_name:
        w = w.queryName(query_name)
    if handler is not None:
        return w.foreachBatch(handler).start()
    w = w.format(sink)
    if sink in ("memory", "console", "noop"):
        return w.start()
    return w.start(path or shared_path(spark, f"{sink}-out"))


def run_for(query, minutes: float = 0) -> None:
    """Run until stopped (``minutes == 0``) or stop after ``minutes``."""
    if minutes <= 0:
        query.awaitTermination()
        return
    if not query.awaitTermination(minutes * 60):
        query.stop()


# --- bounded runs -------------------------------------------------------------------------

CLOSING_YEARS = 100


def run_closed(source: DataFrame, sample: DataFrame, ts_col: str, begin: Callable[[DataFrame, str], object],
               at_once: bool = False) -> None:
    """Run a windowed query over a bounded input and close the input, so that every window
    arrives, the newest ones too.

    ``begin(stream, checkpoint)`` starts the query with an ``availableNow`` trigger.  A closing
    row, a copy of a row of ``sample`` (the same table, not streaming) set ``CLOSING_YEARS``
    later, moves the watermark past all real windows; its own window stays open.  The query
    runs once over the data and once more over the closing row.  ``at_once`` gives it both in
    one run: for a source without a rate limit, whose data is one batch (the watermark moves
    behind it; a later batch would find its rows too late).
    """
    spark = source.sparkSession
    folder, checkpoint = shared_path(spark, "closing"), shared_path(spark, "ck-closed")
    later = F.col(ts_col) + F.make_ym_interval(F.lit(CLOSING_YEARS))
    closing = sample.limit(1).withColumn(ts_col, later)
    (closing if at_once else sample.limit(0)).write.parquet(folder)
    stream = source.unionByName(spark.readStream.schema(sample.schema).parquet(folder))
    begin(stream, checkpoint).awaitTermination()
    if not at_once:
        closing.write.mode("append").parquet(folder)
        begin(stream, checkpoint).awaitTermination()


# --- real-time ad flags: parse -> enrich -> flag -> append + audience set ---------------

Lookup = DataFrame | Callable[[], DataFrame]


def _current(table: Lookup) -> DataFrame:
    return table() if callable(table) else table


def ad_flag_stream(lines: DataFrame, customers: Lookup, predictions: Lookup, out_path: str,
                   audience_path: str, checkpoint: str | None = None, trigger: dict | None = None,
                   on_missing: str = "null", hot_customers: list | None = None):
    """The whole real-time flow.  Per micro-batch: look the plays up in the customers and
    predictions of that moment (one join, with AQE's skew handling), write the records
    (idempotent per batch id) and add flagged customers to the audience set.

    ``customers`` and ``predictions`` may be functions that return the current table, for
    example ``lambda: read_keyed_table(spark, path)``: they are called for every batch, so
    a table published between two batches (a retrained model) is used from the next batch
    on.  A plain DataFrame is taken as it is.
    """
    plays = parse_plays(lines)

    def handle(batch: DataFrame, batch_id: int) -> None:
        records = index_document(enrich_and_flag(batch, _current(customers), _current(predictions), on_missing,
                                                 ingest_time=True, hot_keys=hot_customers))
        records = records.persist()
        try:
            if records.isEmpty():
                return
            write_batch_output(records, out_path, batch_id)
            set_add(records.filter(F.col("SendEvent") == 1), audience_path)
        finally:
            records.unpersist()

    return start(plays, handle, checkpoint, trigger, query_name=None)


def enrich_waiting(plays: DataFrame, customers: DataFrame, wait: str = "1 hour", delay: str = "10 minutes",
                   ts_col: str = "datetime", since_col: str = "known_since", key: str = "customer_id") -> DataFrame:
    """Customer attributes for each play of a stream, waiting for customers that arrive after their plays.

    Both inputs are streams; ``customers`` has one row per customer, known from ``since_col``
    on.  A play waits in the state until its customer arrives.  Once the watermark says that
    no customer known within ``wait`` of the play can still come, the play goes out with null
    attributes.  Customers stay in the state, as any later play may need them; plays leave it
    when matched or expired.  The watermark is that of the slower input: while one stands
    still, plays wait.  Plays without a customer id come out with nulls.
    """
    p = event_time(plays, ts_col, "_at").withWatermark("_at", delay)
    c = event_time(customers.select(F.col(key).alias("_key"), *CUSTOMER_ATTRIBUTES, since_col), since_col, "_since")
    c = c.drop(since_col).withWatermark("_since", delay)
    known = (F.col(key) == F.col("_key")) & (F.col("_since") <= F.col("_at") + F.expr(f"INTERVAL {wait}"))
    return p.join(c, known, "leftOuter").drop("_key", "_since", "_at")


def observed_flags(lines: DataFrame, customers: DataFrame, predictions: DataFrame, name: str = "flow") -> DataFrame:
    """The real-time flow as one plan that reports what it saw in every progress report.

    Observed metrics, computed while the rows pass (no extra job): ``<name>_lines`` counts
    lines and quarantined ones, ``<name>_plays`` plays, those without a customer, flagged ones
    and the largest lag between event time and now in seconds.
    """
    parsed = parse_lines(lines).observe(
        f"{name}_lines", F.count(F.lit(1)).alias("lines"), F.count_if(F.col("reject_reason").isNotNull()).alias("quarantined"))
    plays = parsed.filter(F.col("reject_reason").isNull()).drop("raw", "reject_reason")
    lag = F.unix_micros(F.current_timestamp()) / 1e6 - ntz_micros(F.col("datetime")) / 1e6
    return enrich_and_flag(plays, customers, predictions).observe(
        f"{name}_plays", F.count(F.lit(1)).alias("plays"), F.count_if(F.col("name").isNull()).alias("missing_customers"),
        F.count_if(F.col("SendEvent") == 1).alias("flagged"), F.max(lag).alias("event_lag_seconds"))


def keyed_table(spark: SparkSession, path: str) -> Callable[[], DataFrame]:
    """The current content of a keyed table, looked up anew at every call."""
    return lambda: read_keyed_table(spark, path)


# --- sliding windows by panes -------------------------------------------------------------

def pane_counts(events: DataFrame, by: list[str], length: str, slide: str | None, ts_col: str,
                aggs: dict[str, tuple[Column, Callable[[str], Column]]]) -> DataFrame:
    """Aggregates per (window, ``by``) of a watermarked stream.

    Rows are aggregated once per pane (the longest span that lies whole in the same
    windows); finished panes are then combined to the windows that hold them, so a row is
    not copied to every window.  ``aggs`` gives for each column the aggregate over rows
    and how its pane values combine.
    """
    if slide is None:  # tumbling windows are their own panes
        w = F.window(F.col(ts_col), length)
        out = events.groupBy(w.alias("window"), *by).agg(*[a.alias(c) for c, (a, _) in aggs.items()])
        return out.select(ntz(F.col("window.start")).alias("window_start"),
                          ntz(F.col("window.end")).alias("window_end"), *by, *aggs)
    pane = F.window(F.col(ts_col), pane_width(length, slide))
    panes = events.groupBy(pane.alias("pane"), *by).agg(*[a.alias(c) for c, (a, _) in aggs.items()])
    w = F.window(F.window_time("pane"), length, slide)
    return (panes.groupBy(w.alias("window"), *by).agg(*[f(c).alias(c) for c, (_, f) in aggs.items()])
                 .select(ntz(F.col("window.start")).alias("window_start"),
                         ntz(F.col("window.end")).alias("window_end"), *by, *aggs))


# --- trending hashtags over sliding windows ---------------------------------------------

def windowed_tag_counts(messages: DataFrame, length: str, slide: str, delay: str,
                        ts_col: str = "ts", text_col: str = "text") -> DataFrame:
    """Streaming counts per (sliding window, tag); a window is final once the
    watermark passes its end (append mode)."""
    m = event_time(messages.select(ts_col, text_col), ts_col)
    tags = hashtags(m, text_col, keep=[ts_col]).withWatermark(ts_col, delay)
    return pane_counts(tags, ["tag"], length, slide, ts_col, {"amount": (F.count(F.lit(1)), F.sum)})


def rank_window_tags(counts: DataFrame, n: int) -> DataFrame:
    return top_n_per_group(counts, ["window_start", "window_end"], [F.desc("amount"), F.asc("tag")], n,
                           rank_col="rank")


def trending_tags_stream(messages: DataFrame, out_path: str, length: str = "60 minutes",
                         slide: str = "20 minutes", n: int = 10, delay: str = "10 minutes",
                         checkpoint: str | None = None, trigger: dict | None = None,
                         handler: Callable[[DataFrame, int], None] | None = None):
    """Top ``n`` tags of each sliding window, stored as one nested row per window.

    All rows of a window are emitted in the same micro-batch (when the watermark
    passes its end), so ranking inside ``foreachBatch`` is exact.  ``handler``
    receives the ranked flat rows of each batch as well (the user callback).
    """
    counts = windowed_tag_counts(messages, length, slide, delay)

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Windows leave the aggregation only when the watermark passes their end,
        # so many batches emit nothing: skip the ranking jobs for those.
        batch = batch.persist()
        ranked = None
        try:
            if batch.isEmpty():
                return
            ranked = rank_window_tags(batch, n).persist()
            write_batch_output(nested_window_result(ranked), out_path, batch_id)
            if handler is not None:
                handler(ranked, batch_id)
        finally:
            if ranked is not None:
                ranked.unpersist()
            batch.unpersist()

    # Without an explicit trigger a batch runs once per slide, as in the reference job.
    return start(counts, handle, checkpoint, trigger or {"processingTime": slide})


# --- other stream operators --------------------------------------------------------------

def dedup_events(events: DataFrame, key: str = "event_id", ts_col: str = "ts",
                 delay: str = "1 hour") -> DataFrame:
    """Drop redelivered records (same key) seen within the watermark delay."""
    e = event_time(events, ts_col)
    return e.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark([key])


def tumbling_counts(events: DataFrame, width: str = "1 hour", ts_col: str = "ts",
                    delay: str = "10 minutes", by: list[str] | None = None) -> DataFrame:
    """Rows per tumbling event-time bucket (optionally per key), final in append mode."""
    e = event_time(events, ts_col).withWatermark(ts_col, delay)
    w = F.window(F.col(ts_col), width)
    return (e.groupBy(w.alias("window"), *(by or [])).agg(F.count(F.lit(1)).alias("events"))
             .select(ntz(F.col("window.start")).alias("bucket_start"), *(by or []), "events"))


def access_stats_stream(plays: DataFrame, length: str = "30 minutes", slide: str = "5 minutes",
                        delay: str = "10 minutes", ts_col: str = "datetime") -> DataFrame:
    """Access statistics of the last ``length`` every ``slide`` on a play stream:
    plays, mobile plays and approximate unique customers per sliding window, final
    once the watermark passes the window end (exact distinct counts are not
    available on streams; the batch ``access_stats`` has them)."""
    p = event_time(plays, ts_col).withWatermark(ts_col, delay)
    return pane_counts(p, [], length, slide, ts_col, {
        "plays": (F.count(F.lit(1)), F.sum), "mobile_plays": (F.sum("ismobile"), F.sum),
        # mergeable sketches: those of a window's panes are united
        "approx_customers": (F.hll_sketch_agg("customer_id"),
                             lambda c: F.hll_sketch_estimate(F.hll_union_agg(c)))})


def windowed_top_n_stream(df: DataFrame, out_path: str, group: list[str], item: str, length: str,
                          slide: str | None = None, n: int = 10, delay: str = "10 minutes",
                          checkpoint: str | None = None, trigger: dict | None = None,
                          ts_col: str = "datetime", count_col: str = "plays"):
    """Top ``n`` values of ``item`` per ``group`` in each event-time window.

    Counts per (window, group, item) are kept in state until the watermark passes
    the window end; the finished windows of a batch are ranked in ``foreachBatch``
    (per window and group, partial group limit before the shuffle) and written
    idempotently per batch id as flat rows.  ``slide`` None means tumbling windows.
    """
    e = event_time(df.filter(F.col(item).isNotNull()), ts_col).withWatermark(ts_col, delay)
    counts = pane_counts(e, [*group, item], length, slide, ts_col, {count_col: (F.count(F.lit(1)), F.sum)})

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            ranked = top_n_per_group(batch, ["window_start", "window_end", *group],
                                     [F.desc(count_col), F.asc(item)], n, rank_col="rank")
            write_batch_output(ranked, out_path, batch_id)
        finally:
            batch.unpersist()

    return start(counts, handle, checkpoint, trigger or {"processingTime": slide or length})


def top_tracks_by_gender_stream(enriched: DataFrame, out_path: str, length: str = "30 hours",
                                slide: str = "1 hour", n: int = 10, delay: str = "10 minutes",
                                checkpoint: str | None = None, trigger: dict | None = None,
                                ts_col: str = "datetime"):
    """Top ``n`` tracks per gender in each sliding window of ``length`` (every ``slide``)."""
    return windowed_top_n_stream(enriched.filter(F.col("gender").isNotNull()), out_path, ["gender"],
                                 "track_id", length, slide, n, delay, checkpoint, trigger, ts_col)


def level_gender_trend_stream(enriched: DataFrame, out_path: str, bucket: str = "1 hour", size: int = 5,
                              delay: str = "10 minutes", checkpoint: str | None = None,
                              trigger: dict | None = None, ts_col: str = "datetime"):
    """Plays per membership level, time bucket and gender (top ``size`` genders per
    level and bucket) on a stream.  Unlike the batch form it keeps every level: the
    top levels over all time are never final on an unbounded stream."""
    return windowed_top_n_stream(enriched.filter(F.col("Level").isNotNull()), out_path, ["Level"],
                                 "gender", bucket, None, size, delay, checkpoint, trigger, ts_col)
