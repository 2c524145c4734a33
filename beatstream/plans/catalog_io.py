"""Registered queries for sources, sinks, streams and models.

Sources are exercised by a round trip: the adapter's table is written to a fresh
folder below the shared checkpoint root and read back with the source under
test.  Streams run with ``availableNow`` over files derived from the test tables
and return the table their sink wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatstream.functions.parse import parse_plays
from beatstream.operators import model as M
from beatstream.operators import profile as PR
from beatstream.plans.derived import predictions
from beatstream.schemas import FEATURE_NAMES
from beatstream.session import rocksdb_state, shared_path
from beatstream.sources import files as FS
from beatstream.sources import testdata as T
from beatstream.streaming import flows as FL
from beatstream.streaming import metrics as MET
from beatstream.streaming.repeat import repeat_listens_stream
from beatstream.streaming.sinks import (
    append_table, read_keyed_table, read_set, set_add, set_value, upsert_by_key, write_batch_output,
)

AVAILABLE_NOW = {"availableNow": True}
FILES_PER_BATCH = 100  # play-log files that a micro-batch of the registered streams takes at most


def _write_csv(df: DataFrame, path: str, header: bool) -> None:
    (df.write.option("header", header).option("timestampNTZFormat", FS.CSV_TIME_FORMAT)
       .csv(path))


def _log_folder(spark: SparkSession, sf: str) -> str:
    """The play log as text files in a fresh folder (what the log collector reads)."""
    return T.play_log_folder(spark, sf)


# --- sources ------------------------------------------------------------------------------

def q_read_plays_file(spark, sf):
    return FS.read_plays_batch(spark, _log_folder(spark, sf))


def q_read_clicks_csv(spark, sf):
    path = shared_path(spark, "clicks-csv")
    _write_csv(T.clicks(spark, sf), path, header=False)
    return FS.read_clicks(spark, path)


def q_read_customers_csv(spark, sf):
    path = shared_path(spark, "customers-csv")
    cust = T.customers(spark, sf)
    # Write the columns in another order: the reader must take them by name.
    _write_csv(cust.select(*reversed(cust.columns)), path, header=True)
    return FS.read_customers(spark, path)


def q_read_music_csv(spark, sf):
    path = shared_path(spark, "music-csv")
    _write_csv(T.music(spark, sf), path, header=False)
    return FS.read_music(spark, path)


def q_read_retail_infer(spark, sf):
    """CSV with header and inferred schema, queried through SQL on a temp view."""
    path = shared_path(spark, "retail-csv")
    _write_csv(T.retail(spark, sf), path, header=True)
    FS.read_csv_infer(spark, path + "/*.csv", view="retail_csv")
    return spark.sql("""
        SELECT CAST(CustomerId AS BIGINT) AS CustomerId,
               window(CAST(InvoiceDate AS TIMESTAMP_NTZ), '1 day').start AS day_start,
               CAST(SUM(CAST(UnitPrice * Quantity AS DECIMAL(18, 2))) AS DOUBLE) AS total_cost
        FROM retail_csv
        GROUP BY CustomerId, window(CAST(InvoiceDate AS TIMESTAMP_NTZ), '1 day')""")


# --- keyed sinks ---------------------------------------------------------------------------

def q_upsert_customers(spark, sf):
    """Customers written by four overlapping sources in an order of arrival that is not their
    order of time: an old copy with other values comes last, and must not win."""
    path = shared_path(spark, "customer-store")
    cust = T.customers(spark, sf)
    stale = cust.select("customer_id", F.upper("name").alias("name"), F.lit(-1).alias("age"),
                        F.lit("old").alias("Campaign"), F.lit(1).alias("_seq"))
    person = cust.select("customer_id", "name", "age", "gender", F.lit("?").alias("Level"), F.lit(20).alias("_seq"))
    place = cust.select("customer_id", "zip", "Address", "SignDate", F.lit(30).alias("_seq"))
    contract = cust.select("customer_id", "Status", "Level", "Campaign", "LinkedWithApps", F.lit(25).alias("_seq"))
    for update in (place, contract, person, stale):
        merged = upsert_by_key(update, path, "customer_id", "_seq")
    return merged.select(*cust.columns)


def _store_predictions(spark: SparkSession, sf: str) -> str:
    """Predictions written to a keyed table: first all 0, then the real values
    (last write wins)."""
    path = shared_path(spark, "predictions")
    feats = PR.build_features(T.plays(spark, sf), T.clicks(spark, sf))
    first = feats.select("customer_id", F.lit(0).alias("pred"), F.lit(1).alias("_seq"))
    set_value(first, path, "customer_id", "pred", "_seq")
    real = feats.select("customer_id", F.col("label").cast("int").alias("pred"), F.lit(2).alias("_seq"))
    set_value(real, path, "customer_id", "pred", "_seq")
    return path


def q_set_predictions(spark, sf):
    return read_keyed_table(spark, _store_predictions(spark, sf))


# --- streams -------------------------------------------------------------------------------

def q_stream_parse_lines(spark, sf):
    """Tail the log folder, parse, append to a table (one file per micro-batch)."""
    lines = FS.read_play_lines_stream(spark, _log_folder(spark, sf), max_files_per_trigger=FILES_PER_BATCH)
    out = shared_path(spark, "plays-table")
    append_table(parse_plays(lines), out, trigger=AVAILABLE_NOW).awaitTermination()
    return spark.read.parquet(out)


def _flag_stream(spark: SparkSession, sf: str, pred_path: str) -> tuple[str, str]:
    """The real-time flow over the play log; customers and predictions are keyed tables that
    every micro-batch looks up anew.  Returns the paths of the records and the audience."""
    cust_path = shared_path(spark, "customers")
    upsert_by_key(T.customers(spark, sf).withColumn("_seq", F.lit(1)), cust_path, "customer_id", "_seq")
    lines = FS.read_play_lines_stream(spark, _log_folder(spark, sf), max_files_per_trigger=FILES_PER_BATCH)
    out, audience = shared_path(spark, "flagged-plays"), shared_path(spark, "audience")
    FL.ad_flag_stream(lines, FL.keyed_table(spark, cust_path), FL.keyed_table(spark, pred_path), out, audience,
                      trigger=AVAILABLE_NOW).awaitTermination()
    return out, audience


def _ad_flag_run(spark: SparkSession, sf: str) -> tuple[str, str]:
    """The flow with the click labels as predictions (they have an SQL form)."""
    pred_path = shared_path(spark, "predictions")
    set_value(predictions(spark, sf).withColumn("_seq", F.lit(1)), pred_path, "customer_id", "pred", "_seq")
    return _flag_stream(spark, sf, pred_path)


def _zero_predictions(spark: SparkSession, sf: str) -> tuple[DataFrame, str]:
    """Features, and a keyed prediction table that says 0 for every customer."""
    feats = M.written_features(PR.build_features(T.plays(spark, sf), T.clicks(spark, sf)))
    path = shared_path(spark, "predictions")
    set_value(feats.select("customer_id", F.lit(0).alias("pred"), F.lit(1).alias("_seq")), path, "customer_id",
              "pred", "_seq")
    return feats, path


def q_stream_model_flags(spark, sf):
    """Retrain, gate, publish, flag: the plays flagged with the published model's predictions."""
    feats, path = _zero_predictions(spark, sf)
    M.publish_if_accepted(feats, path, seq=2, threshold=1.0)  # any hold-out error is accepted here
    out, _ = _flag_stream(spark, sf, path)
    return spark.read.parquet(out).drop("@timestamp", "batch_id")


def q_rejected_model_changes_nothing(spark, sf):
    """A model whose error is beyond the gate is not published: all plays keep the old flag."""
    feats, path = _zero_predictions(spark, sf)
    M.publish_if_accepted(feats, path, seq=2, threshold=-1.0)  # no error is small enough
    out, _ = _flag_stream(spark, sf, path)
    return spark.read.parquet(out).groupBy("SendEvent").agg(F.count(F.lit(1)).alias("plays"))


def q_stream_ad_flags(spark, sf):
    out, _ = _ad_flag_run(spark, sf)
    return spark.read.parquet(out).drop("@timestamp", "batch_id")


def q_dashboard_on_index(spark, sf):
    """A dashboard over the table the real-time flow writes: app link by age range
    on the enriched play records (the index the dashboards read)."""
    from beatstream.operators.dashboard import applink_by_age
    out, _ = _ad_flag_run(spark, sf)
    return applink_by_age(spark.read.parquet(out))


def q_compact_index(spark, sf):
    """The streamed play records compacted from per-batch files into date partitions
    (the partition column is left out of the result; the rows are the records)."""
    from beatstream.streaming.sinks import compact_table
    out, _ = _ad_flag_run(spark, sf)
    return compact_table(spark, out, shared_path(spark, "index-compacted")).drop("@timestamp", "play_date")


def q_stream_audience(spark, sf):
    _, audience = _ad_flag_run(spark, sf)
    return read_set(spark, audience)


def _closed_events(spark, sf, begin) -> None:
    """Run a query over the events stream and close the input, so that all windows arrive."""
    FL.run_closed(T.events_stream(spark, sf), T.table(spark, sf, "events"), "ts", begin, at_once=True)


def q_stream_trending_tags(spark, sf):
    """Rows from the nested result; the user's handler gets the same rows of every batch."""
    out = shared_path(spark, "trending")
    seen = shared_path(spark, "trending-seen")
    _closed_events(spark, sf, lambda events, ck: FL.trending_tags_stream(
        T.messages_from_events(events), out, "60 minutes", "20 minutes", 10, "10 minutes", checkpoint=ck,
        trigger=AVAILABLE_NOW, handler=lambda ranked, batch: write_batch_output(ranked, seen, batch)))
    nested = spark.read.parquet(out)
    return nested.select("window_start", F.col("datetime").alias("window_end"),
                         F.posexplode("hashtags").alias("pos", "item")).select(
        "window_start", "window_end", (F.col("pos") + 1).alias("rank"),
        F.col("item.name").alias("tag"), F.col("item.occurrences").alias("amount"))


def q_stream_dedup(spark, sf):
    """Every event delivered twice (two subscriptions of one topic); duplicates dropped."""
    twice = T.events_stream(spark, sf).unionByName(T.events_stream(spark, sf))
    out = shared_path(spark, "dedup")
    dedup = FL.dedup_events(twice, "event_id", "ts", "1 hour").select("event_id", "user_id", "event_type")
    append_table(dedup, out, trigger=AVAILABLE_NOW).awaitTermination()
    return spark.read.parquet(out)


def q_stream_tumbling_counts(spark, sf):
    out = shared_path(spark, "tumbling")
    _closed_events(spark, sf, lambda events, ck: append_table(
        FL.tumbling_counts(events, "1 hour", "ts", "10 minutes", by=["event_type"]), out, ck, AVAILABLE_NOW))
    return spark.read.parquet(out)


def _dense(events: DataFrame) -> DataFrame:
    """Plays of a few tracks, crowded in time (every day's events within 48 minutes), so that
    30-minute repeat listens are frequent."""
    day = F.to_date("ts").cast("timestamp_ntz")
    crowded = day + F.make_dt_interval(secs=(F.pmod(F.col("event_id") * 7919, F.lit(2880))).cast("decimal(18,6)"))
    return (T.plays_from_events(events.withColumn("ts", crowded))
            .withColumn("track_id", F.when(F.col("track_id") % 7 != 0, F.col("track_id") % 2))
            .withColumn("customer_id", F.col("customer_id") % 50))


def q_repeat_listens_dense(spark, sf):
    """Repeat listens with the production parameters on crowded plays, some without a track."""
    from beatstream.operators.listening import repeat_listens
    return repeat_listens(_dense(T.table(spark, sf, "events")), 3, 30 * 60)


def q_stream_repeat_listens_dense(spark, sf):
    """The same on a stream; reported keys are also registered in the interest list, and the
    list's entries are what is returned with their times."""
    out, interests = shared_path(spark, "repeat-dense"), shared_path(spark, "interests")

    def begin(events, ck):
        with rocksdb_state(spark):
            return append_table(repeat_listens_stream(_dense(events), 3, 30 * 60, "1 day"), out, ck, AVAILABLE_NOW)

    _closed_events(spark, sf, begin)
    reports = spark.read.parquet(out)
    set_add(reports, interests, ["customer_id", "track_id"])
    return read_set(spark, interests).join(reports, ["customer_id", "track_id"])


def q_stream_repeat_listens(spark, sf):
    out = shared_path(spark, "repeat")

    def begin(events, ck):
        plays = T.plays_from_events(events).withColumn("track_id", F.col("track_id") % 5)
        with rocksdb_state(spark):
            return append_table(repeat_listens_stream(plays, 3, 24 * 3600, "1 day"), out, ck, AVAILABLE_NOW)

    _closed_events(spark, sf, begin)
    return spark.read.parquet(out)


def _progress_log(spark, sf) -> str:
    """Path of the progress log of a tumbling-count stream over the events."""
    log = shared_path(spark, "progress")
    listener = MET.ProgressLog(spark, log)
    spark.streams.addListener(listener)
    try:
        counts = FL.tumbling_counts(T.events_stream(spark, sf, max_files_per_trigger=1), "1 hour")
        query = FL.start(counts, sink="parquet", path=shared_path(spark, "tumbling-progress"), trigger=AVAILABLE_NOW)
        query.awaitTermination()
        if not listener.wait(query):
            raise RuntimeError("the stream's progress reports did not arrive")
    finally:
        spark.streams.removeListener(listener)
    return log


def q_stream_progress_metrics(spark, sf):
    """Progress of a tumbling-count stream as metric samples, rolled up per minute."""
    return MET.metric_rollup(MET.progress_samples(spark, _progress_log(spark, sf)), "1 minute")


def q_stream_progress_rows(spark, sf):
    """Input rows that the stream's progress reports add up to."""
    samples = MET.progress_samples(spark, _progress_log(spark, sf))
    return (samples.filter((F.col("metric") == "rows") & (F.col("attribute") == "input"))
            .agg(F.sum("value").cast("long").alias("input_rows")))


# --- models --------------------------------------------------------------------------------

def q_model_facts(spark, sf):
    """What must hold for any trained model: split sizes, one prediction per customer, error in 0..1."""
    preds, report = M.train_and_score(PR.build_features(T.plays(spark, sf), T.clicks(spark, sf)))
    return (preds.agg(F.count(F.lit(1)).alias("predictions"), F.countDistinct("customer_id").alias("customers"),
                      F.count_if(~F.col("pred").isin(0, 1)).alias("odd_predictions"))
            .withColumns({"train_rows": F.lit(report.train_rows), "test_rows": F.lit(report.test_rows),
                          "error_in_range": F.lit(0.0 <= report.error <= 1.0)}))


def q_train_and_score(spark, sf):
    feats = PR.build_features(T.plays(spark, sf), T.clicks(spark, sf))
    preds, _ = M.train_and_score(feats)
    return preds


def q_compare_models(spark, sf):
    feats = M.written_features(PR.build_features(T.plays(spark, sf), T.clicks(spark, sf)))
    reports = M.compare_models(M.assemble(feats))
    rows = [(r.setting, r.train_rows, r.test_rows, float(r.error), r.accepted) for r in reports]
    return spark.createDataFrame(rows, "setting string, train_rows long, test_rows long, "
                                       "error double, accepted boolean")


def q_libsvm_round_trip(spark, sf):
    path = shared_path(spark, "features-libsvm")
    FS.write_libsvm(PR.build_features(T.plays(spark, sf), T.clicks(spark, sf)), path)
    back = FS.read_libsvm(spark, path, 6)
    from pyspark.ml.functions import vector_to_array
    arr = vector_to_array(F.col("features"))
    return back.select("label", *[arr[i].alias(n) for i, n in enumerate(["morn", "aft", "eve", "night",
                                                                          "mobile", "unique"])])


def q_parse_libsvm_lines(spark, sf):
    """The training file read back as text and parsed line by line into vectors."""
    from pyspark.ml.functions import array_to_vector
    from beatstream.functions.parse import parse_libsvm_line
    path = shared_path(spark, "features-text")
    FS.write_libsvm(PR.build_features(T.plays(spark, sf), T.clicks(spark, sf)), path)
    parsed = spark.read.text(path).select(parse_libsvm_line(F.col("value"), 6).alias("p"))
    return parsed.select(F.col("p.label").alias("label"), array_to_vector("p.values").alias("features"))


def q_parse_libsvm_values(spark, sf):
    """The parsed lines' values as columns."""
    from pyspark.ml.functions import vector_to_array
    values = vector_to_array(F.col("features"))
    return q_parse_libsvm_lines(spark, sf).select("label", *[values[i].alias(n) for i, n in enumerate(FEATURE_NAMES)])


def q_compare_models_facts(spark, sf):
    """What must hold for the compared models: both sides' sizes, an error in 0..1, the gate's rule."""
    return q_compare_models(spark, sf).select(
        "setting", "train_rows", "test_rows", F.col("error").between(0, 1).alias("error_in_range"),
        (F.col("accepted") == (F.col("error") <= M.ACCEPT_ERROR)).alias("gate_followed"))


def q_stream_publish_lines(spark, sf):
    """Forward raw log lines unchanged to another sink (a text topic stand-in)."""
    lines = FS.read_play_lines_stream(spark, _log_folder(spark, sf))
    out = shared_path(spark, "forwarded")
    from beatstream.streaming.sinks import publish_lines
    publish_lines(lines, out, trigger=AVAILABLE_NOW).awaitTermination()
    return spark.read.text(out)


def q_stream_mobile_trend(spark, sf):
    """Hourly mobile connections and approximate unique customers on the play stream."""
    from beatstream.operators.dashboard import approx_users
    out = shared_path(spark, "mobile-trend")

    def begin(events, ck):
        plays = FL.event_time(T.plays_from_events(events), "datetime")
        trend = approx_users(plays.withWatermark("datetime", "10 minutes"), "1 hour")
        return append_table(trend.withColumn("bucket_start", FL.ntz(F.col("bucket_start"))), out, ck, AVAILABLE_NOW)

    _closed_events(spark, sf, begin)
    return spark.read.parquet(out)


def _within(approx: DataFrame, exact: DataFrame, share: float) -> DataFrame:
    """Exact columns, and whether the approximate count lies within ``share`` of the exact one."""
    both = exact.join(approx.select("bucket_start", "approx_customers"), "bucket_start", "left")
    near = F.abs(F.col("approx_customers") - F.col("unique_customers")) <= F.greatest(
        F.lit(2.0), share * F.col("unique_customers"))
    return both.withColumn("within", F.coalesce(near, F.lit(False))).drop("approx_customers")


def q_approx_users_bound(spark, sf):
    """Daily users: exact figures, and whether the approximate count is within 10 % of them."""
    from beatstream.operators.dashboard import approx_users, mobile_trend
    plays = T.plays(spark, sf)
    return _within(approx_users(plays, "1 day"), mobile_trend(plays, "1 day"), 0.1)


def q_stream_mobile_trend_bound(spark, sf):
    """The streamed hourly trend against the exact batch figures, within 10 %."""
    from beatstream.operators.dashboard import mobile_trend
    return _within(q_stream_mobile_trend(spark, sf), mobile_trend(T.plays(spark, sf), "1 hour"), 0.1)


def q_stream_access_stats(spark, sf):
    """Sliding 30-minute access statistics every 5 minutes on the play stream; the
    exact columns are returned (the approximate customer count is checked in tests)."""
    out = shared_path(spark, "access-stats")
    _closed_events(spark, sf, lambda events, ck: append_table(FL.access_stats_stream(
        T.plays_from_events(events), "30 minutes", "5 minutes", "10 minutes"), out, ck, AVAILABLE_NOW))
    return spark.read.parquet(out).select("window_start", "window_end", "plays", "mobile_plays")


def q_stream_top_tracks_by_gender(spark, sf):
    """Top 10 tracks per gender over 30-hour windows sliding every hour, on the
    play stream joined to the customer table."""
    from beatstream.operators.joins import enrich_with_customer
    cust_path = shared_path(spark, "customers")
    T.customers(spark, sf).write.parquet(cust_path)
    customers, out = spark.read.parquet(cust_path), shared_path(spark, "top-tracks")
    _closed_events(spark, sf, lambda events, ck: FL.top_tracks_by_gender_stream(
        enrich_with_customer(T.plays_from_events(events), customers), out, "30 hours", "1 hour", 10, "10 minutes",
        checkpoint=ck, trigger=AVAILABLE_NOW))
    return spark.read.parquet(out).drop("batch_id")


def q_stream_level_gender_trend(spark, sf):
    """Hourly plays per level and gender on the play stream joined to customers."""
    from beatstream.operators.joins import enrich_with_customer
    cust_path = shared_path(spark, "customers")
    T.customers(spark, sf).write.parquet(cust_path)
    customers, out = spark.read.parquet(cust_path), shared_path(spark, "level-gender")
    _closed_events(spark, sf, lambda events, ck: FL.level_gender_trend_stream(
        enrich_with_customer(T.plays_from_events(events), customers), out, "1 hour", 5, "10 minutes",
        checkpoint=ck, trigger=AVAILABLE_NOW))
    return spark.read.parquet(out).drop("batch_id")


IO_QUERIES = {
    "stream_model_flags": q_stream_model_flags,
    "rejected_model_changes_nothing": q_rejected_model_changes_nothing,
    "repeat_listens_dense": q_repeat_listens_dense,
    "stream_repeat_listens_dense": q_stream_repeat_listens_dense,
    "stream_progress_rows": q_stream_progress_rows,
    "model_facts": q_model_facts,
    "compare_models_facts": q_compare_models_facts,
    "parse_libsvm_values": q_parse_libsvm_values,
    "approx_users_bound": q_approx_users_bound,
    "stream_mobile_trend_bound": q_stream_mobile_trend_bound,
    "stream_level_gender_trend": q_stream_level_gender_trend,
    "compact_index": q_compact_index,
    "dashboard_on_index": q_dashboard_on_index,
    "stream_top_tracks_by_gender": q_stream_top_tracks_by_gender,
    "stream_access_stats": q_stream_access_stats,
    "parse_libsvm_lines": q_parse_libsvm_lines,
    "stream_publish_lines": q_stream_publish_lines,
    "stream_mobile_trend": q_stream_mobile_trend,
    "read_plays_file": q_read_plays_file,
    "read_clicks_csv": q_read_clicks_csv,
    "read_customers_csv": q_read_customers_csv,
    "read_music_csv": q_read_music_csv,
    "read_retail_infer": q_read_retail_infer,
    "upsert_customers": q_upsert_customers,
    "set_predictions": q_set_predictions,
    "stream_parse_lines": q_stream_parse_lines,
    "stream_ad_flags": q_stream_ad_flags,
    "stream_audience": q_stream_audience,
    "stream_trending_tags": q_stream_trending_tags,
    "stream_dedup": q_stream_dedup,
    "stream_tumbling_counts": q_stream_tumbling_counts,
    "stream_repeat_listens": q_stream_repeat_listens,
    "stream_progress_metrics": q_stream_progress_metrics,
    "train_and_score": q_train_and_score,
    "compare_models": q_compare_models,
    "libsvm_round_trip": q_libsvm_round_trip,
}
