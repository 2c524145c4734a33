"""Streaming = batch equivalence and sink idempotence, on small fixtures split into files."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from beatstream.operators import listening as L
from beatstream.operators import tags as TG
from beatstream.operators.windows import top_n_per_group
from beatstream.sources import files as FS
from beatstream.streaming import flows as FL
from beatstream.streaming import metrics as MET
from beatstream.streaming.repeat import repeat_listens_stream
from beatstream.streaming.sinks import (
    append_table, latest_version, read_keyed_table, read_set, set_add, set_value, upsert_by_key,
)

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)
NOW = {"availableNow": True}


def write_split(df, path, col, parts):
    """Write one file per time slice so that each micro-batch gets one slice."""
    for i, (lo, hi) in enumerate(parts):
        df.filter((F.col(col) >= lo) & (F.col(col) < hi)).coalesce(1).write.parquet(os.path.join(path, f"part{i}"))


def test_trending_tags_stream_equals_batch(spark, tmp_dir):
    rnd = random.Random(5)
    words = ["#Spark", "#spark!", "#kafka,", "##x", "#?", "plain", "#Flink."]
    rows = [(i, T0 + dt.timedelta(seconds=rnd.randint(0, 6 * 3600)),
             " ".join(rnd.choice(words) for _ in range(4))) for i in range(400)]
    msgs = spark.createDataFrame(rows, "msg_id long, ts timestamp_ntz, text string")
    src = os.path.join(tmp_dir, "msgs")
    cuts = [T0 + dt.timedelta(hours=h) for h in range(0, 8, 2)]
    write_split(msgs, src, "ts", list(zip(cuts, cuts[1:])))
    stream = spark.readStream.schema(msgs.schema).option("maxFilesPerTrigger", 1).parquet(src + "/*")
    out = os.path.join(tmp_dir, "out")
    FL.trending_tags_stream(stream, out, "60 minutes", "20 minutes", 3, "0 seconds",
                            checkpoint=os.path.join(tmp_dir, "ck"), trigger=NOW).awaitTermination()
    got = (spark.read.parquet(out)
           .select("window_start", F.posexplode("hashtags").alias("pos", "h"))
           .select("window_start", (F.col("pos") + 1).alias("rank"), "h.name", "h.occurrences").collect())
    got = {(r.window_start, r.rank, r.name, r.occurrences) for r in got}
    # batch: counts per sliding window, top 3 per window, windows closed by the final watermark
    from beatstream.functions.scalar import hashtags
    tags = hashtags(msgs, keep=["ts"])
    w = F.window("ts", "60 minutes", "20 minutes")
    counts = tags.groupBy(w.start.alias("window_start"), w.end.alias("window_end"), "tag").agg(
        F.count(F.lit(1)).alias("amount"))
    last = msgs.agg(F.max("ts")).first()[0]
    ranked = top_n_per_group(counts.filter(F.col("window_end") <= F.lit(last)), ["window_start"],
                             [F.desc("amount"), F.asc("tag")], 3)
    exp = {(r.window_start, r["rank"], r.tag, r.amount) for r in ranked.collect()}
    assert got == exp and len(exp) > 0


def test_repeat_listens_stream_equals_batch_with_out_of_order_files(spark, tmp_dir):
    rnd = random.Random(11)
    rows = [(i, rnd.randint(0, 3), rnd.randint(0, 1), T0 + dt.timedelta(minutes=rnd.randint(0, 600)), 0, "1")
            for i in range(250)]
    plays = spark.createDataFrame(rows, "event_id long, customer_id long, track_id long, "
                                        "datetime timestamp_ntz, ismobile int, listening_zip_code string")
    src = os.path.join(tmp_dir, "plays")
    # files in time order but each file slightly overlapping the previous one's range
    cuts = [T0 + dt.timedelta(minutes=m) for m in (0, 150, 300, 450, 601)]
    write_split(plays, src, "datetime", list(zip(cuts, cuts[1:])))
    stream = spark.readStream.schema(plays.schema).option("maxFilesPerTrigger", 1).parquet(src + "/*")
    out = os.path.join(tmp_dir, "out")
    q = append_table(repeat_listens_stream(stream, 3, 30 * 60, "2 hours"), out,
                     checkpoint=os.path.join(tmp_dir, "ck"), trigger=NOW)
    q.awaitTermination()
    got = {(r.customer_id, r.track_id, r.first_detected.replace(tzinfo=None))
           for r in spark.read.parquet(out).withColumn("first_detected",
                                                       F.col("first_detected").cast("timestamp_ntz")).collect()}
    exp = {(r.customer_id, r.track_id, r.first_detected) for r in L.repeat_listens(plays, 3, 1800).collect()}
    assert got == exp and len(exp) > 0


def test_dedup_stream_drops_redelivered_events(spark, tmp_dir):
    rows = [(i, T0 + dt.timedelta(minutes=i), i % 3, "view", 1.0, '{"k": 1}') for i in range(50)]
    ev = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, "
                                     "value double, props string")
    src = os.path.join(tmp_dir, "ev")
    ev.write.parquet(os.path.join(src, "a"))
    ev.filter(F.col("event_id") < 20).write.parquet(os.path.join(src, "b"))  # redelivery
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src + "/*")
    out = os.path.join(tmp_dir, "out")
    append_table(FL.dedup_events(stream, "event_id", "ts", "1 day"), out,
                 checkpoint=os.path.join(tmp_dir, "ck"), trigger=NOW).awaitTermination()
    assert spark.read.parquet(out).count() == 50


def test_set_add_is_idempotent(spark, tmp_dir):
    path = os.path.join(tmp_dir, "set")
    m = spark.createDataFrame([(1,), (2,), (2,)], "customer_id long")
    assert set_add(m, path, return_new=True).count() == 2
    assert set_add(m, path, return_new=True).count() == 0
    assert set_add(spark.createDataFrame([(3,), (1,)], "customer_id long"), path, return_new=True).count() == 1
    set_add(m, path)
    assert sorted(r[0] for r in read_set(spark, path).collect()) == [1, 2, 3]
    set_add(spark.createDataFrame([(1, 5), (None, 5), (1, 6)], "a long, b long"), path + "2", ["a", "b"])
    assert sorted(map(tuple, read_set(spark, path + "2").collect())) == [(1, 5), (1, 6)]


def test_upsert_last_write_wins_per_field(spark, tmp_dir):
    path = os.path.join(tmp_dir, "kv")
    upsert_by_key(spark.createDataFrame([(1, "a", 10, 1)], "k long, name string, age int, seq int"), path, "k", "seq")
    upsert_by_key(spark.createDataFrame([(1, None, 11, 2), (2, "b", None, 2)],
                                        "k long, name string, age int, seq int"), path, "k", "seq")
    got = {r.k: (r.name, r.age) for r in read_keyed_table(spark, path).collect()}
    assert got == {1: ("a", 11), 2: ("b", None)}
    # a repeated call gives the same table
    upsert_by_key(spark.createDataFrame([(1, None, 11, 2), (2, "b", None, 2)],
                                        "k long, name string, age int, seq int"), path, "k", "seq")
    assert {r.k: (r.name, r.age) for r in read_keyed_table(spark, path).collect()} == got


def test_upsert_does_not_depend_on_batching(spark, tmp_dir):
    writes = [(1, "a", None, 1), (1, None, 5, 5), (1, "b", None, 3), (1, "late", None, 2), (2, "x", 1, 4), (2, "y", 0, 4)]
    schema = "k long, name string, age int, seq int"
    results = []
    for i, parts in enumerate(([writes], [[w] for w in writes], [[w] for w in reversed(writes)])):
        path = os.path.join(tmp_dir, f"kv{i}")
        for part in parts:
            upsert_by_key(spark.createDataFrame(part, schema), path, "k", "seq", buckets=4)
        results.append({r.k: (r.name, r.age) for r in read_keyed_table(spark, path).collect()})
    # of two writes with one sequence number the larger value wins
    assert results == [{1: ("b", 5), 2: ("y", 1)}] * 3


def test_uncommitted_write_is_not_seen_and_only_touched_buckets_are_rewritten(spark, tmp_dir):
    path = os.path.join(tmp_dir, "kv")
    upsert_by_key(spark.createDataFrame([(i, f"n{i}", 1) for i in range(50)], "k long, name string, seq int"), path,
                  "k", "seq", buckets=8)
    # a write that died before its commit
    spark.createDataFrame([(1, "bad", 9)], "k long, name string, bucket int").write.partitionBy("bucket") \
        .parquet(path + "/write=1")
    assert latest_version(spark, path) == 0
    assert {r.k: r.name for r in read_keyed_table(spark, path).collect()} == {i: f"n{i}" for i in range(50)}
    upsert_by_key(spark.createDataFrame([(1, "new", 2)], "k long, name string, seq int"), path, "k", "seq")
    assert latest_version(spark, path) == 1
    assert len([d for d in os.listdir(path + "/write=1") if d.startswith("bucket=")]) == 1
    got = {r.k: r.name for r in read_keyed_table(spark, path).collect()}
    assert got == {i: "new" if i == 1 else f"n{i}" for i in range(50)}


def test_ad_flag_stream_replays_write_once(spark, tmp_dir):
    lines = ['0,1,5,"2015-02-01 08:00:05",1,"1"', '1,2,6,"2015-02-01 09:00:00",0,"2"', 'bad',
             '2,3,7,"2015-02-01 09:10:00",1,"3"']
    log = os.path.join(tmp_dir, "log")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(log)
    from beatstream.schemas import CUSTOMERS
    cust = spark.createDataFrame([(i, f"n{i}", 30, "0", "1", "a", "02/01/2012", "1", "0", "c", "1")
                                  for i in (1, 2)], CUSTOMERS)
    preds = spark.createDataFrame([(1, 1), (2, 0)], "customer_id long, pred int")
    out, aud, ck = (os.path.join(tmp_dir, x) for x in ("out", "aud", "ck"))
    for _ in range(2):  # second run: same checkpoint, nothing new, nothing doubled
        FL.ad_flag_stream(FS.read_play_lines_stream(spark, log), cust, preds, out, aud,
                          checkpoint=ck, trigger=NOW).awaitTermination()
    table = spark.read.parquet(out)
    assert table.columns[:6] == ["@timestamp", "customer_id", "track_id", "ismobile", "listening_zip_code", "name"]
    res = {r.customer_id: (r.name, r.SendEvent) for r in table.collect()}
    assert res == {1: ("n1", 1), 2: ("n2", 0), 3: (None, None)}
    assert [r[0] for r in read_set(spark, aud).collect()] == [1]


def test_lookups_follow_their_tables_between_batches(spark, tmp_dir):
    from beatstream.schemas import CUSTOMERS
    log, cust, pred, out, aud, ck = (os.path.join(tmp_dir, x) for x in ("log", "cust", "pred", "out", "aud", "ck"))

    def customers(name):
        return spark.createDataFrame([(i, name, 30, "0", "1", "a", "02/01/2012", "1", "0", "c", "1") for i in (1, 2)],
                                     CUSTOMERS).withColumn("_seq", F.lit(len(name)))

    def run(line):
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("append").text(log)
        FL.ad_flag_stream(FS.read_play_lines_stream(spark, log), FL.keyed_table(spark, cust), FL.keyed_table(spark, pred),
                          out, aud, checkpoint=ck, trigger=NOW).awaitTermination()

    def publish(value, seq):
        set_value(spark.createDataFrame([(1, value, seq), (2, value, seq)], "customer_id long, pred int, _seq int"),
                  pred, "customer_id", "pred", "_seq")

    upsert_by_key(customers("n"), cust, "customer_id", "_seq")
    publish(0, 1)
    run('0,1,5,"2015-02-01 08:00:05",1,"1"')
    upsert_by_key(customers("nn"), cust, "customer_id", "_seq")
    for seq in (2, 3, 4):  # several rewrites: older folders are gone by now
        publish(1, seq)
    run('1,2,5,"2015-02-01 08:00:06",1,"1"')  # restart from the checkpoint with new input
    got = {r.event_id: (r.customer_id, r.name, r.SendEvent) for r in spark.read.parquet(out).collect()}
    assert got == {0: (1, "n", 0), 1: (2, "nn", 1)}
    assert [r[0] for r in read_set(spark, aud).collect()] == [2]


def test_progress_listener_and_rollup(spark, tmp_dir):
    # minutes 0..30: the watermark (00:30) closes the windows up to 00:30, and the
    # event at 00:30 opens a window that append mode does not emit yet
    rows = [(i, T0 + dt.timedelta(minutes=i)) for i in range(31)]
    ev = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz")
    src = os.path.join(tmp_dir, "ev")
    ev.write.parquet(src)
    listener, log = MET.BatchListener(), MET.ProgressLog(spark, os.path.join(tmp_dir, "progress"), group=2)
    spark.streams.addListener(listener)
    spark.streams.addListener(log)
    try:
        stream = spark.readStream.schema(ev.schema).parquet(src)
        q = FL.start(FL.tumbling_counts(stream, "10 minutes", delay="0 seconds"), sink="memory",
                     query_name="t_progress", trigger=NOW, checkpoint=os.path.join(tmp_dir, "ck"))
        q.awaitTermination()
        assert log.wait(q)
        roll = MET.metric_rollup(MET.progress_samples(spark, os.path.join(tmp_dir, "progress")), "1 minute")
        metrics = {(r.metric, r.attribute) for r in roll.collect()}
        assert ("rows", "input") in metrics and ("duration_ms", "addBatch") in metrics
        assert any(m.startswith("state") for m, _ in metrics)
        assert any(e[0] == "progress" for e in listener.events)
        assert spark.sql("SELECT sum(events) FROM t_progress").first()[0] == 30
    finally:
        spark.streams.removeListener(listener)
        spark.streams.removeListener(log)


def test_progress_log_keeps_more_batches_than_spark(spark, tmp_dir):
    ev = spark.createDataFrame([(i, T0 + dt.timedelta(minutes=i)) for i in range(12)], "event_id long, ts timestamp_ntz")
    src, path = os.path.join(tmp_dir, "ev"), os.path.join(tmp_dir, "progress")
    for i in range(12):
        ev.filter(F.col("event_id") == i).coalesce(1).write.parquet(os.path.join(src, f"p{i}"))
    key = "spark.sql.streaming.numRecentProgressUpdates"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "3")
    log = MET.ProgressLog(spark, path, group=5)
    spark.streams.addListener(log)
    try:
        stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src + "/*")
        q = FL.start(stream, sink="noop", trigger=NOW, checkpoint=os.path.join(tmp_dir, "ck"))
        q.awaitTermination()
        assert log.wait(q)
        assert len(q.recentProgress) <= 3
    finally:
        spark.streams.removeListener(log)
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)
    rows = MET.progress_samples(spark, path).filter("metric = 'rows' and attribute = 'input'").collect()
    assert len({r.batch_id for r in rows}) == 12 and sum(r.value for r in rows) == 12


def test_tag_ranking_batch(spark):
    msgs = spark.createDataFrame([("#b #a #a #c #b #b",)], "text string")
    got = [(r.tag, r.amount) for r in TG.trending_tags_batch(msgs, 2).collect()]
    assert got == [("b", 3), ("a", 2)]


def test_publish_lines_console_and_run_for(spark, tmp_dir):
    from beatstream.streaming.sinks import console_debug, publish_lines
    log = os.path.join(tmp_dir, "log")
    spark.createDataFrame([("a,1",), ("b,2",)], "value string").write.text(log)
    out = os.path.join(tmp_dir, "fwd")
    publish_lines(FS.read_play_lines_stream(spark, log), out, checkpoint=os.path.join(tmp_dir, "ck"),
                  trigger=NOW).awaitTermination()
    assert sorted(r.value for r in spark.read.text(out).collect()) == ["a,1", "b,2"]
    q = console_debug(FS.read_play_lines_stream(spark, log), 100, trigger=NOW)
    FL.run_for(q, 0.5)
    assert not q.isActive
    q2 = FL.start(FS.read_play_lines_stream(spark, log), sink="memory", query_name="t_runfor",
                  checkpoint=os.path.join(tmp_dir, "ck2"))
    FL.run_for(q2, 0.05)  # processing-time trigger never ends by itself: stopped after 3 s
    assert not q2.isActive


def test_parse_libsvm_line(spark):
    from beatstream.functions.parse import parse_libsvm_line
    df = spark.createDataFrame([("0 1:0.00 2:0.00 3:0.00 4:1.00 5:0.00 6:1.00",),
                                ("1 1:0.28 3:0.23 6:0.97",)], "v string")
    rows = df.select(parse_libsvm_line(F.col("v")).alias("p")).collect()
    assert rows[0].p.label == 0.0 and rows[0].p["values"] == [0.0, 0.0, 0.0, 1.0, 0.0, 1.0]
    assert rows[1].p.label == 1.0 and rows[1].p["values"] == [0.28, 0.0, 0.23, 0.0, 0.0, 0.97]


def test_access_stats_stream_close_to_batch(spark, tmp_dir):
    rnd = random.Random(4)
    rows = [(i, rnd.randint(0, 300), 1, T0 + dt.timedelta(seconds=rnd.randint(0, 4 * 3600)), rnd.randint(0, 1), "1")
            for i in range(3000)]
    plays = spark.createDataFrame(rows, "event_id long, customer_id long, track_id long, "
                                        "datetime timestamp_ntz, ismobile int, listening_zip_code string")
    src = os.path.join(tmp_dir, "plays")
    plays.write.parquet(src)
    stream = spark.readStream.schema(plays.schema).parquet(src)
    out = os.path.join(tmp_dir, "out")
    append_table(FL.access_stats_stream(stream, "30 minutes", "5 minutes", "0 seconds"), out,
                 checkpoint=os.path.join(tmp_dir, "ck"), trigger=NOW).awaitTermination()
    got = {r.window_start: r for r in spark.read.parquet(out).collect()}
    exp = {r.window_start: r for r in L.access_stats(plays, "30 minutes", "5 minutes").collect()}
    assert got and set(got) <= set(exp)
    for k, r in got.items():
        assert (r.plays, r.mobile_plays) == (exp[k].plays, exp[k].mobile_plays)
        assert abs(r.approx_customers - exp[k].unique_customers) <= max(2, 0.15 * exp[k].unique_customers)


def test_compaction_is_whole_and_repeatable(spark, tmp_dir):
    from beatstream.streaming.sinks import compact_table, write_batch_output
    rows = [(i, T0 + dt.timedelta(hours=5 * i)) for i in range(40)]
    df = spark.createDataFrame(rows, "event_id long, datetime timestamp_ntz")
    src, dst = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "dst")
    for b in range(4):
        write_batch_output(df.filter(F.col("event_id") % 4 == b).repartition(6), src, b)
    files = lambda path: sum(f.endswith(".parquet") for _, _, fs in os.walk(path) for f in fs)
    for _ in range(2):  # a re-run replaces the same dates
        out = compact_table(spark, src, dst)
    assert out.count() == 40 and out.select("event_id").distinct().count() == 40
    dates = len({(T0 + dt.timedelta(hours=5 * i)).date() for i in range(40)})
    assert out.select("play_date").distinct().count() == dates
    assert files(dst) == dates < files(src)


def test_old_snapshots_are_dropped_and_the_newest_kept(spark, tmp_dir):
    path = os.path.join(tmp_dir, "kv")
    for seq in range(4):
        upsert_by_key(spark.createDataFrame([(1, f"v{seq}", seq)], "k long, name string, seq int"), path, "k", "seq")
    assert latest_version(spark, path) == 3
    assert len([f for f in os.listdir(path + "/_commits") if f.endswith(".json") and f[0] != "."]) == 2
    old = [d for d in ("write=0", "write=1") if os.path.isdir(f"{path}/{d}")
           and any(x.startswith("bucket=") for x in os.listdir(f"{path}/{d}"))]
    assert old == []
    assert read_keyed_table(spark, path).first().name == "v3"
    assert read_keyed_table(spark, os.path.join(tmp_dir, "missing")) is None


def test_repeat_listens_do_not_depend_on_arrival_order(spark, tmp_dir):
    schema = ("event_id long, customer_id long, track_id long, datetime timestamp_ntz, ismobile int, "
              "listening_zip_code string")

    def plays(minutes, start=0):
        return [(start + i, 1, 1, T0 + dt.timedelta(minutes=m), 0, "1") for i, m in enumerate(minutes)]

    rnd = random.Random(3)
    mixed = [(i, rnd.randint(0, 3), rnd.choice([0, 1, None]), T0 + dt.timedelta(minutes=rnd.randint(0, 600)), 0, "1")
             for i in range(300)]
    shuffled = sorted(mixed, key=lambda r: r[3] + dt.timedelta(minutes=rnd.randint(0, 100)))
    cases = [[plays([100, 110, 120]), plays([90, 95], 10)], [shuffled[i:i + 60] for i in range(0, 300, 60)]]
    for n, batches in enumerate(cases):
        src, out = os.path.join(tmp_dir, f"src{n}"), os.path.join(tmp_dir, f"out{n}")
        everything = spark.createDataFrame([r for b in batches for r in b], schema)
        for i, b in enumerate(batches):
            spark.createDataFrame(b, schema).coalesce(1).write.parquet(os.path.join(src, f"part{i}"))
            for f in os.listdir(os.path.join(src, f"part{i}")):
                os.utime(os.path.join(src, f"part{i}", f), (1e9 + i, 1e9 + i))  # files in this order
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src + "/*")
        FL.run_closed(stream, everything, "datetime", lambda s, ck, out=out: append_table(
            repeat_listens_stream(s, 3, 30 * 60, "2 hours"), out, ck, NOW))
        got = {(r.customer_id, r.track_id, r.first_detected) for r in spark.read.parquet(out).collect()}
        want = {(r.customer_id, r.track_id, r.first_detected) for r in L.repeat_listens(everything, 3, 1800).collect()}
        assert got == want and want
        assert all(t is not None for _, t, _ in got)
    assert (1, 1, T0 + dt.timedelta(minutes=100)) in {
        tuple(r) for r in spark.read.parquet(os.path.join(tmp_dir, "out0")).collect()}


def test_closed_run_delivers_every_window_and_the_handler_sees_them(spark, tmp_dir):
    rows = [(i, T0 + dt.timedelta(minutes=7 * i), "#a #b" if i % 2 else "#a") for i in range(40)]
    msgs = spark.createDataFrame(rows, "msg_id long, ts timestamp_ntz, text string")
    src, out = os.path.join(tmp_dir, "msgs"), os.path.join(tmp_dir, "out")
    msgs.write.parquet(src)
    seen = []
    FL.run_closed(spark.readStream.schema(msgs.schema).parquet(src), msgs, "ts", lambda s, ck: FL.trending_tags_stream(
        s, out, "60 minutes", "20 minutes", 3, "10 minutes", checkpoint=ck, trigger=NOW,
        handler=lambda ranked, batch: seen.extend((r.window_start, r.tag, r.amount) for r in ranked.collect())))
    got = {(r.window_start, h["name"], h["occurrences"]) for r in spark.read.parquet(out).collect() for h in r.hashtags}
    from beatstream.functions.scalar import hashtags
    w = F.window("ts", "60 minutes", "20 minutes")
    want = {tuple(r) for r in hashtags(msgs, keep=["ts"]).groupBy(w.start.alias("s"), "tag").count().collect()}
    assert got == want == set(seen) and len(seen) == len(want)


def test_level_gender_trend_stream_equals_batch_over_batches(spark, tmp_dir):
    from beatstream.operators import dashboard as D
    rnd = random.Random(8)
    rows = [(i, T0 + dt.timedelta(minutes=rnd.randint(0, 8 * 60)), rnd.choice(["0", "1", "2"]),
             rnd.choice(["0", "1", None])) for i in range(600)]
    df = spark.createDataFrame(rows, "event_id long, datetime timestamp_ntz, Level string, gender string")
    src = os.path.join(tmp_dir, "enriched")
    cuts = [T0 + dt.timedelta(hours=h) for h in (0, 3, 6, 9)]
    write_split(df, src, "datetime", list(zip(cuts, cuts[1:])))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src + "/*")
    out = os.path.join(tmp_dir, "out")
    FL.level_gender_trend_stream(stream, out, "1 hour", 5, "0 seconds", checkpoint=os.path.join(tmp_dir, "ck"),
                                 trigger=NOW).awaitTermination()
    got = {(r.window_start, r.Level, r.gender, r.plays, r["rank"]) for r in spark.read.parquet(out).collect()}
    last = df.agg(F.max("datetime")).first()[0]
    batch = D.level_gender_trend(df, "1 hour").filter(F.col("bucket_start") + F.expr("INTERVAL 1 HOUR") <= F.lit(last))
    exp = {(r.bucket_start, r.Level, r.gender, r.plays, r.gender_rank) for r in batch.collect()}
    assert got == exp and exp


HDFS_STATE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


@pytest.mark.parametrize("name", ["stream_repeat_listens", "stream_repeat_listens_dense", "stream_repeat_state"])
@pytest.mark.parametrize("provider", [None, HDFS_STATE])
def test_repeat_queries_run_in_a_session_without_rocksdb(spark, tmp_dir, name, provider):
    """A session with Spark's own state store: the queries bring theirs along and leave the setting as it was."""
    from beatstream.plans.catalog import QUERIES
    from beatstream.session import STATE_PROVIDER
    day = dt.datetime(2024, 1, 1)
    rows = [(i, day + dt.timedelta(minutes=10 * i), 1, "view", 1.0, '{"k": 3}') for i in range(1, 6)]
    rows += [(6, day + dt.timedelta(days=9), 2, "view", 1.0, '{"k": 3}'), (7, None, 1, "view", 1.0, '{"k": 3}')]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .coalesce(1).write.parquet(f"{tmp_dir}/events.parquet")
    own = spark.conf.get(STATE_PROVIDER)
    try:
        spark.conf.set(STATE_PROVIDER, provider) if provider else spark.conf.unset(STATE_PROVIDER)
        got = {tuple(r) for r in QUERIES[name](spark, tmp_dir).collect()}
        assert spark.conf.get(STATE_PROVIDER, None) == provider
    finally:
        spark.conf.set(STATE_PROVIDER, own)
    at = {i: day + dt.timedelta(seconds=i * 7919 % 2880) for i in range(1, 6)}  # as the dense query crowds them
    run = sorted(at.values())
    dense = next(c for a, c in zip(run, run[2:]) if c - a <= dt.timedelta(minutes=30))
    micros = lambda t: int(t.replace(tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    assert got == {"stream_repeat_listens": {(1, 3, rows[2][1])}, "stream_repeat_listens_dense": {(1, 1, dense)},
                   "stream_repeat_state": {("reported", 1, 3, micros(rows[4][1])), ("waiting", 2, 3, 1)}}[name]
