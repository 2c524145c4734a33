"""Top terms with bounds, plays that wait for their customers, observed metrics, triggers and run times."""

import datetime as dt
import os
import random
import time
from collections import Counter

from pyspark.sql import functions as F

from beatstream.streaming import flows as FL
from beatstream.streaming import metrics as MET
from beatstream.streaming import topterms as TT
from beatstream.streaming.sinks import console_debug
from tests.test_live import NOW, PLAYS, T0, portions, rows_of


def test_bounds_hold_while_terms_are_cut(spark, tmp_dir):
    rnd = random.Random(3)
    terms = [f"t{i:02d}" for i in range(60)]
    rows = [(rnd.choices(terms, [1 / (i + 1) for i in range(60)])[0] if rnd.random() < 0.95 else None,) for _ in range(900)]
    folder, path, ck = (os.path.join(tmp_dir, n) for n in ("in", "top", "ck"))
    for so_far in portions(spark, folder, rows, "term string", 3):
        stream = spark.readStream.schema("term string").parquet(folder)
        TT.keep_top_terms(stream, path, {"term": ["term"]}, 12, ck, NOW).awaitTermination()
        exact = Counter(t for t, in so_far if t is not None)
        got = TT.read_summary(spark, path, "term").collect()
        assert len(got) == 12
        floor = got[0].floor
        bounds = {r.term: (r.lower, r.upper) for r in got}
        for t, n in exact.items():
            low, high = bounds.get(t, (0, floor))
            assert low <= n <= high, (t, n, low, high)
    top = TT.top_terms(TT.read_summary(spark, path, "term"), ["term"], 3).orderBy("rank").collect()
    assert [r.term for r in top if r.certain] == [t for t, _ in sorted(exact.items(), key=lambda x: (-x[1], x[0]))][:sum(r.certain for r in top)]
    assert top[0].certain


def test_enough_capacity_counts_exactly_and_batches_repeat(spark):
    rows = spark.createDataFrame([("a", i % 3) for i in range(10)] + [("b", 0), (None, 1)], "z string, c int")
    one = TT.summarise(rows, ["z", "c"], 50)
    two = TT.merge(one, TT.summarise(rows.where("z = 'a'"), ["z", "c"], 50), ["z", "c"], 50)
    assert rows_of(two) == [("a", 0, 8, 8, 0), ("a", 1, 6, 6, 0), ("a", 2, 6, 6, 0), ("b", 0, 1, 1, 0)]
    nested = TT.nested_top_terms(TT.summarise(rows, ["z"], 50), two, "z", "c", 2).orderBy("z", "rank").collect()
    assert [(r.z, r.c, r.lower, r.outer_upper) for r in nested] == [("a", 0, 8, 10), ("a", 1, 6, 10), ("b", 0, 1, 1)]
    empty = TT.summarise(rows.limit(0), ["z"], 5)
    assert rows_of(TT.merge(empty, empty, ["z"], 5)) == []


CUSTOMER = ("customer_id long, name string, age int, gender string, zip string, Address string, SignDate string, "
            "Status string, Level string, Campaign string, LinkedWithApps string, known_since timestamp_ntz")


def test_plays_wait_for_their_customer(spark, tmp_dir):
    at = lambda m: T0 + dt.timedelta(minutes=m)
    play = lambda i, c, m: (i, c, 1, at(m), 0, "z")
    cust = lambda c, m: (c, f"n{c}", 30, "0", "z", "a", "d", "1", "2", "c", "1", at(m))
    plays, customers, out, ck = (os.path.join(tmp_dir, n) for n in ("plays", "customers", "out", "ck"))
    steps = [([play(1, 1, 0), play(2, 2, 5), play(3, 3, 5), play(4, None, 6)], [cust(1, 0)]),
             ([play(5, 1, 20)], [cust(2, 30)]),                    # arrives after its play, in time
             ([play(6, 2, 100), play(7, 4, 100)], [cust(3, 90)]),  # too late for the play at 5
             ([play(8, None, 10**6)], [cust(9, 10**6)])]
    seen = []
    for p, c in steps:
        spark.createDataFrame(p, PLAYS).write.mode("append").parquet(plays)
        spark.createDataFrame(c, CUSTOMER).write.mode("append").parquet(customers)
        stream = FL.enrich_waiting(spark.readStream.schema(PLAYS).parquet(plays),
                                   spark.readStream.schema(CUSTOMER).parquet(customers), "60 MINUTES", "0 minutes")
        (stream.writeStream.format("parquet").option("checkpointLocation", ck).trigger(**NOW).start(out)).awaitTermination()
        seen.append({r.event_id: r.name for r in spark.read.parquet(out).collect()})
    assert seen[0] == {1: "n1"} and seen[1][2] == "n2" and 3 not in seen[1]
    assert seen[-1] == {1: "n1", 2: "n2", 3: None, 4: None, 5: "n1", 6: "n2", 7: None}


def test_observed_metrics_add_up_over_batches(spark, tmp_dir):
    lines = [f'{i},{i % 4},7,"2024-01-01 00:00:{i:02d}",1,"z"' if i % 5 else f"{i},broken" for i in range(40)]
    folder, log = os.path.join(tmp_dir, "lines"), os.path.join(tmp_dir, "log")
    for i in range(4):
        spark.createDataFrame([(x,) for x in lines[i * 10:i * 10 + 10]], "value string").coalesce(1).write.mode("append").text(folder)
    customers = spark.createDataFrame([(c, f"n{c}", 30, "0", "z", "a", "d", "1", "2", "c", "1") for c in (0, 1, 2)],
                                      CUSTOMER.rsplit(",", 1)[0])
    preds = spark.createDataFrame([(1, 1), (2, 0)], "customer_id long, pred int")
    listener = MET.ProgressLog(spark, log)
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(folder)
        query = FL.start(FL.observed_flags(stream, customers, preds, "t"), path=os.path.join(tmp_dir, "out"), trigger=NOW)
        query.awaitTermination()
        assert listener.wait(query)
    finally:
        spark.streams.removeListener(listener)
    samples = MET.progress_samples(spark, log).where(F.col("metric").startswith("t_"))
    assert samples.select("batch_id").distinct().count() >= 4
    total = {r.attribute: r.s for r in samples.groupBy("attribute").agg(F.sum("value").alias("s")).collect()}
    good = [i for i in range(40) if i % 5]
    assert total["lines"] == 40 and total["quarantined"] == 8 and total["plays"] == len(good)
    assert total["missing_customers"] == sum(i % 4 == 3 for i in good) and total["flagged"] == sum(i % 4 == 1 for i in good)
    assert total["event_lag_seconds"] > 0


def test_rollup_of_fixed_samples(spark):
    rows = [(T0 + dt.timedelta(seconds=s), "q", "rows", "input", v) for s, v in ((0, 1.0), (30, 4.0), (59, 1.0), (60, 10.0))]
    samples = spark.createDataFrame(rows, "ts timestamp, alias string, metric string, attribute string, value double")
    got = MET.metric_rollup(samples, "1 minute").orderBy("bucket_start").collect()
    assert [(r.avg_value, r.max_value, r.samples) for r in got] == [(2.0, 4.0, 3), (10.0, 10.0, 1)]


def test_run_for_stops_and_triggers_repeat(spark, tmp_dir):
    rate = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    query = FL.start(rate, path=os.path.join(tmp_dir, "out"), trigger={"processingTime": "1 second"})
    began = time.time()
    FL.run_for(query, minutes=4 / 60)
    assert not query.isActive and 3 <= time.time() - began < 60 and query.lastProgress is not None
    spark.createDataFrame([("one",), ("two",)], "value string").write.text(os.path.join(tmp_dir, "in"))
    shown = console_debug(spark.readStream.format("text").load(os.path.join(tmp_dir, "in")), 1, NOW)
    shown.awaitTermination()
    assert sum(p.numInputRows for p in shown.recentProgress) == 2


def test_closed_at_once_equals_closed_in_two_runs(spark, tmp_dir):
    rows = [(i, T0 + dt.timedelta(minutes=7 * i), "x") for i in range(30)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, kind string")
    src = os.path.join(tmp_dir, "src")
    df.write.parquet(src)
    got = []
    for at_once in (True, False):
        out = os.path.join(tmp_dir, f"out{at_once}")
        FL.run_closed(spark.readStream.schema(df.schema).parquet(src), df, "ts", lambda s, ck: FL.start(
            FL.tumbling_counts(s, "1 hour", by=["kind"]), checkpoint=ck, path=out, trigger=NOW), at_once)
        got.append(rows_of(spark.read.parquet(out)))
    assert got[0] == got[1] and sum(r[-1] for r in got[0]) == 30


def test_batch_listener_keeps_the_latest_events(spark, tmp_dir, capsys):
    spark.createDataFrame([("one",), ("two",)], "value string").write.text(os.path.join(tmp_dir, "in"))
    listener, log = MET.BatchListener(echo=True, keep=50), MET.ProgressLog(spark, os.path.join(tmp_dir, "log"))
    spark.streams.addListener(listener)
    spark.streams.addListener(log)
    try:
        query = FL.start(spark.readStream.format("text").load(os.path.join(tmp_dir, "in")), path=os.path.join(tmp_dir, "out"),
                         trigger=NOW, query_name="echoed")
        query.awaitTermination()
        assert log.wait(query)
        until = time.time() + 30
        while not any(e[0] == "terminated" for e in listener.events) and time.time() < until:
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
        spark.streams.removeListener(log)
    mine = [e for e in listener.events if e[1] == str(query.id)]
    assert mine[0][0] == "started" and mine[0][2] == {"name": "echoed"} and mine[-1][0] == "terminated"
    assert sum(e[2]["rows"] for e in mine if e[0] == "progress") == 2
    assert "[batchCompleted] 0" in capsys.readouterr().out


def test_ingest_time_is_now(spark):
    from beatstream.operators.joins import enrich_with_customer
    customers = spark.createDataFrame([(1, "n", 30, "0", "z", "a", "d", "1", "2", "c", "1")], CUSTOMER.rsplit(",", 1)[0])
    plays = spark.createDataFrame([(1, 1, 1, T0, 0, "z"), (2, 9, 1, T0, 0, "z")], PLAYS)
    before = dt.datetime.now(dt.UTC).replace(tzinfo=None) - dt.timedelta(seconds=1)
    rows = enrich_with_customer(plays, customers, ingest_time=True).collect()
    after = dt.datetime.now(dt.UTC).replace(tzinfo=None) + dt.timedelta(seconds=1)
    assert len(rows) == 2 and all(before <= r["@timestamp"] <= after for r in rows)
    assert "@timestamp" not in enrich_with_customer(plays, customers).columns
