"""Wall-clock times survive zones with skipped and repeated hours."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from beatstream.functions import parse as P
from beatstream.functions import timeutil as TU
from beatstream.sources import testdata as T

# around both changes of the clock in New York and Berlin
HOURS = [dt.datetime(2024, m, d, h, mi) for m, d in ((3, 10), (3, 31), (10, 27), (11, 3)) for h in range(24) for mi in (0, 30)]


@pytest.fixture(params=["America/New_York", "Europe/Berlin"])
def zone(request, spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", old)


def test_conversions_are_one_to_one(spark, zone):
    df = spark.createDataFrame([(h + dt.timedelta(microseconds=7),) for h in HOURS], "t timestamp_ntz")
    back = df.select("t", TU.instant_to_ntz(TU.ntz_to_instant(F.col("t"))).alias("b"),
                     TU.ntz_micros(F.col("t")).alias("us")).collect()
    assert all(r.t == r.b for r in back)
    epoch = dt.datetime(1970, 1, 1)
    assert all(r.us == (r.t - epoch) // dt.timedelta(microseconds=1) for r in back)


def test_parsed_times_are_the_text(spark, zone):
    df = spark.createDataFrame([(str(h),) for h in HOURS], "t string")
    got = [str(r.p) for r in df.select(P.safe_timestamp(F.col("t")).alias("p")).collect()]
    assert got == [str(h) for h in HOURS]


def test_printed_log_lines_keep_the_time(spark, zone):
    ev = spark.createDataFrame([(i, h, 1, "view", 1.0, '{"k": 2}') for i, h in enumerate(HOURS)],
                               "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    plays = P.parse_plays(T.play_lines_from_events(ev)).orderBy("event_id").collect()
    assert [p.datetime for p in plays] == HOURS


def test_stream_windows_keep_their_labels(spark, zone, tmp_dir):
    from beatstream.streaming import flows as FL
    from beatstream.streaming.sinks import append_table
    ev = spark.createDataFrame([(i, h) for i, h in enumerate(HOURS)], "event_id long, ts timestamp_ntz")
    ev.coalesce(1).write.parquet(tmp_dir + "/ev")
    out = tmp_dir + "/out"
    FL.run_closed(spark.readStream.schema(ev.schema).parquet(tmp_dir + "/ev"), ev, "ts", lambda s, ck: append_table(
        FL.tumbling_counts(s, "1 hour", "ts", "0 seconds"), out, ck, {"availableNow": True}))
    got = {r.bucket_start: r.events for r in spark.read.parquet(out).collect()}
    assert got == {h: 2 for h in HOURS if h.minute == 0}
