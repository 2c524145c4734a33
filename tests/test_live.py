"""Tables kept up to date on streams, keyed tables whose writes follow the batch, rollups."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from beatstream.operators import dashboard as D
from beatstream.operators import profile as PR
from beatstream.operators import rollup as R
from beatstream.streaming import live
from beatstream.streaming.sinks import (
    _commits, add_by_key, compact_table, read_keyed_table, read_set, set_add, upsert_by_key, write_batch_output,
)

T0 = dt.datetime(2024, 1, 1)
NOW = {"availableNow": True}
ENRICHED = "event_id long, datetime timestamp_ntz, Level string, gender string, age int, LinkedWithApps string"
PLAYS = "event_id long, customer_id long, track_id long, datetime timestamp_ntz, ismobile int, listening_zip_code string"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def portions(spark, folder, rows, schema, parts):
    """Write ``rows`` in ``parts`` portions; yields the rows so far."""
    for i in range(parts):
        part = rows[len(rows) * i // parts:len(rows) * (i + 1) // parts]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
        yield rows[:len(rows) * (i + 1) // parts]


def test_dashboards_are_right_after_every_batch_and_replays_change_nothing(spark, tmp_dir):
    rnd = random.Random(4)
    rows = sorted(((i, T0 + dt.timedelta(minutes=rnd.randint(0, 600)), rnd.choice(["0", "1", "2", None]), rnd.choice(["0", "1", None]),
                    rnd.choice([None, 3, 17, 30, 44, 71]), rnd.choice(["0", "1", None])) for i in range(400)), key=lambda r: r[1])
    folder, a, b, c = (os.path.join(tmp_dir, n) for n in "fabc")
    for so_far in portions(spark, folder, rows, ENRICHED, 2):
        stream = spark.readStream.schema(ENRICHED).parquet(folder)
        live.live_level_gender(stream, a, "1 hour", "1 hour", checkpoint=a + "-ck", trigger=NOW).awaitTermination()
        live.live_applink_by_age(stream, b, checkpoint=b + "-ck", trigger=NOW).awaitTermination()
        batch = spark.createDataFrame(so_far, ENRICHED)
        want = rows_of(D.level_gender_trend(batch, "1 hour"))
        assert rows_of(live.read_level_gender(spark, a).select(*D.level_gender_trend(batch, "1 hour").columns)) == want
        by_age = D.applink_by_age(batch)
        assert rows_of(live.read_by_age(spark, b, "LinkedWithApps").select(*by_age.columns)) == rows_of(by_age)
    # the same totals again, as a batch that is repeated after a failure writes them
    totals = read_keyed_table(spark, a)
    before = rows_of(totals)
    upsert_by_key(totals.withColumn("_seq", F.lit(1)), a, ["Level", "bucket_start", "gender"], "_seq", null_keys=True)
    assert rows_of(read_keyed_table(spark, a)) == before and before


def test_profiles_equal_the_batch_after_every_batch(spark, tmp_dir):
    rnd = random.Random(5)
    rows = [(i, rnd.choice([1, 2, 3, 4, None]), rnd.choice([7, 8, 9, None]), T0 + dt.timedelta(minutes=rnd.randint(0, 3000)),
             rnd.randint(0, 1), "z") for i in range(300)]
    clicks = [(i, rnd.choice([1, 2, 9]), rnd.choice(["ADV_REDUCED_1DAY", "x"]), T0) for i in range(40)]
    schema = "EventID long, CustID long, AdClicked string, Localtime timestamp_ntz"
    folder, more, path, ck = (os.path.join(tmp_dir, n) for n in ("plays", "clicks", "profiles", "ck"))
    for plays, clicked in zip(portions(spark, folder, rows, PLAYS, 2), portions(spark, more, clicks, schema, 2), strict=True):
        for q in [*live.keep_profiles(spark.readStream.schema(PLAYS).parquet(folder), path, ck, NOW),
                  live.keep_clicks(spark.readStream.schema(schema).parquet(more), path, ck, NOW)]:
            q.awaitTermination()
        batch = spark.createDataFrame(plays, PLAYS).where("customer_id is not null")
        want = PR.build_features(batch, spark.createDataFrame(clicked, schema))
        assert rows_of(live.read_features(spark, path).select(*want.columns)) == rows_of(want)


def test_counters_are_added_once_per_batch(spark, tmp_dir):
    path = os.path.join(tmp_dir, "sums")
    delta = lambda n: spark.createDataFrame([(1, n), (2, 1), (None, 5)], "k long, n long")
    for batch in (0, 1, 1, 0, 2):
        add_by_key(delta(10), path, "k", "w", batch)
    add_by_key(spark.createDataFrame([(1, 4)], "k long, m long"), path, "k", "other", 0)
    assert rows_of(read_keyed_table(spark, path).select("k", "n", "m")) == [(1, 30, 4), (2, 3, None)]


def test_a_write_rewrites_what_follows_its_size(spark, tmp_dir):
    """500 random keys into 20,000: only their own rows are written, the large folders stay."""
    path = os.path.join(tmp_dir, "kv")
    base = spark.range(20_000).select(F.col("id").alias("k"), F.lit("a").alias("v"), F.lit(1).alias("seq"))
    upsert_by_key(base, path, "k", "seq", buckets=16)
    rnd, value = random.Random(2), {i: "a" for i in range(20_000)}
    written = []
    for step in range(4):
        keys = rnd.sample(range(20_000), 500)
        value |= {k: f"s{step}" for k in keys}
        upsert_by_key(spark.createDataFrame([(k, f"s{step}", step + 2) for k in keys], "k long, v string, seq int"), path, "k", "seq")
        version, commit = _commits(spark, path)[-1]
        written.append(sum(n for parts in commit["buckets"].values() for w, n in parts if w == version))
        assert all(parts[0][0] == 0 for parts in commit["buckets"].values())  # the first load's folders are still in use
    assert max(written) <= 4 * 500 and written[0] == 500
    assert {r.k: r.v for r in read_keyed_table(spark, path).collect()} == value
    # many small writes of one key: few folders, one value
    for step in range(20):
        upsert_by_key(spark.createDataFrame([(7, f"t{step}", 100 + step)], "k long, v string, seq int"), path, "k", "seq")
    assert max(len(parts) for parts in _commits(spark, path)[-1][1]["buckets"].values()) <= 8
    assert read_keyed_table(spark, path).where("k = 7").first().v == "t19"


def test_old_commits_stay_while_they_are_young(spark, tmp_dir):
    path = os.path.join(tmp_dir, "kv")
    one = lambda v, seq: spark.createDataFrame([(1, v, seq)], "k long, v string, seq int")
    upsert_by_key(one("a", 1), path, "k", "seq", keep_seconds=3600)
    old = read_keyed_table(spark, path)  # planned on the first commit
    for seq in range(2, 6):
        upsert_by_key(one(f"v{seq}", seq), path, "k", "seq", keep_seconds=3600)
    assert old.first().v == "a" and read_keyed_table(spark, path).first().v == "v5"
    upsert_by_key(one("z", 9), path, "k", "seq")
    assert len(_commits(spark, path)) == 2


def test_sets_grow_by_their_new_members(spark, tmp_dir):
    path = os.path.join(tmp_dir, "set")
    rnd, members = random.Random(1), set()
    for _ in range(6):
        part = [(rnd.randint(0, 300),) for _ in range(80)]
        fresh = {x for x, in part} - members
        members |= fresh
        new = set_add(spark.createDataFrame(part, "customer_id long"), path, return_new=True)
        assert {r[0] for r in new.collect()} == fresh
    assert sorted(r[0] for r in read_set(spark, path).collect()) == sorted(members)


def test_compaction_takes_only_new_batches(spark, tmp_dir):
    src, dst = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "dst")
    day = lambda i: spark.createDataFrame([(i, T0 + dt.timedelta(days=i))], "event_id long, datetime timestamp_ntz")
    for i in range(3):
        write_batch_output(day(i), src, i)
    assert compact_table(spark, src, dst).count() == 3
    first = {os.path.join(d, f) for d, _, fs in os.walk(dst) for f in fs if f.endswith(".parquet")}
    write_batch_output(day(7), src, 3)
    os.makedirs(os.path.join(src, "batch_id=4"))  # a batch that isn't finished
    assert rows_of(compact_table(spark, src, dst).select("event_id")) == [(0,), (1,), (2,), (7,)]
    second = {os.path.join(d, f) for d, _, fs in os.walk(dst) for f in fs if f.endswith(".parquet")}
    assert first < second and all("play_date=2024-01-08" in f for f in second - first)


def test_rollup_answers_wider_buckets_without_the_plays(spark, tmp_dir):
    rnd = random.Random(6)
    rows = [(i, rnd.randint(1, 3000), 1, T0 + dt.timedelta(minutes=rnd.randint(0, 4 * 1440 - 1)), rnd.randint(0, 1), "z")
            for i in range(6000)]
    path = os.path.join(tmp_dir, "rollup")
    plays = spark.createDataFrame(rows, PLAYS)
    for i in range(2):
        R.append_rollup(plays.where(F.col("event_id") % 2 == i), path, i)
    R.append_rollup(plays.where(F.col("event_id") % 2 == 1), path, 1)  # a repeated batch
    rollup = R.read_rollup(spark, path)
    for width in ("1 hour", "6 hours", "2 days"):
        trend = R.trend_from_rollup(rollup, width)
        exact = {r.bucket_start: r for r in D.mobile_trend(plays, width).collect()}
        got = {r.bucket_start: r for r in trend.collect()}
        assert got.keys() == exact.keys()
        for k, r in got.items():
            assert r.mobile_connections == exact[k].mobile_connections
            assert abs(r.approx_customers - exact[k].unique_customers) <= max(1, 0.05 * exact[k].unique_customers)
        plan = trend._jdf.queryExecution().executedPlan().toString()
        assert "customers" in plan and "customer_id" not in plan
    assert R.trend_auto(rollup, 10).count() == 8 and R.trend_auto(rollup, 100).count() == len(
        {r[3].replace(minute=0) for r in rows})
    with pytest.raises(ValueError):
        R.trend_from_rollup(rollup, "90 minutes")
