import datetime as dt
import random

from pyspark.sql import functions as F

from beatstream.operators import listening as L
from beatstream.operators import profile as PR
from beatstream.operators import windows as W

T0 = dt.datetime(2014, 10, 15, 0, 0, 0)
SCHEMA = ("event_id long, customer_id long, track_id long, datetime timestamp_ntz, "
          "ismobile int, listening_zip_code string")


def random_plays(n=600, seed=3, customers=6, tracks=3, span_minutes=600):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        t = T0 + dt.timedelta(seconds=rnd.randint(0, span_minutes * 60))
        rows.append((i, rnd.randint(0, customers - 1), rnd.randint(0, tracks - 1), t, rnd.randint(0, 1), "1"))
    # exact ties in time on one key, resolved by event id
    rows += [(n, 0, 0, T0, 1, "1"), (n + 1, 0, 0, T0, 0, "1"), (n + 2, 0, 0, T0, 1, "1")]
    return rows


def brute_kth_gap(rows, k, horizon_s):
    by = {}
    for r in rows:
        by.setdefault((r[1], r[2]), []).append(r)
    out = {}
    for items in by.values():
        items.sort(key=lambda r: (r[3], r[0]))
        for i, r in enumerate(items):
            gap = None
            if i >= k:
                g = (r[3] - items[i - k][3]).total_seconds()
                gap = g if g <= horizon_s else None
            out[r[0]] = gap
    return out


def test_kth_previous_gap_matches_brute_force(spark):
    rows = random_plays()
    df = spark.createDataFrame(rows, SCHEMA)
    for k, horizon in [(1, 600), (2, 1800), (3, 3600)]:
        got = {r.event_id: r.gap_seconds for r in
               W.kth_previous_gap(df, ["customer_id", "track_id"], k, horizon).collect()}
        assert got == brute_kth_gap(rows, k, horizon)


def test_repeat_listens_matches_brute_force(spark):
    rows = random_plays(n=300, span_minutes=2000)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.customer_id, r.track_id): r.first_detected for r in L.repeat_listens(df, 3, 1800).collect()}
    gaps = brute_kth_gap(rows, 2, 1800)
    exp = {}
    for r in rows:
        if gaps[r[0]] is not None:
            key = (r[1], r[2])
            exp[key] = min(exp.get(key, r[3]), r[3])
    assert got == exp and len(exp) > 0


def test_repeat_listens_bucket_boundary(spark):
    # three plays straddling a 30-minute bucket edge, 29 minutes apart end to end
    base = dt.datetime(2014, 10, 15, 10, 20, 0)
    rows = [(0, 1, 1, base, 0, "1"), (1, 1, 1, base + dt.timedelta(minutes=15), 0, "1"),
            (2, 1, 1, base + dt.timedelta(minutes=29), 0, "1"),
            (3, 2, 1, base, 0, "1"), (4, 2, 1, base + dt.timedelta(minutes=15), 0, "1"),
            (5, 2, 1, base + dt.timedelta(minutes=31), 0, "1")]
    got = L.repeat_listens(spark.createDataFrame(rows, SCHEMA), 3, 1800).collect()
    assert [(r.customer_id, r.first_detected) for r in got] == [(1, base + dt.timedelta(minutes=29))]


def test_profile_counts_sum_to_play_count(spark):
    df = spark.createDataFrame(random_plays(), SCHEMA)
    prof = PR.listening_profile(df)
    tot = prof.agg(F.sum(F.col("morn") + F.col("aft") + F.col("eve") + F.col("night"))).first()[0]
    assert tot == df.count()
    assert prof.agg(F.sum("mobile")).first()[0] == df.agg(F.sum("ismobile")).first()[0]


def test_profile_last_mode_uses_latest_play(spark):
    rows = [(0, 1, 5, T0.replace(hour=8), 0, "1"), (1, 1, 6, T0.replace(hour=23), 1, "1"),
            (2, 1, 5, T0.replace(hour=13), 0, "1")]
    r = PR.listening_profile(spark.createDataFrame(rows, SCHEMA), "last").first()
    assert (r.unique_tracks, r.morn, r.aft, r.eve, r.night, r.mobile) == (2, 0, 0, 0, 1, 1)


def test_feature_ratios_and_labels(spark):
    rows = [(0, 1, 5, T0.replace(hour=8), 1, "1"), (1, 1, 6, T0.replace(hour=9), 0, "1"),
            (2, 2, 5, T0.replace(hour=13), 0, "1")]
    clicks = spark.createDataFrame([(0, 1, "ADV_REDUCED_1DAY", T0), (1, 2, "ADV_FREE_REFERRAL", T0)],
                                   "EventID long, CustID long, AdClicked string, Localtime timestamp_ntz")
    f = {r.customer_id: r for r in PR.build_features(spark.createDataFrame(rows, SCHEMA), clicks).collect()}
    assert f[1].label == 1.0 and f[2].label == 0.0
    assert (f[1].morn, f[1].mobile, f[1].unique) == (1.0, 0.5, 1.0)
    assert (f[2].aft, f[2].unique) == (1.0, 1.0)


def test_daypart_average(spark):
    rows = [(0, 1, 5, T0.replace(hour=8), 1, "1"), (1, 1, 6, T0.replace(hour=9), 0, "1"),
            (2, 1, 5, (T0 + dt.timedelta(days=1)).replace(hour=20), 0, "1")]
    r = L.daypart_average(spark.createDataFrame(rows, SCHEMA)).first()
    assert r.active_days == 2 and r.morn_per_day == 1.0 and r.eve_per_day == 0.5
    assert r.favourite_daypart == "morn"


def test_sliding_counts_cover_each_row_len_over_slide_times(spark):
    df = spark.createDataFrame(random_plays(n=200), SCHEMA)
    stats = L.access_stats(df, "30 minutes", "5 minutes")
    assert stats.agg(F.sum("plays")).first()[0] == 6 * df.count()


def test_plays_by_customer_lists_are_time_ordered(spark):
    df = spark.createDataFrame(random_plays(n=100), SCHEMA)
    out = PR.plays_by_customer(df, "1 day")
    assert out.select(F.sum(F.size("plays"))).first()[0] == df.count()
    for r in out.collect():
        times = [p.datetime for p in r.plays]
        assert times == sorted(times)


def test_repeat_listens_carry_threshold_edges(spark):
    # 30-minute horizon: buckets are two hours wide ([08:00, 10:00) here) and rows from
    # 09:30 on are carried into the next bucket; the run ending at 10:00 needs 09:30.
    day = dt.datetime(2014, 10, 15)
    t = lambda h, m, s=0: day + dt.timedelta(hours=h, minutes=m, seconds=s)
    rows = [(0, 1, 1, t(9, 30), 0, "1"), (1, 1, 1, t(9, 45), 0, "1"), (2, 1, 1, t(10, 0), 0, "1"),
            (3, 2, 1, t(9, 29, 59), 0, "1"), (4, 2, 1, t(9, 45), 0, "1"), (5, 2, 1, t(10, 0), 0, "1"),
            (6, 3, 1, t(9, 50), 0, "1"), (7, 3, 1, t(10, 5), 0, "1"), (8, 3, 1, t(10, 20), 0, "1")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.customer_id, r.first_detected) for r in L.repeat_listens(df, 3, 1800).collect()}
    assert got == {(1, t(10, 0)), (3, t(10, 20))}
    gaps = {r.event_id: r.gap_seconds for r in
            W.kth_previous_gap(df, ["customer_id", "track_id"], 2, 1800).collect()}
    assert gaps == brute_kth_gap(rows, 2, 1800)


def test_plays_by_customer_lists_are_whole_and_ordered(spark):
    rows = random_plays(n=500, customers=2, span_minutes=60)
    df = spark.createDataFrame(rows, SCHEMA)
    got = PR.plays_by_customer(df, "30 minutes").collect()
    assert sorted(p.event_id for r in got for p in r.plays) == sorted(r[0] for r in rows)
    for r in got:
        assert [(p.datetime, p.event_id) for p in r.plays] == sorted((p.datetime, p.event_id) for p in r.plays)
        assert all(r.period_start <= p.datetime for p in r.plays)
