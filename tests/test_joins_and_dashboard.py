import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from beatstream.operators import dashboard as D
from beatstream.operators import joins as J
from beatstream.operators import windows as W
from beatstream.schemas import CUSTOMERS

T0 = dt.datetime(2014, 10, 15, 18, 0, 0)


def plays_df(spark, rows):
    return spark.createDataFrame(rows, "event_id long, customer_id long, track_id long, datetime timestamp_ntz, "
                                       "ismobile int, listening_zip_code string")


def customers_df(spark, ages):
    rows = [(i, f"n{i}", a, str(i % 2), "1", "addr", "01/13/2013", "1", str(i % 3), "c", str(i % 2))
            for i, a in enumerate(ages)]
    return spark.createDataFrame(rows, CUSTOMERS)


def test_enrich_on_missing_policies(spark):
    plays = plays_df(spark, [(0, 0, 1, T0, 1, "1"), (1, 99, 1, T0, 0, "1")])
    cust = customers_df(spark, [30])
    kept = J.enrich_with_customer(plays, cust, "null").orderBy("event_id").collect()
    assert [r.name for r in kept] == ["n0", None]
    assert J.enrich_with_customer(plays, cust, "drop").count() == 1
    with pytest.raises(Exception, match="no customer for key 99"):
        J.enrich_with_customer(plays, cust, "fail").collect()
    missing = J.missing_customers(plays, cust).collect()
    assert [(r.customer_id, r.plays) for r in missing] == [(99, 1)]


def test_ingest_time_column(spark):
    plays = plays_df(spark, [(0, 0, 1, T0, 1, "1")])
    out = J.enrich_with_customer(plays, customers_df(spark, [30]), ingest_time=True)
    assert out.first()["@timestamp"] is not None


def test_label_without_clicks_is_zero(spark):
    prof = spark.createDataFrame([(1,), (2,), (3,)], "customer_id long")
    clicks = spark.createDataFrame([(1, 2), (2, 0)], "customer_id long, clicks long")
    got = {r.customer_id: r.label for r in J.label_from_clicks(prof, clicks).collect()}
    assert got == {1: 1, 2: 0, 3: 0}


def test_is_member_modes_with_repeated_members(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "customer_id long")
    members = spark.createDataFrame([(1,), (1,), (3,)], "customer_id long")
    flag = {r.customer_id: r.is_member for r in J.is_member(df, members).collect()}
    assert flag == {1: 1, 2: 0, 3: 1}
    assert sorted(r[0] for r in J.is_member(df, members, how="semi").collect()) == [1, 3]
    assert sorted(r[0] for r in J.is_member(df, members, how="anti").collect()) == [2]


def test_range_bucket_edges_gaps_and_open_end(spark):
    cust = customers_df(spark, [7, 8, 39, 40, 49, 50, 0, 99])
    out = D.range_bucket(cust, "age", D.LEVEL_AGE_RANGES, "age_range")
    got = {r.age: r.age_range for r in out.collect()}
    assert got == {7: "0-8", 8: "8-14", 39: "30-40", 50: "50-*", 0: "0-8", 99: "50-*"}  # 40, 49 in the gap
    overlap = D.range_bucket(cust, "age", [(None, 10), (5, 45)], "r")
    assert overlap.filter(F.col("age") == 7).count() == 2


def test_terms_ties_by_key(spark):
    rows = [(i, 1, 1, T0, 1, z) for i, z in enumerate(["b", "a", "c", "a", "b", "d", None])]
    got = [(r.listening_zip_code, r["count"]) for r in D.terms(plays_df(spark, rows), "listening_zip_code", 3).collect()]
    assert got == [("a", 2), ("b", 2), ("c", 1)]


def brute_top_n(rows, n):
    by = {}
    for g, k, c in rows:
        by.setdefault(g, []).append((g, k, c))
    out = set()
    for g, items in by.items():
        for rank, (gg, k, c) in enumerate(sorted(items, key=lambda x: (-x[2], x[1]))[:n], 1):
            out.add((gg, k, c, rank))
    return out


def test_salted_top_n_equals_brute_force(spark):
    rnd = random.Random(7)
    # one hot group holding most rows, several small ones
    rows = [("hot", k, rnd.randint(1, 20)) for k in range(400)] + \
           [(f"g{g}", k, rnd.randint(1, 5)) for g in range(5) for k in range(rnd.randint(1, 9))]
    df = spark.createDataFrame(rows, "g string, k long, c long")
    for salt_by in (None, "k"):
        got = W.top_n_per_group(df, "g", [F.desc("c"), F.asc("k")], 5, salt_by=salt_by, salt_buckets=7)
        assert {(r.g, r.k, r.c, r["rank"]) for r in got.collect()} == brute_top_n(rows, 5)


def test_share_of_total_sums_to_one(spark):
    df = spark.createDataFrame([("a", "x", 3), ("a", "y", 1), ("b", "x", 5)], "g string, k string, count long")
    shares = W.share_of_total(df, "g").groupBy("g").agg(F.sum("share").alias("s")).collect()
    assert all(abs(r.s - 1.0) < 1e-12 for r in shares)
    total = W.share_of_total(df, None).agg(F.sum("share")).first()[0]
    assert abs(total - 1.0) < 1e-12


def test_nested_terms_inner_per_parent(spark):
    rows = []
    eid = 0
    for z, n_cust in [("z1", 7), ("z2", 3)]:
        for c in range(n_cust):
            for _ in range(c + 1):
                rows.append((eid, c, 1, T0, 1, z))
                eid += 1
    out = D.top_regions_and_users(plays_df(spark, rows), 5, 2).collect()
    got = sorted((r.listening_zip_code, r.customer_id, r.plays, r.customer_id_rank) for r in out)
    assert got == [("z1", 5, 6, 2), ("z1", 6, 7, 1), ("z2", 1, 2, 2), ("z2", 2, 3, 1)]


def test_since_uses_newest_time(spark):
    rows = [(i, 1, 1, T0 + dt.timedelta(minutes=i), 1, "1") for i in range(40)]
    got = D.since(plays_df(spark, rows), 15).count()
    assert got == 16  # minutes 24..39 inclusive


def test_mobile_trend_omits_empty_buckets(spark):
    rows = [(0, 1, 1, T0, 1, "1"), (1, 2, 1, T0 + dt.timedelta(minutes=5), 0, "1"),
            (2, 1, 1, T0 + dt.timedelta(hours=3), 1, "1")]
    got = sorted((r.bucket_start, r.mobile_connections, r.unique_customers)
                 for r in D.mobile_trend(plays_df(spark, rows)).collect())
    assert got == [(T0, 1, 2), (T0 + dt.timedelta(hours=3), 1, 1)]


def test_approx_users_close_to_exact(spark):
    rnd = random.Random(2)
    rows = [(i, rnd.randint(0, 5000), 1, T0 + dt.timedelta(minutes=rnd.randint(0, 180)), 1, "1")
            for i in range(20000)]
    df = plays_df(spark, rows)
    exact = {r.bucket_start: r.unique_customers for r in D.mobile_trend(df).collect()}
    approx = {r.bucket_start: r.approx_customers for r in D.approx_users(df, rsd=0.02).collect()}
    assert exact.keys() == approx.keys()
    for k, v in exact.items():
        assert abs(approx[k] - v) <= 4 * 0.02 * v  # a few standard errors


def test_auto_bucket_width_follows_the_span(spark):
    def width(minutes):
        rows = [(0, 1, 1, T0, 1, "1"), (1, 1, 1, T0 + dt.timedelta(minutes=minutes), 1, "1")]
        return spark.range(1).select(D.auto_width_seconds(plays_df(spark, rows))).first()[0]
    assert width(1) == 1          # 60 s span, 100 buckets -> 1 s
    assert width(15) == 10        # 900 s -> 10 s
    assert width(24 * 60) == 1800  # one day -> 30 min
    assert width(60 * 24 * 365 * 3) == 604800
    rows = [(i, i % 3, 1, T0 + dt.timedelta(minutes=7 * i), i % 2, "1") for i in range(100)]
    out = D.mobile_trend_auto(plays_df(spark, rows)).collect()
    assert sum(r.plays for r in out) == 100 and len(out) <= 100
