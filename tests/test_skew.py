"""A customer holding a third of all plays: results stay whole and exact, and the
customer lookup is split by AQE's skew-join handling instead of landing in one task."""

import contextlib
import datetime as dt
import io
import random

from beatstream.operators import joins as J
from beatstream.operators import listening as L
from beatstream.operators import profile as PR
from beatstream.schemas import CUSTOMERS

T0 = dt.datetime(2024, 1, 1)
SCHEMA = ("event_id long, customer_id long, track_id long, datetime timestamp_ntz, "
          "ismobile int, listening_zip_code string")


def skewed_plays(spark, n=30000):
    rnd = random.Random(9)
    rows = []
    for i in range(n):
        cust = 0 if i % 3 == 0 else rnd.randint(1, 500)  # customer 0: a third of all rows
        rows.append((i, cust, rnd.randint(0, 20), T0 + dt.timedelta(seconds=rnd.randint(0, 3 * 86400)),
                     rnd.randint(0, 1), str(rnd.randint(0, 9))))
    return spark.createDataFrame(rows, SCHEMA)


def customers(spark):
    rows = [(i, f"n{i}", 20 + i % 40, str(i % 2), "1", "a", "01/13/2013", "1", str(i % 3), "c", "0")
            for i in range(501)]
    return spark.createDataFrame(rows, CUSTOMERS)


def final_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@contextlib.contextmanager
def small_partitions(spark):
    """No broadcast, and every large partition counts as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_customer_lookup_is_split_and_whole(spark):
    plays, cust = skewed_plays(spark), customers(spark)
    with small_partitions(spark):
        # the plays keep their payload: a shuffle block of a bare repeated key compresses
        # to almost nothing and would not look skewed
        enriched = J.enrich_with_customer(plays, cust).select("event_id", "datetime", "track_id",
                                                              "customer_id", "name")
        rows = enriched.collect()
        plan = final_plan(enriched)
        assert "isFinalPlan=true" in plan and "skew=true" in plan
    assert len(rows) == 30000
    hot = [r for r in rows if r.customer_id == 0]
    assert len(hot) == 10000 and {r.name for r in hot} == {"n0"}
    assert all(r.name == f"n{r.customer_id}" for r in rows)


def test_hot_customer_flags_are_split_and_whole(spark):
    plays, cust = skewed_plays(spark), customers(spark).filter("customer_id != 3")
    preds = spark.createDataFrame([(i, i % 2) for i in range(0, 400)], "customer_id long, pred int")
    with small_partitions(spark):
        flagged = J.enrich_and_flag(plays, cust, preds).select("event_id", "datetime", "track_id", "customer_id",
                                                               "name", "SendEvent")
        rows = flagged.collect()
        assert "skew=true" in final_plan(flagged)
    assert len(rows) == 30000
    for r in rows:
        assert r.name == (None if r.customer_id == 3 else f"n{r.customer_id}")
        assert r.SendEvent == (r.customer_id % 2 if r.customer_id < 400 else None)
    chained = J.flag_ad_targets(J.enrich_with_customer(plays, cust, "drop"), preds, "drop")
    assert J.enrich_and_flag(plays, cust, preds, "drop").count() == chained.count()


def test_missing_customers_are_counted_before_the_join(spark):
    plays, cust = skewed_plays(spark), customers(spark).filter("customer_id % 2 = 1")
    missing = J.missing_customers(plays, cust)
    got = {r.customer_id: r.plays for r in missing.collect()}
    assert got[0] == 10000 and all(k % 2 == 0 for k in got)
    plan = final_plan(missing)
    assert plan.index("LeftAnti") < plan.index("partial_count")  # the aggregate is below the join


def test_plays_of_a_customer_are_one_list_per_day(spark):
    plays = skewed_plays(spark, 9000)
    out = PR.plays_by_customer(plays)
    got = {(r.customer_id, r.period_start): r.plays for r in out.collect()}
    assert sum(map(len, got.values())) == 9000
    assert len(got) == plays.selectExpr("customer_id", "to_date(datetime)").distinct().count()
    assert all(p == sorted(p, key=lambda x: (x.datetime, x.event_id)) for p in got.values())
    # the rows are spread by the full key, so a hot customer's days go to different tasks
    keys = final_plan(out).split("hashpartitioning(")[1].split(")")[0]
    assert keys.startswith("customer_id") and len(keys.split(", ")) >= 3


def test_hot_customer_profile_and_repeats_match_brute_force(spark):
    plays = skewed_plays(spark, 9000)
    rows = plays.collect()
    prof = {r.customer_id: r for r in PR.listening_profile(plays).collect()}
    hot = [r for r in rows if r.customer_id == 0]
    assert prof[0].unique_tracks == len({r.track_id for r in hot})
    assert prof[0].mobile == sum(r.ismobile for r in hot)
    # repeat listens of the hot customer against a direct scan of its sorted plays
    got = {r.track_id: r.first_detected for r in L.repeat_listens(plays, 3, 1800).collect() if r.customer_id == 0}
    exp = {}
    for track in {r.track_id for r in hot}:
        ts = sorted((r.datetime, r.event_id) for r in hot if r.track_id == track)
        for i in range(2, len(ts)):
            if (ts[i][0] - ts[i - 2][0]).total_seconds() <= 1800:
                exp[track] = ts[i][0]
                break
    assert got == exp and exp


def test_salted_lookup_for_hot_keys_equals_plain_lookup(spark):
    plays, cust = skewed_plays(spark, 6000), customers(spark)
    hot = J.hot_keys(plays, "customer_id", min_share=0.05)
    assert hot == [0]
    cols = ["event_id", "customer_id", "name", "age"]
    plain = {tuple(r) for r in J.enrich_with_customer(plays, cust).select(*cols).collect()}
    salted = J.enrich_with_customer(plays, cust, hot_keys=hot, salts=8).select(*cols)
    assert {tuple(r) for r in salted.collect()} == plain and salted.count() == 6000
    # missing keys and the drop policy behave the same with salting
    few = cust.filter("customer_id % 2 = 0")
    a = J.enrich_with_customer(plays, few, "drop", hot_keys=hot, salts=4).count()
    assert a == J.enrich_with_customer(plays, few, "drop").count()
