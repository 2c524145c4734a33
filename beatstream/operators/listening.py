"""Listening statistics described by the reference scenario: top tracks, daypart
averages, unique tracks, sliding access statistics and repeat listens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatstream.functions.timeutil import pane_width
from beatstream.operators.dashboard import since
from beatstream.operators.profile import DAYPARTS, with_daypart
from beatstream.operators.windows import kth_previous_gap, top_n_per_group


def top_tracks_by_gender(enriched: DataFrame, n: int = 10, hours: int = 30,
                         ts_col: str = "datetime", as_of: Column | None = None) -> DataFrame:
    """Top ``n`` tracks per gender over the last ``hours`` before ``as_of`` (default newest play).

    The time filter reads only play columns, so it is pushed below the customer
    lookup to the play scan; only recent plays are joined.
    """
    recent = since(enriched, hours * 60, ts_col, as_of).filter(F.col("gender").isNotNull())
    counts = recent.groupBy("gender", "track_id").agg(F.count(F.lit(1)).alias("plays"))
    return top_n_per_group(counts, "gender", [F.desc("plays"), F.asc("track_id")], n, rank_col="rank")


def daypart_average(plays: DataFrame, ts_col: str = "datetime") -> DataFrame:
    """Per customer: mean plays per active day in each daypart, and the favourite daypart.

    Two hash aggregates: (customer, day) with one count per daypart, then customer.
    Ties for the favourite go to the earlier daypart in morn, aft, eve, night order.
    """
    p = with_daypart(plays, ts_col).withColumn("day", F.to_date(F.col(ts_col)))
    per_day = p.groupBy("customer_id", "day").agg(
        *[F.count_if(F.col("daypart") == d).alias(d) for d in DAYPARTS])
    per_cust = per_day.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("active_days"),
        *[F.sum(d).alias(d) for d in DAYPARTS])
    avgs = [(F.col(d) / F.col("active_days")).alias(f"{d}_per_day") for d in DAYPARTS]
    out = per_cust.select("customer_id", "active_days", *avgs)
    best = F.greatest(*[F.col(f"{d}_per_day") for d in DAYPARTS])
    fav = None
    for d in DAYPARTS:
        cond = F.col(f"{d}_per_day") == best
        fav = F.when(cond, F.lit(d)) if fav is None else fav.when(cond, F.lit(d))
    return out.withColumn("favourite_daypart", fav)


def distinct_tracks(plays: DataFrame, mobile_only: bool = False) -> DataFrame:
    """Unique tracks listened to (optionally only on mobile)."""
    p = plays.filter(F.col("ismobile") == 1) if mobile_only else plays
    return p.filter(F.col("track_id").isNotNull()).select("track_id").distinct()


def access_stats(plays: DataFrame, length: str = "30 minutes", slide: str = "5 minutes",
                 ts_col: str = "datetime") -> DataFrame:
    """Access statistics of the last ``length`` every ``slide`` (sliding windows).

    Plays are counted per (pane, customer) first, a pane being the longest span that
    lies whole in the same windows; only those counts are copied to the windows of a pane.
    """
    panes = (plays.groupBy(F.window(F.col(ts_col), pane_width(length, slide)).start.alias("_pane"), "customer_id")
                  .agg(F.count(F.lit(1)).alias("plays"), F.sum("ismobile").alias("mobile_plays")))
    w = F.window(F.col("_pane"), length, slide)
    return (panes.groupBy(w.start.alias("window_start"), w.end.alias("window_end"))
                 .agg(F.sum("plays").alias("plays"),
                      F.countDistinct("customer_id").alias("unique_customers"),
                      F.sum("mobile_plays").alias("mobile_plays")))


def repeat_listens(plays: DataFrame, min_plays: int = 3, within_seconds: int = 30 * 60,
                   ts_col: str = "datetime") -> DataFrame:
    """Customers who played the same track ``min_plays`` times within ``within_seconds``.

    One row per (customer, track): when it was first detected (time of the play
    that completed the first qualifying run) and how many plays completed a run.
    Plays without a customer or track belong to no key and are left out.
    """
    known = plays.filter(F.col("customer_id").isNotNull() & F.col("track_id").isNotNull())
    gaps = kth_previous_gap(known.select("customer_id", "track_id", "event_id", ts_col),
                            ["customer_id", "track_id"], min_plays - 1, within_seconds,
                            ts_col=ts_col, gap_col="gap_seconds")
    hits = gaps.filter(F.col("gap_seconds").isNotNull())
    return (hits.groupBy("customer_id", "track_id")
                .agg(F.min(ts_col).alias("first_detected"),
                     F.count(F.lit(1)).alias("qualifying_plays")))
