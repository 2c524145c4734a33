"""Per-customer listening profiles, click labels and feature ratios.

The reference gathers every customer's plays into one list, loops over it in
Python and then looks up each customer's click sum with one Spark job per
customer.  Here the profile is a single hash aggregate (map-side combine, the
distinct-track count pre-aggregated on (customer, track)), the click sums a
second one, and the label a left join: two aggregations and one join, no
driver loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatstream.functions.scalar import AD_REDUCED_1DAY, ad_match, daypart, hour_of_day
from beatstream.operators.joins import label_from_clicks
from beatstream.schemas import FEATURE_NAMES

DAYPARTS = ["morn", "aft", "eve", "night"]


def with_daypart(plays: DataFrame, ts_col: str = "datetime") -> DataFrame:
    return (plays.withColumn("hour", hour_of_day(F.col(ts_col)))
                 .withColumn("daypart", daypart(F.col("hour"))))


def plays_by_customer(plays: DataFrame, period: str = "1 day", ts_col: str = "datetime") -> DataFrame:
    """Each customer's plays gathered into one time-ordered list per period.

    The fixed ``period`` bounds a list by what one customer can play in that time, whatever
    the size of the data: a listener holding a third of all plays becomes as many rows as
    there are periods, spread by the full (customer, period) key.  No play is dropped; the
    list is ordered by time and event id.
    """
    item = F.struct(F.col(ts_col).alias("datetime"), F.col("event_id"), F.col("track_id"),
                    F.col("ismobile"), F.col("listening_zip_code"))
    return (plays.groupBy("customer_id", F.window(F.col(ts_col), period).start.alias("period_start"))
                 .agg(F.sort_array(F.collect_list(item)).alias("plays")))


def listening_profile(plays: DataFrame, mode: str = "all", ts_col: str = "datetime") -> DataFrame:
    """Per customer: unique tracks, plays per daypart and mobile plays.

    ``mode="all"`` counts every play.  ``mode="last"`` reproduces the reference
    script literally: only the customer's latest play (by time, then event id)
    counts for dayparts and mobile, while unique tracks still cover all plays.
    """
    p = with_daypart(plays, ts_col)
    unique = F.countDistinct("track_id").alias("unique_tracks")
    if mode == "all":
        counts = [F.count_if(F.col("daypart") == d).alias(d) for d in DAYPARTS]
        return p.groupBy("customer_id").agg(unique, *counts, F.sum("ismobile").alias("mobile"))
    if mode != "last":
        raise ValueError("mode must be 'all' or 'last'")
    last = F.max_by(F.struct("daypart", "ismobile"), F.struct(F.col(ts_col), F.col("event_id")))
    agg = p.groupBy("customer_id").agg(unique, last.alias("_last"))
    return agg.select("customer_id", "unique_tracks",
                      *[(F.col("_last.daypart") == d).cast("bigint").alias(d) for d in DAYPARTS],
                      F.col("_last.ismobile").cast("bigint").alias("mobile"))


def feature_ratios(profile: DataFrame) -> DataFrame:
    """Six ratios over the daypart total: morn, aft, eve, night, mobile, unique."""
    tot = sum((F.col(d) for d in DAYPARTS), F.lit(0)).cast("double")
    src = {"morn": "morn", "aft": "aft", "eve": "eve", "night": "night",
           "mobile": "mobile", "unique": "unique_tracks"}
    keep = [c for c in profile.columns if c not in set(src.values())]
    return profile.select(*keep, *[F.try_divide(F.col(src[f]).cast("double"), tot).alias(f)
                                   for f in FEATURE_NAMES])


def click_counts(clicks: DataFrame, which: str = AD_REDUCED_1DAY, key: str = "CustID",
                 ad_col: str = "AdClicked") -> DataFrame:
    """Per customer: how many clicks matched the ad (customers with 0 are kept)."""
    return (clicks.groupBy(F.col(key).alias("customer_id"))
                  .agg(F.sum(ad_match(F.col(ad_col), which)).alias("clicks")))


def sorted_click_counts(clicks: DataFrame, which: str = AD_REDUCED_1DAY) -> DataFrame:
    """Click sums ordered by customer id as text (the reference sorts string keys)."""
    return click_counts(clicks, which).orderBy(F.col("customer_id").cast("string"))


def profile_averages(profile: DataFrame) -> DataFrame:
    """Column means over all customers."""
    cols = ["unique_tracks", *DAYPARTS, "mobile"]
    return profile.agg(*[F.avg(c).alias(f"avg_{c}") for c in cols],
                       F.count(F.lit(1)).alias("customers"))


def build_features(plays: DataFrame, clicks: DataFrame, mode: str = "all",
                   which: str = AD_REDUCED_1DAY) -> DataFrame:
    """customer_id, label (double) and the six ratios: profile -> label -> ratios."""
    prof = listening_profile(plays, mode)
    labelled = label_from_clicks(prof, click_counts(clicks, which))
    ratios = feature_ratios(labelled)
    return ratios.select("customer_id", F.col("label").cast("double").alias("label"), *FEATURE_NAMES)
