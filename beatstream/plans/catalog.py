"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the test tables (through the adapter in
``beatstream.sources.testdata``) over their whole extent.  The matching DuckDB
statements live in ``beatstream.plans.oracle_queries``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatstream.functions import parse as P
from beatstream.functions import scalar as S
from beatstream.operators import dashboard as D
from beatstream.operators import joins as J
from beatstream.operators import listening as L
from beatstream.operators import profile as PR
from beatstream.operators import retail as R
from beatstream.operators import sets as SET
from beatstream.operators import tags as TG
from beatstream.operators import windows as W
from beatstream.plans.derived import enriched, predictions
from beatstream.sources import testdata as T

Query = Callable[[SparkSession, str], DataFrame]


# --- dashboard aggregations -------------------------------------------------------

def q_count_docs(spark, sf):
    return D.count_docs(T.plays(spark, sf))


def q_mobile_trend(spark, sf):
    return D.mobile_trend(T.plays(spark, sf), "1 hour")


def q_mobile_trend_auto(spark, sf):
    return D.mobile_trend_auto(T.plays(spark, sf))


def q_approx_users(spark, sf):
    return D.approx_users(T.plays(spark, sf), "1 day")


def q_connections_per_minute(spark, sf):
    return D.connections_per_minute(T.plays(spark, sf))


def q_top_regions_and_users(spark, sf):
    return D.top_regions_and_users(T.plays(spark, sf), 5, 5)


def q_terms_zip(spark, sf):
    return D.terms(T.plays(spark, sf), "listening_zip_code", 5, count_col="plays")


def q_level_gender_trend(spark, sf):
    return D.level_gender_trend(enriched(spark, sf), "1 day")


def q_applink_by_age(spark, sf):
    return D.applink_by_age(enriched(spark, sf))


def q_level_by_age(spark, sf):
    return D.level_by_age(enriched(spark, sf))


# Overlapping and open-ended ranges over customer ages.
CUSTOMER_AGE_RANGES = [(None, 18), (18, 35), (30, 50), (65, None)]


def q_range_bucket(spark, sf):
    b = D.range_bucket(T.customers(spark, sf), "age", CUSTOMER_AGE_RANGES, "age_range")
    return (b.groupBy("age_range", "age_range_from", "age_range_to")
             .agg(F.count(F.lit(1)).alias("customers")))


def q_demographics(spark, sf):
    return D.demographics(enriched(spark, sf))


def q_share_by_level(spark, sf):
    counts = (D.range_bucket(enriched(spark, sf), "age", D.LEVEL_AGE_RANGES, "age_range")
              .groupBy("age_range", "Level").agg(F.count(F.lit(1)).alias("plays")))
    return W.share_of_total(counts, "age_range", "plays", "share")


def q_recent_plays(spark, sf):
    return D.since(T.plays(spark, sf), 15)


def q_discover_view(spark, sf):
    p = D.since(T.plays(spark, sf), 15)
    return (p.select("datetime", "customer_id", "track_id", "listening_zip_code", "ismobile")
             .orderBy(F.desc("datetime")))


# --- parsing and joins -------------------------------------------------------------

def play_log(spark: SparkSession, sf: str) -> DataFrame:
    """The raw play log, read from the text files the log collector delivers."""
    return spark.read.text(T.play_log_folder(spark, sf))


def q_parse_plays(spark, sf):
    return P.parse_plays(play_log(spark, sf))


def q_quarantine_lines(spark, sf):
    return P.quarantine_bad_lines(play_log(spark, sf))


def q_enrich_plays(spark, sf):
    return enriched(spark, sf)


def q_enrich_parsed_lines(spark, sf):
    """Raw lines -> parsed plays -> customer lookup (the streaming record flow, batch form)."""
    plays = P.parse_plays(play_log(spark, sf))
    return J.enrich_with_customer(plays, T.customers(spark, sf))


def q_enrich_active_only(spark, sf):
    return J.enrich_with_customer(T.plays(spark, sf), T.active_customers(spark, sf), on_missing="drop")


def q_missing_customers(spark, sf):
    return J.missing_customers(T.plays(spark, sf), T.active_customers(spark, sf))


def q_flag_ad_targets(spark, sf):
    return J.enrich_and_flag(T.plays(spark, sf), T.customers(spark, sf), predictions(spark, sf))


def q_flag_enriched_plays(spark, sf):
    """The flag looked up for plays that already carry their customer."""
    return J.flag_ad_targets(enriched(spark, sf), predictions(spark, sf))


def q_is_member(spark, sf):
    members = predictions(spark, sf).filter(F.col("pred") == 1)
    return J.is_member(T.customers(spark, sf).select("customer_id", "Level"), members)


def q_enrich_tracks(spark, sf):
    return J.enrich_with_track(T.plays(spark, sf), T.music(spark, sf))


# --- scalar projections ------------------------------------------------------------

def q_daypart_of_plays(spark, sf):
    return PR.with_daypart(T.plays(spark, sf)).select("event_id", "customer_id", "hour", "daypart")


def q_ad_match(spark, sf):
    c = T.clicks(spark, sf)
    return c.select("EventID", "CustID", S.ad_match(F.col("AdClicked")).alias("matched"))


def q_ad_match_exact(spark, sf):
    return S.ad_match_exact(T.clicks(spark, sf)).select("EventID", "CustID", "AdClicked")


def q_retail_cost(spark, sf):
    return R.with_total_cost(T.retail(spark, sf))


def q_hashtags(spark, sf):
    return S.hashtags(T.messages(spark, sf), "text", keep=["msg_id"])


def q_decode_payload(spark, sf):
    payload = T.play_lines(spark, sf).select(F.encode(F.col("value"), "UTF-8").alias("value"))
    return P.bytes_to_lines(payload)


# --- profiles, labels, ML features ---------------------------------------------------

def q_listening_profile(spark, sf):
    return PR.listening_profile(T.plays(spark, sf), "all")


def q_listening_profile_last(spark, sf):
    return PR.listening_profile(T.plays(spark, sf), "last")


def q_click_counts(spark, sf):
    return PR.click_counts(T.clicks(spark, sf))


def q_sorted_click_counts(spark, sf):
    return PR.sorted_click_counts(T.clicks(spark, sf))


def q_label_from_clicks(spark, sf):
    prof = PR.listening_profile(T.plays(spark, sf))
    return J.label_from_clicks(prof, PR.click_counts(T.clicks(spark, sf)))


def q_feature_ratios(spark, sf):
    return PR.feature_ratios(PR.listening_profile(T.plays(spark, sf)))


def q_build_features(spark, sf):
    return PR.build_features(T.plays(spark, sf), T.clicks(spark, sf))


def q_profile_averages(spark, sf):
    return PR.profile_averages(PR.listening_profile(T.plays(spark, sf)))


def q_plays_by_customer(spark, sf):
    """Lists as text, one play after another in time order."""
    play = F.transform("plays", lambda p: F.concat_ws("/", p["event_id"].cast("string"), p["track_id"].cast("string"),
                                                      p["ismobile"].cast("string"), p["listening_zip_code"]))
    out = PR.plays_by_customer(T.plays(spark, sf))
    return out.select("customer_id", "period_start", F.size("plays").alias("n"), F.array_join(play, ";").alias("plays"))


def q_ad_audience(spark, sf):
    from beatstream.operators.model import ad_audience
    return ad_audience(T.customers(spark, sf), predictions(spark, sf))


# --- listening statistics -------------------------------------------------------------

def q_top_tracks_by_gender(spark, sf):
    return L.top_tracks_by_gender(enriched(spark, sf), 10, 30)


def q_daypart_average(spark, sf):
    return L.daypart_average(T.plays(spark, sf))


def q_distinct_tracks(spark, sf):
    return L.distinct_tracks(T.plays(spark, sf))


def q_distinct_mobile_tracks(spark, sf):
    return L.distinct_tracks(T.plays(spark, sf), mobile_only=True)


def q_access_stats(spark, sf):
    return L.access_stats(T.plays(spark, sf), "30 minutes", "5 minutes")


def q_repeat_listens(spark, sf):
    return L.repeat_listens(T.plays(spark, sf), 3, 30 * 60)


def q_repeat_listens_coarse(spark, sf):
    return L.repeat_listens(T.coarse_plays(spark, sf), 3, 24 * 3600)


def q_kth_previous_gap(spark, sf):
    g = W.kth_previous_gap(T.coarse_plays(spark, sf).select("customer_id", "track_id", "event_id", "datetime"),
                           ["customer_id", "track_id"], 2, 24 * 3600)
    return g


# --- tags, retail, sets -----------------------------------------------------------------

def q_tag_counts(spark, sf):
    return TG.tag_counts(T.messages(spark, sf))


def q_trending_tags(spark, sf):
    return TG.trending_tags_batch(T.messages(spark, sf), 10)


def q_daily_spend(spark, sf):
    return R.daily_spend(T.retail(spark, sf))


def q_top_spenders(spark, sf):
    return R.top_spenders(T.retail(spark, sf), 5)


def q_union_sources(spark, sf):
    """Two sources (mobile and desktop plays, as two topics would deliver them) unioned."""
    p = T.plays(spark, sf)
    return SET.union_streams(p.filter(F.col("ismobile") == 1), p.filter(F.col("ismobile") != 1))


def q_new_members(spark, sf):
    """Predicted clickers not yet in the audience set (existing set: gold customers)."""
    cands = predictions(spark, sf).filter(F.col("pred") == 1)
    existing = T.customers(spark, sf).filter(F.col("Level") == "2")
    return SET.new_members(cands, existing)


def q_synth_age(spark, sf):
    c = T.customers(spark, sf)
    return c.select("customer_id", S.synth_age(F.col("customer_id")).alias("synth_age"))


QUERIES: dict[str, Query] = {
    # dashboards
    "count_docs": q_count_docs,
    "mobile_trend": q_mobile_trend,
    "mobile_trend_auto": q_mobile_trend_auto,
    "approx_users": q_approx_users,
    "connections_per_minute": q_connections_per_minute,
    "top_regions_and_users": q_top_regions_and_users,
    "terms_zip": q_terms_zip,
    "level_gender_trend": q_level_gender_trend,
    "applink_by_age": q_applink_by_age,
    "level_by_age": q_level_by_age,
    "range_bucket": q_range_bucket,
    "demographics": q_demographics,
    "share_by_level": q_share_by_level,
    "recent_plays": q_recent_plays,
    "discover_view": q_discover_view,
    # parsing and joins
    "parse_plays": q_parse_plays,
    "quarantine_lines": q_quarantine_lines,
    "enrich_plays": q_enrich_plays,
    "enrich_parsed_lines": q_enrich_parsed_lines,
    "enrich_active_only": q_enrich_active_only,
    "missing_customers": q_missing_customers,
    "flag_ad_targets": q_flag_ad_targets,
    "flag_enriched_plays": q_flag_enriched_plays,
    "is_member": q_is_member,
    "enrich_tracks": q_enrich_tracks,
    # scalar projections
    "daypart_of_plays": q_daypart_of_plays,
    "ad_match": q_ad_match,
    "ad_match_exact": q_ad_match_exact,
    "retail_cost": q_retail_cost,
    "hashtags": q_hashtags,
    "decode_payload": q_decode_payload,
    "synth_age": q_synth_age,
    # profiles and features
    "listening_profile": q_listening_profile,
    "listening_profile_last": q_listening_profile_last,
    "click_counts": q_click_counts,
    "sorted_click_counts": q_sorted_click_counts,
    "label_from_clicks": q_label_from_clicks,
    "feature_ratios": q_feature_ratios,
    "build_features": q_build_features,
    "profile_averages": q_profile_averages,
    "plays_by_customer": q_plays_by_customer,
    "ad_audience": q_ad_audience,
    # listening statistics
    "top_tracks_by_gender": q_top_tracks_by_gender,
    "daypart_average": q_daypart_average,
    "distinct_tracks": q_distinct_tracks,
    "distinct_mobile_tracks": q_distinct_mobile_tracks,
    "access_stats": q_access_stats,
    "repeat_listens": q_repeat_listens,
    "repeat_listens_coarse": q_repeat_listens_coarse,
    "kth_previous_gap": q_kth_previous_gap,
    # tags, retail, sets
    "tag_counts": q_tag_counts,
    "trending_tags": q_trending_tags,
    "daily_spend": q_daily_spend,
    "top_spenders": q_top_spenders,
    "union_sources": q_union_sources,
    "new_members": q_new_members,
}

from beatstream.plans.catalog_io import IO_QUERIES  # noqa: E402
from beatstream.plans.catalog_live import LIVE_QUERIES  # noqa: E402

QUERIES.update(IO_QUERIES)
QUERIES.update(LIVE_QUERIES)
