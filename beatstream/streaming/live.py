"""Results that are kept up to date while the input arrives.

- Dashboards: counts per window and key in update mode.  A micro-batch emits the new totals of
  the keys that it changed, which replace the old ones in a keyed table (a replayed batch
  carries the same totals: it changes nothing).  The table is right after every batch, open
  windows included.
- Profiles: additive counters per customer, added once per batch, and a keyed set of (customer,
  track) in the state store for the unique tracks.  A batch touches its own customers only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatstream.functions.scalar import AD_REDUCED_1DAY
from beatstream.operators.dashboard import (
    APPLINK_AGE_RANGES, LEVEL_AGE_RANGES, TERMS_SIZE, level_gender_from_counts, range_term_counts, range_terms_from_counts,
)
from beatstream.operators.joins import label_from_clicks
from beatstream.operators.profile import DAYPARTS, click_counts, feature_ratios, with_daypart
from beatstream.schemas import FEATURE_NAMES
from beatstream.streaming.flows import event_time, ntz, start
from beatstream.streaming.sinks import add_by_key, read_keyed_table, upsert_by_key

# --- dashboards -----------------------------------------------------------------------------


def keep_totals(counts: DataFrame, path: str, keys: list[str], checkpoint: str | None = None, trigger: dict | None = None,
                keep_seconds: float = 3600):
    """Start a query that keeps the totals of a streaming aggregation in a keyed table at ``path``.

    ``counts`` has the keys and the totals; it runs in update mode.  The batch number orders
    the writes of a key.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        upsert_by_key(batch.withColumn("_seq", F.lit(batch_id)), path, keys, "_seq", keep_seconds=keep_seconds,
                      null_keys=True)

    return start(counts, handle, checkpoint, trigger, output_mode="update")


def live_level_gender(enriched: DataFrame, path: str, bucket: str = "1 hour", delay: str = "1 hour",
                      ts_col: str = "datetime", **run):
    """Keep plays per level, time bucket and gender; ``read_level_gender`` is the dashboard.

    Totals of a bucket are final once the watermark has passed it; plays that come later are
    left out.
    """
    e = event_time(enriched.filter(F.col("Level").isNotNull()), ts_col).withWatermark(ts_col, delay)
    counts = e.groupBy(F.window(F.col(ts_col), bucket).alias("window"), "Level", "gender").agg(F.count(F.lit(1)).alias("plays"))
    counts = counts.select("Level", ntz(F.col("window.start")).alias("bucket_start"), "gender", "plays")
    return keep_totals(counts, path, ["Level", "bucket_start", "gender"], **run)


def read_level_gender(spark: SparkSession, path: str, size: int = TERMS_SIZE) -> DataFrame:
    return level_gender_from_counts(read_keyed_table(spark, path), size)


def live_applink_by_age(enriched: DataFrame, path: str, ranges=None, **run):
    """Keep plays per age range and app link; ``read_by_age(…, "LinkedWithApps")`` is the dashboard."""
    return _live_by_age(enriched, path, ranges or APPLINK_AGE_RANGES, "LinkedWithApps", **run)


def live_level_by_age(enriched: DataFrame, path: str, ranges=None, **run):
    """Keep plays per age range and level; ``read_by_age(…, "Level")`` is the dashboard."""
    return _live_by_age(enriched, path, ranges or LEVEL_AGE_RANGES, "Level", **run)


def _live_by_age(enriched: DataFrame, path: str, ranges, term: str, **run):
    # state: one row per range and term, whatever the number of plays
    counts = range_term_counts(enriched, "age", ranges, term)
    return keep_totals(counts, path, ["age_range", "age_range_from", "age_range_to", term], **run)


def read_by_age(spark: SparkSession, path: str, term: str, size: int = TERMS_SIZE) -> DataFrame:
    return range_terms_from_counts(read_keyed_table(spark, path), term, size)


# --- profiles -------------------------------------------------------------------------------

def keep_profiles(plays: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, ts_col: str = "datetime") -> list:
    """Start the two queries that keep listening profiles below ``path``.

    One adds each batch's plays per daypart and mobile plays to its customers' counters; the
    other counts (customer, track) pairs that were never seen, which the state store knows.
    Plays without a customer are left out.  ``checkpoint`` is a folder for both.
    """
    plays = plays.filter(F.col("customer_id").isNotNull())

    def add_counts(batch: DataFrame, batch_id: int) -> None:
        counts = [F.count_if(F.col("daypart") == d).alias(d) for d in DAYPARTS]
        deltas = with_daypart(batch, ts_col).groupBy("customer_id").agg(*counts, F.sum("ismobile").alias("mobile"))
        add_by_key(deltas, f"{path}/dayparts", "customer_id", "plays", batch_id, keep_seconds=3600)

    def add_tracks(batch: DataFrame, batch_id: int) -> None:
        deltas = batch.groupBy("customer_id").agg(F.count(F.lit(1)).alias("unique_tracks"))
        add_by_key(deltas, f"{path}/tracks", "customer_id", "tracks", batch_id, keep_seconds=3600)

    pairs = plays.select("customer_id", "track_id").filter(F.col("track_id").isNotNull()) \
        .dropDuplicates(["customer_id", "track_id"])
    return [start(plays, add_counts, f"{checkpoint}/dayparts", trigger),
            start(pairs, add_tracks, f"{checkpoint}/tracks", trigger)]


def keep_clicks(clicks: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, which: str = AD_REDUCED_1DAY):
    """Start the query that adds each batch's clicks on the ad to its customers' counters."""
    def add(batch: DataFrame, batch_id: int) -> None:
        add_by_key(click_counts(batch, which), f"{path}/clicks", "customer_id", "clicks", batch_id, keep_seconds=3600)

    return start(clicks, add, f"{checkpoint}/clicks", trigger)


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """The profiles as ``listening_profile`` gives them for all plays so far."""
    tracks = read_keyed_table(spark, f"{path}/tracks")
    return (read_keyed_table(spark, f"{path}/dayparts").join(tracks, "customer_id", "left")
            .select("customer_id", F.coalesce("unique_tracks", F.lit(0)).alias("unique_tracks"), *DAYPARTS, "mobile"))


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """The features as ``build_features`` gives them for all plays and clicks so far."""
    labelled = label_from_clicks(read_profiles(spark, path), read_keyed_table(spark, f"{path}/clicks"))
    return feature_ratios(labelled).select("customer_id", F.col("label").cast("double").alias("label"), *FEATURE_NAMES)
