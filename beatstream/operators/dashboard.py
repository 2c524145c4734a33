"""Dashboard aggregations: time histograms, terms, nested top terms, age ranges, shares.

Each function returns a flat DataFrame (no structs) with one row per bucket.
Empty buckets are never produced (``min_doc_count 1``); missing terms are dropped.
Terms are ordered by count descending, ties by key ascending.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatstream.functions.timeutil import ntz_micros
from beatstream.operators.windows import share_of_total, top_n_per_group

# Fixed values (must equal the reference dashboards): age ranges, half-open [from, to),
# None for an open end.  Both charts skip [40, 50).
APPLINK_AGE_RANGES = [(0, 10), (10, 20), (20, 30), (30, 40), (50, None)]
LEVEL_AGE_RANGES = [(0, 8), (8, 14), (14, 20), (20, 30), (30, 40), (50, None)]
TERMS_SIZE = 5


def time_bucket(ts: Column, width: str) -> Column:
    """Start of the tumbling bucket (aligned to the epoch, like ``window``)."""
    return F.window(ts, width).start


def since(df: DataFrame, minutes: int, ts_col: str = "datetime", as_of: Column | None = None) -> DataFrame:
    """Rows in the last ``minutes`` before ``as_of`` (default: the newest row's time).

    By default the window start is one scalar subquery (newest time minus the
    window), computed once and inlined: no join, and as a plain ``ts >= value``
    comparison it is pushed into the parquet scan, which skips row groups whose
    newest time is older.  Every row is at or before the newest time, so only the
    lower bound is tested then.
    """
    span = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    if as_of is None:
        start = df.select(F.max(ts_col) - span).scalar()
        return df.filter(F.col(ts_col) >= start)
    return df.filter((F.col(ts_col) >= as_of - span) & (F.col(ts_col) <= as_of))


# Our ladder of "round" bucket widths in seconds for automatic time histograms:
# 1 s, 5 s, 10 s, 30 s, 1 min, 5 min, 10 min, 30 min, 1 h, 3 h, 12 h, 1 day, 7 days.
AUTO_WIDTHS = [1, 5, 10, 30, 60, 300, 600, 1800, 3600, 10800, 43200, 86400, 604800]
AUTO_TARGET_BUCKETS = 100


def auto_width_seconds(df: DataFrame, ts_col: str = "datetime", target: int = AUTO_TARGET_BUCKETS) -> Column:
    """The smallest ladder width that cuts the data's time span into at most
    ``target`` buckets (the widest width past that), as one scalar subquery."""
    us = ntz_micros(F.col(ts_col))
    span_s = (F.max(us) - F.min(us)) / F.lit(1_000_000.0)
    choice = None
    for w in AUTO_WIDTHS[:-1]:
        cond = span_s <= F.lit(w * target)
        choice = F.when(cond, F.lit(w)) if choice is None else choice.when(cond, F.lit(w))
    width = choice.otherwise(F.lit(AUTO_WIDTHS[-1])).cast("bigint")
    return df.select(width).scalar()


def auto_time_bucket(df: DataFrame, ts_col: str = "datetime", target: int = AUTO_TARGET_BUCKETS) -> Column:
    """Bucket start on an automatic width, aligned to the epoch like ``window``."""
    width_us = auto_width_seconds(df, ts_col, target) * F.lit(1_000_000)
    offset_us = F.pmod(ntz_micros(F.col(ts_col)), width_us)
    # subtract the offset as an interval: stays timestamp_ntz, no time zone involved
    return F.col(ts_col) - F.make_dt_interval(secs=(offset_us / F.lit(1_000_000)).cast("decimal(18,6)"))


def mobile_trend_auto(plays: DataFrame, ts_col: str = "datetime", target: int = AUTO_TARGET_BUCKETS) -> DataFrame:
    """``mobile_trend`` with the bucket width chosen from the data (``interval: auto``)."""
    return (plays.groupBy(auto_time_bucket(plays, ts_col, target).alias("bucket_start"))
                 .agg(F.sum("ismobile").alias("mobile_connections"),
                      F.countDistinct("customer_id").alias("unique_customers"),
                      F.count(F.lit(1)).alias("plays")))


def count_docs(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("doc_count"))


def mobile_trend(plays: DataFrame, bucket: str = "1 hour", ts_col: str = "datetime") -> DataFrame:
    """Per time bucket: mobile connections (sum of the flag) and unique customers."""
    return (plays.groupBy(F.window(F.col(ts_col), bucket).alias("_w"))
                 .agg(F.sum("ismobile").alias("mobile_connections"),
                      F.countDistinct("customer_id").alias("unique_customers"))
                 .select(F.col("_w.start").alias("bucket_start"), "mobile_connections", "unique_customers"))


def approx_users(plays: DataFrame, bucket: str = "1 hour", ts_col: str = "datetime",
                 rsd: float = 0.02) -> DataFrame:
    """Same as ``mobile_trend`` with a HyperLogLog++ cardinality (also valid on streams)."""
    # Grouping by the window struct (not its start) keeps it an event-time window
    # for streaming aggregation with a watermark.
    return (plays.groupBy(F.window(F.col(ts_col), bucket).alias("_w"))
                 .agg(F.sum("ismobile").alias("mobile_connections"),
                      F.approx_count_distinct("customer_id", rsd).alias("approx_customers"))
                 .select(F.col("_w.start").alias("bucket_start"), "mobile_connections", "approx_customers"))


def connections_per_minute(plays: DataFrame, ts_col: str = "datetime") -> DataFrame:
    return (plays.groupBy(F.window(F.col(ts_col), "1 minute").alias("_w"))
                 .agg(F.count(F.lit(1)).alias("connections"))
                 .select(F.col("_w.start").alias("minute_start"), "connections"))


def terms(df: DataFrame, col: str, size: int = TERMS_SIZE, count_col: str = "count") -> DataFrame:
    """Top ``size`` values of ``col`` by row count (a bounded TakeOrderedAndProject)."""
    counts = (df.filter(F.col(col).isNotNull())
                .groupBy(col).agg(F.count(F.lit(1)).alias(count_col)))
    return counts.orderBy(F.desc(count_col), F.asc(col)).limit(size)


def nested_terms(df: DataFrame, outer: str, inner: str, outer_size: int = TERMS_SIZE,
                 inner_size: int = TERMS_SIZE, outer_count: str | None = None,
                 inner_count: str = "count") -> DataFrame:
    """Top outer terms, and inside each the top inner terms (sub-buckets per parent).

    One scan and one aggregation to (outer, inner) counts, with a missing inner key
    kept as its own row; the outer totals (which count those rows too) are summed
    from it.  Missing inner keys are ranked last and dropped after the ranking: a
    filter before it would be pushed below one branch's aggregate, and the branches
    could no longer share one scan and exchange.  The top outer terms (at most
    ``outer_size`` rows, a proven bound) are broadcast to filter the pairs, and the
    inner top-N per outer term is a partial-then-final group limit.
    """
    outer_count = outer_count or f"{outer}_count"
    pairs_all = (df.filter(F.col(outer).isNotNull())
                   .groupBy(outer, inner).agg(F.count(F.lit(1)).alias(inner_count)))
    outer_totals = pairs_all.groupBy(outer).agg(F.sum(inner_count).alias(outer_count))
    top_outer = (outer_totals.orderBy(F.desc(outer_count), F.asc(outer)).limit(outer_size)
                 # a window without partition is fine here: at most outer_size rows
                 .withColumn(f"{outer}_rank", F.row_number().over(
                     Window.orderBy(F.desc(outer_count), F.asc(outer)))))
    kept = pairs_all.join(F.broadcast(top_outer), outer, "inner")
    ranked = top_n_per_group(kept, outer, [F.col(inner).isNull(), F.desc(inner_count), F.asc(inner)], inner_size,
                             rank_col=f"{inner}_rank")
    return ranked.filter(F.col(inner).isNotNull())


def top_regions_and_users(plays: DataFrame, n_zip: int = TERMS_SIZE, n_cust: int = TERMS_SIZE) -> DataFrame:
    """Top zip codes by plays; within each, the top customers."""
    return nested_terms(plays, "listening_zip_code", "customer_id", n_zip, n_cust,
                        outer_count="zip_count", inner_count="plays")


def level_gender_trend(enriched: DataFrame, bucket: str = "1 hour", ts_col: str = "datetime",
                       size: int = TERMS_SIZE) -> DataFrame:
    """Count by membership level (top terms), time bucket and gender (top terms per level+bucket)."""
    return level_gender_from_counts(
        enriched.groupBy(F.col("Level"), F.window(F.col(ts_col), bucket).start.alias("bucket_start"), F.col("gender"))
                .agg(F.count(F.lit(1)).alias("plays")), size)


def level_gender_from_counts(counts: DataFrame, size: int = TERMS_SIZE) -> DataFrame:
    """``level_gender_trend`` from its counts (Level, bucket_start, gender, plays)."""
    # Level totals (which include plays without a gender) are summed from the counts,
    # and the top levels (at most ``size`` rows) filter them.
    all_counts = counts.filter(F.col("Level").isNotNull())
    totals = all_counts.groupBy("Level").agg(F.sum("plays").alias("level_count"))
    top_levels = totals.orderBy(F.desc("level_count"), F.asc("Level")).limit(size).select("Level")
    counts = (all_counts.filter(F.col("gender").isNotNull())
                        .join(F.broadcast(top_levels), "Level", "inner"))
    return top_n_per_group(counts, ["Level", "bucket_start"], [F.desc("plays"), F.asc("gender")],
                           size, rank_col="gender_rank")


def range_label(lo: int | None, hi: int | None) -> str:
    return f"{'*' if lo is None else lo}-{'*' if hi is None else hi}"


def range_bucket(df: DataFrame, col: str, ranges: Sequence[tuple[int | None, int | None]],
                 label_col: str = "range") -> DataFrame:
    """One output row per (input row, matching range); ranges are half-open [lo, hi).

    Ranges may overlap or leave gaps; open ends are None (null bounds, doubles like
    the range aggregation's keys).  The ranges are an inline array filtered per row
    and exploded: a narrow operator, no join.
    """
    spec = F.array(*[F.struct(F.lit(range_label(lo, hi)).alias("label"),
                              F.lit(lo).cast("double").alias("lo"),
                              F.lit(hi).cast("double").alias("hi")) for lo, hi in ranges])
    v = F.col(col)

    def hit(r):
        return ((r["lo"].isNull() | (v >= r["lo"])) & (r["hi"].isNull() | (v < r["hi"])))

    return (df.withColumn("_r", F.explode(F.filter(spec, hit)))
              .withColumn(label_col, F.col("_r.label"))
              .withColumn(f"{label_col}_from", F.col("_r.lo"))
              .withColumn(f"{label_col}_to", F.col("_r.hi"))
              .drop("_r"))


def range_terms(df: DataFrame, range_col: str, ranges, term: str, size: int = TERMS_SIZE) -> DataFrame:
    """Count by age range x term, top ``size`` terms per range."""
    return range_terms_from_counts(range_term_counts(df, range_col, ranges, term), term, size)


def range_term_counts(df: DataFrame, range_col: str, ranges, term: str) -> DataFrame:
    """Plays per age range and term (also valid on streams)."""
    return (range_bucket(df.filter(F.col(term).isNotNull()), range_col, ranges, "age_range")
            .groupBy("age_range", "age_range_from", "age_range_to", term)
            .agg(F.count(F.lit(1)).alias("plays")))


def range_terms_from_counts(counts: DataFrame, term: str, size: int = TERMS_SIZE) -> DataFrame:
    """``range_terms`` from its counts."""
    return top_n_per_group(counts, "age_range", [F.desc("plays"), F.asc(term)], size,
                           rank_col=f"{term}_rank")


def applink_by_age(enriched: DataFrame, ranges=None) -> DataFrame:
    return range_terms(enriched, "age", ranges or APPLINK_AGE_RANGES, "LinkedWithApps")


def level_by_age(enriched: DataFrame, ranges=None) -> DataFrame:
    return range_terms(enriched, "age", ranges or LEVEL_AGE_RANGES, "Level")


def demographics(enriched: DataFrame, ts_col: str = "datetime") -> DataFrame:
    """Listener mix: share of plays by gender, age decade, device and hour of day.

    One scan: each play yields one (dimension, value) pair per dimension, counted by
    a hash aggregate with map-side combine; shares come from per-dimension totals.
    """
    pairs = F.array(
        F.struct(F.lit("gender").alias("dimension"), F.col("gender").alias("value")),
        F.struct(F.lit("age_group").alias("dimension"),
                 (F.floor(F.col("age") / 10) * 10).cast("string").alias("value")),
        F.struct(F.lit("device").alias("dimension"),
                 F.when(F.col("ismobile") == 1, F.lit("mobile")).when(F.col("ismobile").isNotNull(), F.lit("pc"))
                  .alias("value")),
        F.struct(F.lit("hour").alias("dimension"), F.hour(F.col(ts_col)).cast("string").alias("value")),
    )
    counts = (enriched.select(F.inline(pairs))
                      .filter(F.col("value").isNotNull())
                      .groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("plays")))
    return share_of_total(counts, "dimension", "plays", "share")
