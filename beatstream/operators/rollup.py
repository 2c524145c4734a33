"""Dashboards from an hourly rollup instead of the plays.

The rollup holds, per hour, counts and a mergeable sketch of the customers (HyperLogLog).
Any wider bucket is answered from it: counts add up exactly, sketches are united.  New plays
append partial rows for their hours, so nothing old is rebuilt; an hour may have several
partial rows, which every reader merges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatstream.functions.timeutil import duration_seconds, ntz_micros
from beatstream.operators.dashboard import AUTO_TARGET_BUCKETS, AUTO_WIDTHS
from beatstream.streaming.sinks import write_batch_output

SKETCH_BITS = 14  # 16,384 registers: a standard error of about 0.8 %


def hourly_rollup(plays: DataFrame, ts_col: str = "datetime", bits: int = SKETCH_BITS) -> DataFrame:
    """(hour_start, plays, mobile_connections, customers): the sketch of an hour's customers is binary."""
    return (plays.groupBy(F.window(F.col(ts_col), "1 hour").start.alias("hour_start"))
                 .agg(F.count(F.lit(1)).alias("plays"), F.sum("ismobile").alias("mobile_connections"),
                      F.hll_sketch_agg("customer_id", bits).alias("customers")))


def append_rollup(plays: DataFrame, path: str, batch_id: int, ts_col: str = "datetime") -> None:
    """Add the hours of new plays to the rollup table; a repeated batch replaces its own rows."""
    write_batch_output(hourly_rollup(plays, ts_col), path, batch_id)


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch_id")


def trend_from_rollup(rollup: DataFrame, bucket: str = "1 day") -> DataFrame:
    """(bucket_start, plays, mobile_connections, approx_customers) for any bucket of whole hours."""
    if duration_seconds(bucket) % 3600:
        raise ValueError("a rollup by hour answers whole hours only")
    return _merge(rollup, F.window(F.col("hour_start"), bucket).start)


def trend_auto(rollup: DataFrame, target: int = AUTO_TARGET_BUCKETS) -> DataFrame:
    """The trend with the narrowest width of at least an hour that gives at most ``target`` buckets."""
    ends = rollup.agg(F.min(ntz_micros(F.col("hour_start"))).alias("a"), F.max(ntz_micros(F.col("hour_start"))).alias("b")).first()
    span = 0 if ends.a is None else (ends.b - ends.a) // 1_000_000 + 3600
    widths = [w for w in AUTO_WIDTHS if w % 3600 == 0]
    width = next((w for w in widths if span <= w * target), widths[-1])
    return trend_from_rollup(rollup, f"{width // 3600} hours")


def _merge(rollup: DataFrame, bucket) -> DataFrame:
    return (rollup.groupBy(bucket.alias("bucket_start"))
                  .agg(F.sum("plays").alias("plays"), F.sum("mobile_connections").alias("mobile_connections"),
                       F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("approx_customers")))
