"""Window-style operators: top-N per group, share of a parent total, k-th previous gap.

All of them are written so that one hot group (a zip code or a customer holding a
third of all rows) is never sorted inside a single task:

* ``top_n_per_group`` is a ``row_number() <= n`` filter, which Spark plans with a
  partial ``WindowGroupLimit`` before the shuffle: every map task forwards at most
  n rows per group, so a hot group costs n rows per task, not its full size.
  Optional salting ranks within (group, salt) first for engines or settings
  without that partial limit (``spark.sql.optimizer.windowGroupLimitThreshold``
  below n); it stays exact because the top n of a group is inside the union of
  the sub-group top n.
* ``kth_previous_gap`` cuts each key into time buckets of a few horizons and
  carries the rows of a bucket's last horizon into the next bucket, so a window
  partition holds at most ``BUCKET_HORIZONS + 1`` horizons of one key: a hot key
  is spread over as many tasks as its history has buckets (the sort inside one
  partition spills to disk if a key is extremely dense).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatstream.functions.timeutil import ntz_micros

DEFAULT_SALT_BUCKETS = 16
# Width of a time bucket of ``kth_previous_gap``, in horizons.
BUCKET_HORIZONS = 4


def _cols(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def top_n_per_group(df: DataFrame, group: str | Sequence[str], order: Sequence[Column], n: int,
                    rank_col: str = "rank", salt_by: str | Sequence[str] | None = None,
                    salt_buckets: int = DEFAULT_SALT_BUCKETS) -> DataFrame:
    """Keep the first ``n`` rows of each group under ``order`` (a total order), with rank.

    ``salt_by`` (optional) names the columns that identify a row inside its group;
    rows are then ranked in ``salt_buckets`` sub-groups first (one more shuffle).
    """
    group = _cols(group)
    if salt_by is not None and salt_buckets > 1:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in _cols(salt_by)]), F.lit(salt_buckets))
        pre = Window.partitionBy(*group, salt).orderBy(*order)
        df = (df.withColumn("_pre_rank", F.row_number().over(pre))
                .filter(F.col("_pre_rank") <= n).drop("_pre_rank"))
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def share_of_total(df: DataFrame, group: str | Sequence[str] | None, count_col: str = "count",
                   share_col: str = "share") -> DataFrame:
    """``count / sum(count)`` within the parent group (pie-chart slice proportion).

    Meant for aggregated input (one row per slice).  The parent totals are
    aggregated separately and joined back, so no window holds a whole group.
    """
    if not group:
        # Scalar subquery: Spark computes the total once and inlines the value.
        total = df.select(F.sum(count_col)).scalar()
        return df.withColumn(share_col, F.col(count_col) / total)
    group = _cols(group)
    totals = df.groupBy(*group).agg(F.sum(count_col).alias("_total"))
    return (df.join(totals, group, "inner")
              .withColumn(share_col, F.col(count_col) / F.col("_total")).drop("_total"))


def _micros(ts: Column) -> Column:
    return ntz_micros(ts)


def kth_previous_gap(df: DataFrame, keys: Sequence[str], k: int, horizon_seconds: int,
                     ts_col: str = "datetime", tie_col: str = "event_id",
                     gap_col: str = "gap_seconds") -> DataFrame:
    """Seconds since the k-th previous row of the same key, when that gap is within the horizon.

    Rows are ordered by (ts, tie).  The gap is null when the row has fewer than k
    predecessors or when the k-th predecessor is older than ``horizon_seconds``.
    Exact: a predecessor within the horizon of a row lies in the row's bucket or in
    the carried last horizon of the bucket before, and a partition's rows form a
    contiguous run of the key's global order; a predecessor outside the partition
    is older than the horizon.
    """
    keys = list(keys)
    horizon = horizon_seconds * 1_000_000
    width = BUCKET_HORIZONS * horizon
    us = _micros(F.col(ts_col))
    base = df.withColumn("_us", us).withColumn("_b0", F.floor(F.col("_us") / F.lit(width)))
    # One scan: each row goes to its own bucket; rows in the last horizon of a bucket
    # are also carried into the next one (1 + 1/BUCKET_HORIZONS rows shuffled).
    own = F.struct(F.col("_b0").alias("_bucket"), F.lit(True).alias("_own"))
    carried = F.struct((F.col("_b0") + 1).alias("_bucket"), F.lit(False).alias("_own"))
    near_end = F.col("_us") >= (F.col("_b0") + 1) * F.lit(width) - F.lit(horizon)
    copies = F.when(near_end, F.array(own, carried)).otherwise(F.array(own))
    both = base.select(*base.columns, F.inline(copies)).drop("_b0")
    w = Window.partitionBy(*keys, "_bucket").orderBy(F.col(ts_col), F.col(tie_col))
    prev = F.lag("_us", k).over(w)
    gap = F.when(F.col("_us") - prev <= F.lit(horizon), (F.col("_us") - prev) / F.lit(1_000_000.0))
    return (both.withColumn(gap_col, gap)
                .filter(F.col("_own"))
                .drop("_us", "_bucket", "_own"))
