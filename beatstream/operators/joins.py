"""Equi-lookups of plays against dimension tables (batch and stream-static).

No join here forces a broadcast.  Catalyst broadcasts a dimension only when its
size estimate is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
plans a sort-merge join; AQE re-plans at runtime and splits skewed partitions of a
hot customer.  Dimensions are projected to the needed columns; their keys are
primary keys (``is_member`` de-duplicates its set first, since a set may repeat).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatstream.schemas import CUSTOMER_ATTRIBUTES, ENRICHED_COLUMNS

ON_MISSING = ("null", "drop", "fail")


DEFAULT_HOT_SALTS = 16


def _salted(left: DataFrame, dim: DataFrame, key: str, hot_keys: list | None,
            salts: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Spread the rows of known hot keys over ``salts`` join keys.

    Rows of a hot key get a salt from their own hash; the dimension row of a hot
    key is replicated once per salt (only hot keys: the dimension grows by
    ``len(hot_keys) * (salts - 1)`` rows).  Other keys keep salt 0.  Used where
    AQE cannot split skew at runtime (stream-static joins in micro-batches).
    """
    if not hot_keys or salts <= 1:
        return left, dim, [key]
    hot_l = F.col(key).isin(list(hot_keys))
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
    left = left.withColumn("_salt", F.when(hot_l, F.pmod(row_hash, F.lit(salts))).otherwise(F.lit(0)))
    copies = F.when(F.col(key).isin(list(hot_keys)), F.sequence(F.lit(0), F.lit(salts - 1))) \
              .otherwise(F.array(F.lit(0).cast("long")))
    dim = dim.withColumn("_salt", F.explode(copies.cast("array<long>")))
    return left, dim, [key, "_salt"]


def _lookup(left: DataFrame, dim: DataFrame, key: str, cols: list[str], on_missing: str,
            what: str, hot_keys: list | None = None, salts: int = DEFAULT_HOT_SALTS) -> DataFrame:
    if on_missing not in ON_MISSING:
        raise ValueError(f"on_missing must be one of {ON_MISSING}")
    dim = dim.select(key, *cols, F.lit(True).alias("_hit"))
    left, dim, on = _salted(left, dim, key, hot_keys, salts)
    if on_missing == "drop":
        return left.join(dim, on, "inner").drop("_hit", "_salt")
    out = left.join(dim, on, "left").drop("_salt")
    if on_missing == "fail":
        # The check must sit inside columns the caller keeps: a helper column that is
        # dropped afterwards would be pruned by the optimizer and never evaluated.
        err = F.raise_error(F.concat(F.lit(f"no {what} for key "), F.col(key).cast("string")))
        for c in [key, *cols]:
            out = out.withColumn(c, F.when(F.col("_hit").isNull(), err).otherwise(F.col(c)))
    return out.drop("_hit")


def enrich_with_customer(plays: DataFrame, customers: DataFrame, on_missing: str = "null",
                         ingest_time: bool = False, key: str = "customer_id",
                         hot_keys: list | None = None, salts: int = DEFAULT_HOT_SALTS) -> DataFrame:
    """Add the ten customer attributes to each play (left lookup by customer id).

    ``on_missing``: "null" keeps the play with null attributes, "drop" removes it,
    "fail" raises like the reference does.  ``ingest_time`` adds ``@timestamp``.
    ``hot_keys`` (e.g. from ``hot_keys()``) salts those customers over ``salts``
    join keys; batch joins get the same from AQE's skew-join split.
    """
    out = _lookup(plays, customers, key, CUSTOMER_ATTRIBUTES, on_missing, "customer", hot_keys, salts)
    if ingest_time:
        out = out.withColumn("@timestamp", F.current_timestamp().cast("timestamp_ntz"))
    return out


def flag_ad_targets(enriched: DataFrame, predictions: DataFrame, on_missing: str = "null",
                    key: str = "customer_id", hot_keys: list | None = None,
                    salts: int = DEFAULT_HOT_SALTS) -> DataFrame:
    """Look up each customer's prediction and add it as ``SendEvent``."""
    preds = predictions.select(key, F.col("pred").cast("int").alias("SendEvent"))
    return _lookup(enriched, preds, key, ["SendEvent"], on_missing, "prediction", hot_keys, salts)


def enrich_and_flag(plays: DataFrame, customers: DataFrame, predictions: DataFrame, on_missing: str = "null",
                    ingest_time: bool = False, key: str = "customer_id", hot_keys: list | None = None,
                    salts: int = DEFAULT_HOT_SALTS) -> DataFrame:
    """Customer attributes and ``SendEvent`` in one lookup.

    Customers and predictions (one row per key each) are joined with each other first, so
    the plays take part in a single join.  Two lookups in a row on one key would share a
    partitioning, which AQE then leaves unsplit however hot a customer is.  With ``drop``
    and ``fail`` a play needs both a customer and a prediction.
    """
    known = customers.select(key, *CUSTOMER_ATTRIBUTES)
    preds = predictions.select(key, F.col("pred").cast("int").alias("SendEvent"))
    both = known.join(preds, key, "full" if on_missing == "null" else "inner")
    out = _lookup(plays, both, key, [*CUSTOMER_ATTRIBUTES, "SendEvent"], on_missing,
                  "customer with a prediction", hot_keys, salts)
    if ingest_time:
        out = out.withColumn("@timestamp", F.current_timestamp().cast("timestamp_ntz"))
    return out


def hot_keys(df: DataFrame, key: str = "customer_id", min_share: float = 0.01) -> list:
    """Every key holding at least ``min_share`` of the rows, the largest first.

    The share bounds the list: at most ``1 / min_share`` rows reach the driver.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = df.select(F.count(F.lit(1))).scalar()
    rows = counts.filter(F.col("_n") >= total * F.lit(min_share)).collect()
    return [r[key] for r in sorted(rows, key=lambda r: (-r["_n"], r[key]))]


def label_from_clicks(profiles: DataFrame, click_counts: DataFrame, key: str = "customer_id",
                      count_col: str = "clicks") -> DataFrame:
    """label = 1 when the customer clicked the ad at least once; no click row -> 0."""
    cc = click_counts.select(key, F.col(count_col).alias("_clicks"))
    return (profiles.join(cc, key, "left")
            .withColumn("label", (F.coalesce(F.col("_clicks"), F.lit(0)) > 0).cast("int"))
            .drop("_clicks"))


def is_member(df: DataFrame, members: DataFrame, key: str = "customer_id", how: str = "flag",
              flag_col: str = "is_member") -> DataFrame:
    """Membership test against a set table: "semi" keeps members, "anti" keeps
    non-members, "flag" adds a 0/1 column."""
    if how == "semi":
        return df.join(members.select(key), key, "left_semi")
    if how == "anti":
        return df.join(members.select(key), key, "left_anti")
    if how != "flag":
        raise ValueError("how must be semi, anti or flag")
    m = members.select(key).distinct().withColumn("_m", F.lit(1))
    return (df.join(m, key, "left")
              .withColumn(flag_col, F.coalesce(F.col("_m"), F.lit(0)))
              .drop("_m"))


def enrich_with_track(plays: DataFrame, music: DataFrame, track_key: str = "track_id") -> DataFrame:
    """Add title, artist and length of the played track."""
    m = music.select(F.col("TrackId").alias(track_key), "Title", "Artist", "Length")
    return plays.join(m, track_key, "left")


def missing_customers(plays: DataFrame, customers: DataFrame, key: str = "customer_id") -> DataFrame:
    """Customer ids of plays with no customer row, and how many plays each has.

    Plays are counted per customer first (combined before the shuffle), so the anti
    join sees one row for each customer, however often a customer plays.
    """
    counts = plays.groupBy(key).agg(F.count(F.lit(1)).alias("plays"))
    return counts.join(customers.select(key), key, "left_anti")


def index_document(enriched: DataFrame, extras: tuple[str, ...] = ("event_id", "datetime")) -> DataFrame:
    """The enriched record in its fixed field order: ``@timestamp, customer_id,
    track_id, ismobile, listening_zip_code``, the ten customer attributes, then
    ``SendEvent`` when present, then the play's own id and event time (kept here,
    dropped by the reference)."""
    cols = [c for c in ENRICHED_COLUMNS if c in enriched.columns]
    if "SendEvent" in enriched.columns:
        cols.append("SendEvent")
    cols += [c for c in extras if c in enriched.columns and c not in cols]
    return enriched.select(*[F.col(f"`{c}`") for c in cols])
