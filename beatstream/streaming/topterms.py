"""Top terms of a stream in bounded space, with lower and upper bounds of every count.

A summary holds at most ``capacity`` terms with a lower and an upper bound of their count, and a
``floor``: no term outside the summary occurred more often.  A micro-batch is counted exactly,
cut to its own ``capacity`` most frequent terms (its floor is the count of the first one left
out) and merged: bounds add up, a term that one side lacks adds that side's floor to its upper
bound.  Of the merged terms those with the largest upper bounds stay; the floor becomes the
largest upper bound left out.  While no more terms than ``capacity`` occur, both bounds are the
exact counts.

Every batch writes its summary to a folder of its own, from the one before it, so a repeated
batch replaces its own.  The exact form, which keeps every term, is ``live.keep_totals``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beatstream.operators.dashboard import TERMS_SIZE
from beatstream.operators.windows import top_n_per_group
from beatstream.streaming.flows import start

CAPACITY = 10_000


def summarise(rows: DataFrame, by: list[str], capacity: int = CAPACITY) -> DataFrame:
    """(``by``, lower, upper, floor) of some rows: exact counts of their most frequent terms; the floor on every row."""
    counts = rows.dropna(subset=by).groupBy(*by).agg(F.count(F.lit(1)).alias("lower"))
    return _cut(counts.withColumn("upper", F.col("lower")), by, F.lit(0), capacity)


def merge(old: DataFrame, new: DataFrame, by: list[str], capacity: int = CAPACITY) -> DataFrame:
    """The summary of what two summaries count."""
    floor_old, floor_new = (d.select(F.coalesce(F.max("floor"), F.lit(0))).scalar() for d in (old, new))
    a = old.select(*by, F.col("lower").alias("la"), F.col("upper").alias("ua"))
    b = new.select(*by, F.col("lower").alias("lb"), F.col("upper").alias("ub"))
    both = a.join(b, by, "full").select(
        *by, (F.coalesce("la", F.lit(0)) + F.coalesce("lb", F.lit(0))).alias("lower"),
        (F.coalesce("ua", floor_old) + F.coalesce("ub", floor_new)).alias("upper"))
    return _cut(both, by, floor_old + floor_new, capacity)


def _cut(terms: DataFrame, by: list[str], floor, capacity: int) -> DataFrame:
    """The ``capacity`` terms with the largest upper bounds; the floor is at least that of the terms left out."""
    first = terms.orderBy(F.desc("upper"), *by).limit(capacity + 1)  # a bounded top-k, not a sort of all
    place = F.row_number().over(Window.orderBy(F.desc("upper"), *by))
    least = F.max(F.when(F.col("place") > capacity, F.col("upper"))).over(Window.partitionBy())
    return (first.withColumn("place", place).withColumn("floor", F.greatest(F.coalesce(least, F.lit(0)), floor).cast("long"))
            .where(F.col("place") <= capacity).select(*by, "lower", "upper", "floor"))


def keep_top_terms(events: DataFrame, path: str, groups: dict[str, list[str]], capacity: int = CAPACITY,
                   checkpoint: str | None = None, trigger: dict | None = None):
    """Start a query that keeps one summary below ``path`` for each of ``groups`` (name -> columns)."""
    spark = events.sparkSession

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            for name, by in groups.items():
                new = summarise(batch, by, capacity)
                if batch_id > 0:
                    new = merge(spark.read.parquet(f"{path}/{name}/batch={batch_id - 1}"), new, by, capacity)
                new.write.mode("overwrite").parquet(f"{path}/{name}/batch={batch_id}")
        finally:
            batch.unpersist()

    return start(events, handle, checkpoint, trigger)


def read_summary(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The newest summary (``by``, lower, upper, floor)."""
    stored = spark.read.parquet(f"{path}/{name}")
    return stored.where(F.col("batch") == stored.select(F.max("batch")).scalar()).drop("batch")


def top_terms(summary: DataFrame, by: list[str], size: int = TERMS_SIZE) -> DataFrame:
    """The ``size`` terms with the largest lower bounds; ``certain`` where no other term can have more."""
    best = summary.orderBy(F.desc("lower"), *by).limit(size + 1)
    place = F.row_number().over(Window.orderBy(F.desc("lower"), *by))
    ranked = best.withColumn("rank", place)
    rest = summary.join(ranked.where(F.col("rank") <= size).select(*by), by, "left_anti") \
        .select(F.max("upper")).scalar()
    return (ranked.where(F.col("rank") <= size)
            .withColumn("certain", F.col("lower") >= F.greatest(F.coalesce(rest, F.lit(0)), F.col("floor")))
            .select(*by, "lower", "upper", "rank", "certain"))


def nested_top_terms(outer: DataFrame, pairs: DataFrame, outer_col: str, inner_col: str, size: int = TERMS_SIZE) -> DataFrame:
    """Top outer terms and, inside each, the top inner terms, with the bounds of both."""
    top = top_terms(outer, [outer_col], size).select(
        outer_col, F.col("lower").alias("outer_lower"), F.col("upper").alias("outer_upper"), F.col("rank").alias("outer_rank"))
    # at most ``size`` rows
    kept = pairs.join(F.broadcast(top), outer_col)
    return top_n_per_group(kept, outer_col, [F.desc("lower"), F.asc(inner_col)], size, rank_col="rank").drop("floor")
