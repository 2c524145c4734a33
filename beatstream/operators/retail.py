"""Retail example: cost per line and daily spend per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatstream.functions.scalar import total_cost


def with_total_cost(retail: DataFrame) -> DataFrame:
    return retail.withColumn("total_cost", total_cost(F.col("UnitPrice"), F.col("Quantity")))


def daily_spend(retail: DataFrame, ts_col: str = "InvoiceDate", period: str = "1 day") -> DataFrame:
    """Sum of ``UnitPrice * Quantity`` per customer per tumbling day.

    Money is summed as decimal(18,2) so the total does not depend on the order in
    which partitions are combined.
    """
    cost = total_cost(F.col("UnitPrice"), F.col("Quantity")).cast("decimal(18,2)")
    return (retail.groupBy("CustomerId", F.window(F.col(ts_col), period).start.alias("day_start"))
                  .agg(F.sum(cost).cast("double").alias("total_cost")))


def top_spenders(retail: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` largest daily totals (``show(5)`` of the example, with an order)."""
    return daily_spend(retail).orderBy(F.desc("total_cost"), F.asc("CustomerId"),
                                       F.asc("day_start")).limit(n)
