"""Inputs that several registered queries derive from the adapter's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatstream.operators import joins as J
from beatstream.operators import profile as PR
from beatstream.sources import testdata as T


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    """Plays with the customer attributes."""
    return J.enrich_with_customer(T.plays(spark, sf), T.customers(spark, sf))


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Stand-in predictions derived from the data: the click label of each customer."""
    feats = PR.build_features(T.plays(spark, sf), T.clicks(spark, sf))
    return feats.select("customer_id", F.col("label").cast("int").alias("pred"))
