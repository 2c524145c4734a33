"""Hashtag counting and ranking (batch form; the sliding stream form is in
``beatstream.streaming.flows``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatstream.functions.scalar import hashtags

TOP_TAGS = 10


def tag_counts(messages: DataFrame, text_col: str = "text") -> DataFrame:
    """Occurrences per normalised tag (``tag``, ``amount``)."""
    tags = hashtags(messages.select(text_col), text_col, keep=[])
    return tags.groupBy("tag").agg(F.count(F.lit(1)).alias("amount"))


def rank_tags(counts: DataFrame) -> DataFrame:
    """Order by amount descending, then tag ascending."""
    return counts.orderBy(F.desc("amount"), F.asc("tag"))


def top_n(df_sorted: DataFrame, n: int = TOP_TAGS) -> DataFrame:
    """First ``n`` rows of a sorted frame; planned as TakeOrderedAndProject
    (each partition keeps n, one small merge)."""
    return df_sorted.limit(n)


def trending_tags_batch(messages: DataFrame, n: int = TOP_TAGS) -> DataFrame:
    return top_n(rank_tags(tag_counts(messages)), n)
