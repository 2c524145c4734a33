"""Set operations: union of sources, new members only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_streams(*dfs: DataFrame) -> DataFrame:
    """UNION ALL by column name of several sources (batch or streaming)."""
    if not dfs:
        raise ValueError("need at least one DataFrame")
    return reduce(lambda a, b: a.unionByName(b), dfs)


def new_members(candidates: DataFrame, existing: DataFrame, key: str = "customer_id") -> DataFrame:
    """Keys in ``candidates`` that are not yet in ``existing``, each once."""
    return candidates.select(key).distinct().join(existing.select(key), key, "left_anti")
