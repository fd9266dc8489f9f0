"""User pairs as undirected edges (SO-1, JN-11, JN-12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def undirected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct pairs regardless of direction: user_left holds the greater id."""
    return (
        edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
        .select(F.greatest(a, b).alias("user_left"), F.least(a, b).alias("user_right"))
        .distinct()
    )


def in_same_group(pairs: DataFrame, members: DataFrame, group: str) -> DataFrame:
    """Given pairs whose users share at least one group.

    The candidates come from elsewhere, so a group of n members is never
    turned into n * n pairs.
    """
    left = members.select(F.col("user_id").alias("user_left"), F.col(group).alias("_group")).distinct()
    right = members.select(F.col("user_id").alias("user_right"), F.col(group).alias("_group")).distinct()
    return (
        pairs.join(left, "user_left")
        .join(right, ["user_right", "_group"], "left_semi")
        .select(*pairs.columns)
        .distinct()
    )


def without(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs that are not in ``known`` (both canonical)."""
    return pairs.join(known, ["user_left", "user_right"], "left_anti")
