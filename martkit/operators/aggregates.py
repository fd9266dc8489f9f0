"""Aggregation shapes (AG-*, WN-9..WN-12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_group_stat(df: DataFrame, keys, **aggregates: Column) -> DataFrame:
    """Rows with aggregates of their group.

    An aggregation joined back, not a window: the group is reduced before the
    shuffle and a large group may be split in the join.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    stats = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        *[c.alias(name) for name, c in aggregates.items()]
    )
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return df.join(stats, on, "left").drop(*[f"_{k}" for k in keys])


def cross_tab(df: DataFrame, rows: str, cols: str, values: list) -> DataFrame:
    """Counts of ``rows`` by ``cols``, one column per listed value (AG-12)."""
    return df.groupBy(rows).pivot(cols, values).count().na.fill(0)


def duplicates(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with the surplus (AG-8)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    counted = df.groupBy(*keys).agg((F.count("*") - 1).alias("surplus"))
    return counted.filter(F.col("surplus") > 0)


def ordered_list(value: str, *order: str) -> Column:
    """Aggregate: values of the group as an array in the given order (AG-11)."""
    pairs = F.collect_list(F.struct(*order, F.col(value).alias("_v")))
    return F.transform(F.array_sort(pairs), lambda x: x["_v"])


def chunked_lists(df: DataFrame, keys: list[str], position: str, value: str, size: int) -> DataFrame:
    """Long arrays as rows (keys, chunk, values) of at most ``size`` values, in
    the order of ``position``, which counts from 0 without gaps per key
    (WN-12). No row and no group grows with the array."""
    chunk = F.floor(F.col(position) / size).cast("long").alias("chunk")
    return df.groupBy(*keys, chunk).agg(ordered_list(value, position).alias("values"))


def joined_chunks(chunks: DataFrame, keys: list[str], out: str) -> DataFrame:
    """The arrays as one value per key, for a result that wants them so."""
    held = F.array_sort(F.collect_list(F.struct("chunk", "values")))
    return chunks.groupBy(*keys).agg(F.flatten(F.transform(held, lambda c: c["values"])).alias(out))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def difference(left: DataFrame, right: DataFrame, left_measure: Column, right_measure: Column, out: str) -> DataFrame:
    """One row: measure of ``left`` minus measure of ``right`` (AG-13)."""
    a = left.agg(left_measure.cast("long").alias(out))
    b = right.agg((-right_measure.cast("long")).alias(out))
    return a.unionByName(b).agg(F.sum(out).alias(out))
