"""Gaps and islands: runs of equal values in time order (WN-6, WN-7, WN-8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martkit.session import staged


def islands(
    df: DataFrame, key, order, value: str, slice_by: Column | None = None, stage_runs: bool = False
) -> DataFrame:
    """Runs of equal ``value`` per key: key, island, value, first_at, last_at, n.

    ``order`` is total and starts with the time column. Islands are numbered
    from 0, so the last number is the count of changes. The rows of a key are
    cut into time slices (hours by default) that are scanned separately, so a
    key holding a large share of the table is spread over many tasks; what is
    left per key is one row per slice, which is stitched together.

    The runs within slices are read twice, for the stitching and for the
    result. ``stage_runs`` writes them down in between, which saves a second
    sort of a large table.
    """
    key = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, str) else list(order)
    time = order[0]
    slice_by = F.date_trunc("hour", time) if slice_by is None else slice_by
    rows = df.select(*key, *order, F.col(value).alias("_value"), slice_by.alias("_slice"))

    in_slice = W.partitionBy(*key, "_slice").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    changed = _differs(F.lag("_value").over(in_slice), F.row_number().over(in_slice) > 1)
    runs = (
        rows.withColumn("_changed", changed)
        .withColumn("_local", F.sum("_changed").over(in_slice.rowsBetween(W.unboundedPreceding, 0)))
        .groupBy(*key, "_slice", "_local", "_value")
        .agg(F.min(time).alias("_first"), F.max(time).alias("_last"), F.count("*").alias("_n"))
    )

    if stage_runs:
        runs = staged(runs, "runs")

    edges = runs.groupBy(*key, "_slice").agg(
        F.min_by("_value", "_local").alias("_value"),
        F.max_by("_value", "_local").alias("_tail"),
        F.max("_local").alias("_changes"),
    )
    by_slice = W.partitionBy(*key).orderBy(F.col("_slice").asc_nulls_first())
    border = _differs(F.lag("_tail").over(by_slice), F.row_number().over(by_slice) > 1)
    offsets = (
        edges.withColumn("_step", border + F.lag("_changes", 1, 0).over(by_slice))
        .withColumn("_offset", F.sum("_step").over(by_slice.rowsBetween(W.unboundedPreceding, 0)))
        .select(*[F.col(c).alias(f"_at_{c}") for c in key + ["_slice"]], "_offset")
    )
    on = [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in key + ["_slice"]]
    return (
        runs.join(offsets, on)
        .withColumn("island", F.col("_offset") + F.col("_local"))
        .groupBy(*key, "island", F.col("_value").alias(value))
        .agg(
            F.min("_first").alias("first_at"),
            F.max("_last").alias("last_at"),
            F.sum("_n").alias("n"),
        )
    )


def _differs(previous: Column, has_previous: Column) -> Column:
    return F.when(has_previous & ~F.col("_value").eqNullSafe(previous), 1).otherwise(0)
