"""Calendar dimension with ISO week bounds (M-12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.functions.temporal import iso_week, iso_weekday


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    bounds = spark.range(1).select(
        F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")
    )
    return calendar_between(bounds)


def calendar_between(bounds: DataFrame) -> DataFrame:
    """Calendar from a one-row table with ``start`` and ``end`` dates."""
    days = bounds.select(
        "start", F.explode(F.expr("sequence(start, end, interval 1 day)")).alias("date_actual")
    )
    weekday = iso_weekday("date_actual")
    return days.select(
        (F.datediff("date_actual", "start") + 1).alias("date_id"),
        "date_actual",
        iso_week("date_actual").alias("week_of_year"),
        F.date_sub("date_actual", weekday - 1).alias("first_day_of_week"),
        F.date_add("date_actual", 7 - weekday).alias("last_day_of_week"),
    )
