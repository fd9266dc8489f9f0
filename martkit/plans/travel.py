"""Messages placed in cities, and the travel mart (M-25, M-26)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.functions.temporal import local_time
from martkit.operators.aggregates import chunked_lists, joined_chunks
from martkit.operators.islands import islands
from martkit.operators.spatial import nearest
from martkit.session import staged

CHUNK = 10_000


def events_of(events: DataFrame, kind: str) -> DataFrame:
    """Events of one type (FLT-8)."""
    return events.filter(F.col("event_type") == kind)


def messages(events: DataFrame) -> DataFrame:
    """Located messages: message_id, user_id, message_ts, lat, lon."""
    return (
        events_of(events, "message")
        .select(
            "message_id",
            F.col("event.message_from").alias("user_id"),
            F.col("event.message_ts").alias("message_ts"),
            "lat",
            "lon",
        )
        .dropna(subset=["message_ts", "lat", "lon"])
    )


def nearest_city(events: DataFrame, cities: DataFrame) -> DataFrame:
    """Each message with its nearest city (M-25), one row per message."""
    return nearest(messages(events), cities)


def stays_of(events: DataFrame, cities: DataFrame) -> DataFrame:
    """Stays of each user in a city, numbered in order of arrival."""
    placed = nearest_city(events, cities).filter(F.col("user_id").isNotNull())
    return staged(islands(placed, "user_id", ["message_ts", "message_id"], "city", stage_runs=True), "stays")


def travel_chunks(stays: DataFrame, size: int = CHUNK) -> DataFrame:
    """The cities of each user in order, ``size`` to a row: the form for users
    with any number of stays."""
    return chunked_lists(stays, ["user_id"], "island", "city", size)


def user_travel(
    events: DataFrame, cities: DataFrame, zones: DataFrame, home_days: int = 27, strict_current: bool = False
) -> DataFrame:
    """Current city, home city, travels and local time per user (M-26).

    The home city is that of the latest stay of at least ``home_days`` days;
    with ``strict_current`` only the current stay counts. The array lists the
    stays in order of arrival; it is built in chunks, and put together last.
    """
    stays = stays_of(events, cities)
    arrays = joined_chunks(travel_chunks(stays), ["user_id"], "travel_array")
    long = F.datediff("last_at", "first_at") >= home_days
    per_user = stays.groupBy("user_id").agg(
        F.max_by(F.struct("city", "last_at", long.alias("long")), "island").alias("_now"),
        F.max_by(F.when(long, F.col("city")), F.when(long, F.col("island"))).alias("_home"),
        F.max("island").alias("travel_count"),
    ).join(arrays, "user_id")
    home = F.when(F.col("_now.long"), F.col("_now.city")) if strict_current else F.col("_home")
    rows = per_user.select(
        "user_id",
        F.col("_now.city").alias("act_city"),
        home.alias("home_city"),
        "travel_count",
        "travel_array",
        F.col("_now.last_at").alias("_utc"),
    )
    return with_local_time(rows, "act_city", "_utc", zones).drop("_utc")


def with_local_time(df: DataFrame, city: str, utc: str, zones: DataFrame) -> DataFrame:
    """``local_time`` in the zone of the city; null where the zone is unknown."""
    known = zones.select(F.col("city").alias(city), "zone")
    return df.join(known, city, "left").withColumn("local_time", local_time(F.col(utc), F.col("zone"))).drop("zone").select(
        *df.columns, "local_time"
    )
