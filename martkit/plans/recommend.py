"""Friend recommendations (M-28)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.operators.pairs import undirected, without
from martkit.operators.spatial import near_members, nearest, pairs_within
from martkit.plans.travel import events_of, with_local_time
from martkit.session import staged


def last_positions(events: DataFrame) -> DataFrame:
    """Time and place of each user's last message: user_id, message_ts, lat, lon."""
    sent = events_of(events, "message").filter(F.col("event.message_from").isNotNull())
    row = F.struct(F.col("event.message_ts").alias("message_ts"), "lat", "lon")
    return (
        sent.groupBy(F.col("event.message_from").alias("user_id"))
        .agg(F.max_by(row, F.struct("event.message_ts", "message_id")).alias("_row"))
        .select("user_id", "_row.*")
    )


def friend_recommendations(
    events: DataFrame, cities: DataFrame, zones: DataFrame, ds: str, km: float = 1.0
) -> DataFrame:
    """Users of one channel who are at most ``km`` apart and never wrote to
    each other. The zone is the left user's city; the local time is the right
    user's last message in that zone.

    Channel and place are one join key, so a big channel is not paired with
    itself; only members of it who are neighbours meet. Pairs may be many more
    than users, so they bring along what is shown of them and each comes once;
    of the pairs who wrote, the near ones alone are looked up.
    """
    positions = nearest(last_positions(events), cities).drop("city_id", "distance_km")
    positions = staged(positions, "positions")
    subscribed = (
        events_of(events, "subscription")
        .select(F.col("event.subscription_channel").alias("channel"), F.col("event.user").alias("user_id"))
        .dropna()
        .distinct()
    )
    members = subscribed.join(positions.select("user_id", "lat", "lon", "city", "message_ts"), "user_id")
    near = near_members(members, "channel", km, once=True, carry=["city", "message_ts"])
    wrote = undirected(
        events_of(events, "message").select(
            F.col("event.message_from").alias("a"), F.col("event.message_to").alias("b")
        ),
        "a",
        "b",
    )
    told = staged(pairs_within(wrote, positions, km).select("user_left", "user_right"), "told")
    rows = without(near, told).select("user_left", "user_right", F.col("city_left").alias("zone_id"), F.col("message_ts_right").alias("_utc"))
    return with_local_time(rows, "zone_id", "_utc", zones).select(
        "user_left", "user_right", "zone_id", "local_time", F.lit(ds).cast("date").alias("processed_dttm")
    )
