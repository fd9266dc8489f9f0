"""Campaign triggers for subscribers (M-29, ST-1..ST-5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.functions.temporal import active_at

CAMPAIGN = """restaurant_id string, adv_campaign_id string, adv_campaign_content string,
    adv_campaign_owner string, adv_campaign_owner_contact string,
    adv_campaign_datetime_start bigint, adv_campaign_datetime_end bigint, datetime_created bigint"""

LATENESS = "10 minutes"  # Fixed value: how late a campaign message may be.


def dedup_stream(df: DataFrame, keys: list[str], event_time: str, delay: str = LATENESS) -> DataFrame:
    """Each key once. The watermark comes first, so that the state of keys
    older than it is dropped; ``keys`` include the event time."""
    return df.withWatermark(event_time, delay).dropDuplicates(keys)


def campaign_triggers(stream: DataFrame, subscribers: DataFrame, now: Column | None = None) -> DataFrame:
    """One row per active campaign and subscriber of its restaurant.

    ``now`` (epoch seconds) defaults to the start of the micro-batch. Works on
    a stream or on a batch of campaigns; Spark re-reads the static side for
    every micro-batch and broadcasts it only when its size allows.
    """
    now = F.unix_timestamp() if now is None else now
    active = active_at(stream, "adv_campaign_datetime_start", "adv_campaign_datetime_end", now)
    created = active.withColumn("datetime", F.timestamp_seconds("datetime_created"))
    once = dedup_stream(created, ["adv_campaign_id", "datetime"], "datetime").drop("datetime")
    return once.join(subscribers.select("restaurant_id", "client_id"), "restaurant_id").select(
        *stream.columns, "client_id", F.current_timestamp().alias("trigger_datetime_created")
    )
