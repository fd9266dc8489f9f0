"""Activity per zone, week and month (M-27)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.functions.temporal import month_start, week_start
from martkit.operators.joins import outer_metrics
from martkit.plans.travel import events_of, nearest_city
from martkit.session import staged

_GRAIN = ["month", "week", "zone_id"]


def zone_stats(events: DataFrame, cities: DataFrame, keep_unplaced: bool = False) -> DataFrame:
    """Messages, registrations, reactions and subscriptions per zone.

    A registration is a user's first message. Reactions and subscriptions
    count in the user's current city; users who never wrote are left out, or
    counted under a null zone with ``keep_unplaced``. Month totals repeat on
    each week row of the month.

    Messages are placed once and reduced to (user, month, week, zone), from
    which first message, current city and all counts follow.
    """
    placed = nearest_city(events, cities).filter(F.col("user_id").isNotNull())
    at = F.struct("message_ts", "message_id")
    presence = placed.groupBy(
        "user_id",
        month_start("message_ts").alias("month"),
        week_start("message_ts").alias("week"),
        F.col("city").alias("zone_id"),
    ).agg(F.count("*").alias("n"), F.min(at).alias("first_at"), F.max(at).alias("last_at"))
    presence = staged(presence, "presence")

    registered = (
        presence.groupBy("user_id")
        .agg(F.min_by(F.struct(*_GRAIN), "first_at").alias("_row"))
        .select("_row.*", F.lit(1).alias("n"))
    )
    current = presence.groupBy("user_id").agg(F.max_by("zone_id", "last_at").alias("zone_id"))
    reactions = _counted(events_of(events, "reaction"), "reaction_from", current, keep_unplaced)
    subscriptions = _counted(events_of(events, "subscription"), "user", current, keep_unplaced)
    cells = outer_metrics(
        [
            _cells(presence, "message"),
            _cells(registered, "user"),
            _cells(reactions, "reaction"),
            _cells(subscriptions, "subscription"),
        ],
        _GRAIN,
    )
    return _with_totals(staged(cells, "zone-cells"))


def _counted(events: DataFrame, user: str, current: DataFrame, keep_unplaced: bool) -> DataFrame:
    """Events reduced to (user, month, week) before the city is joined."""
    per_user = events.groupBy(
        F.col(f"event.{user}").alias("user_id"),
        month_start("date").alias("month"),
        week_start("date").alias("week"),
    ).agg(F.count("*").alias("n"))
    per_user = per_user.filter(F.col("user_id").isNotNull())
    return per_user.join(current, "user_id", "left" if keep_unplaced else "inner")


def _cells(rows: DataFrame, metric: str) -> DataFrame:
    return rows.groupBy(*_GRAIN).agg(F.sum("n").alias(metric))


def _with_totals(cells: DataFrame) -> DataFrame:
    """Totals per (week, zone) and (month, zone) beside each (month, week, zone),
    shown where the metric has a count in that cell."""
    metrics = [c for c in cells.columns if c not in _GRAIN]

    def totals(period: str) -> DataFrame:
        return cells.groupBy(F.col(period).alias(f"_{period}"), F.col("zone_id").alias(f"_{period}_zone")).agg(
            *[F.sum(m).alias(f"_{period}_{m}") for m in metrics]
        )

    def same(period: str):
        return (F.col(period) == F.col(f"_{period}")) & F.col("zone_id").eqNullSafe(F.col(f"_{period}_zone"))

    shown = [
        F.when(F.col(m).isNotNull(), F.col(f"_{period}_{m}")).alias(f"{period}_{m}")
        for m in metrics
        for period in ("week", "month")
    ]
    return cells.join(totals("week"), same("week")).join(totals("month"), same("month")).select(*_GRAIN, *shown)
