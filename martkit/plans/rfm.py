"""Customer segmentation by recency, frequency and spend (M-1..M-4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.functions.temporal import ntz
from martkit.operators.aggregates import cross_tab
from martkit.operators.joins import left_keep
from martkit.operators.ordering import Key
from martkit.operators.rank import global_ntiles


def orders_with_status(orders: DataFrame, status_log: DataFrame, order_by=("dttm", "id")) -> DataFrame:
    """Orders with the last status of their log (M-1); orders without a log
    are left out. Equal times are decided by the log id."""
    last = status_log.groupBy("order_id").agg(
        F.max_by("status_id", F.struct(*order_by, "status_id")).alias("status")
    )
    return orders.drop("status").join(last, "order_id")


def rfm(users: DataFrame, orders: DataFrame, since: str, closed, n: int = 5) -> DataFrame:
    """Scores 1..n per user over closed orders from ``since`` on (M-2).

    Users without such orders stay, with the lowest values. Ties are decided
    by the user id.
    """
    done = _from(orders, since).filter(F.col("status") == closed)
    per_user = done.groupBy(F.col("user_id").alias("id")).agg(
        F.max("order_ts").alias("last_order_ts"),
        F.count("order_id").alias("order_count"),
        F.sum("cost").alias("total_spend"),
    )
    base = left_keep(users.select("id"), per_user, "id").select(
        F.col("id").alias("user_id"),
        "last_order_ts",
        F.coalesce("order_count", F.lit(0)).alias("order_count"),
        F.coalesce("total_spend", F.lit(0).cast("decimal(24,2)")).alias("total_spend"),
    )
    scored = global_ntiles(
        base,
        n,
        {
            "recency": ["last_order_ts", "user_id"],
            "frequency": ["order_count", "user_id"],
            "monetary_value": ["total_spend", "user_id"],
        },
    )
    return scored.select("user_id", "recency", "frequency", "monetary_value")


def rfm_recency_any(
    users: DataFrame, orders: DataFrame, since: str, closed, cancelled, n: int = 5, no_spend_first: bool = False
) -> DataFrame:
    """Stepwise variant (M-3): recency counts any order that is not cancelled.

    Spend stays null for users without closed orders; they come last in the
    spend order unless ``no_spend_first``.
    """
    recent = _from(orders, since)
    is_closed = F.col("status") == closed
    kept = F.coalesce(F.col("status") != cancelled, F.lit(True))
    per_user = recent.groupBy(F.col("user_id").alias("id")).agg(
        F.max(F.when(kept, F.col("order_ts"))).alias("last_order_ts"),
        F.count(F.when(is_closed, F.col("order_id"))).alias("order_count"),
        F.sum(F.when(is_closed, F.col("cost"))).alias("total_spend"),
    )
    base = left_keep(users.select("id"), per_user, "id").select(
        F.col("id").alias("user_id"),
        "last_order_ts",
        F.coalesce("order_count", F.lit(0)).alias("order_count"),
        "total_spend",
    )
    scored = global_ntiles(
        base,
        n,
        {
            "recency": ["last_order_ts", "user_id"],
            "frequency": ["order_count", "user_id"],
            "monetary_value": [Key("total_spend", nulls_first=no_spend_first), Key("user_id")],
        },
    )
    return scored.select("user_id", "recency", "frequency", "monetary_value")


def rfm_matrix(scores: DataFrame, n: int = 5) -> DataFrame:
    """Users by recency (rows) and frequency (columns ``1``..``n``) (M-4)."""
    return cross_tab(scores, "recency", "frequency", list(range(1, n + 1)))


def _from(orders: DataFrame, since: str) -> DataFrame:
    return orders.filter(F.col("order_ts") >= ntz(since))
