"""Delivery documents and the monthly courier ledger (M-16..M-18)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.functions.jsons import parse_json_column, split_corrupt
from martkit.operators.latest import latest

COURIER = T.StructType([T.StructField("_id", T.StringType()), T.StructField("name", T.StringType())])
DELIVERY = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("order_ts", T.TimestampNTZType()),
        T.StructField("delivery_id", T.StringType()),
        T.StructField("courier_id", T.StringType()),
        T.StructField("delivery_ts", T.TimestampNTZType()),
        T.StructField("rate", T.ShortType()),
        T.StructField("sum", T.DecimalType(12, 2)),
        T.StructField("tip_sum", T.DecimalType(12, 2)),
    ]
)


@dataclass(frozen=True)
class Tier:
    below: float | None
    share: str
    minimum: str


# Share of the order sum and minimum pay by average rating.
TIERS = (
    Tier(4.0, "0.05", "100.00"),
    Tier(4.5, "0.07", "150.00"),
    Tier(4.9, "0.08", "175.00"),
    Tier(None, "0.10", "200.00"),
)
PROCESSING_FEE = "0.25"
TIP_SHARE = "0.95"


def stage_documents(pages: DataFrame, id_field: str, document: str = "document", order_by: str = "loaded_at") -> DataFrame:
    """Documents by object id, the last loaded one per id (M-16)."""
    rows = pages.select(
        F.get_json_object(document, f"$.{id_field}").alias("object_id"),
        F.col(document).alias("object_value"),
        order_by,
    )
    return latest(rows.filter(F.col("object_id").isNotNull()), "object_id", [order_by, "object_value"])


def without_id(pages: DataFrame, id_field: str, document: str = "document") -> DataFrame:
    """Documents that ``stage_documents`` cannot key, the second result of it."""
    return pages.filter(F.get_json_object(document, f"$.{id_field}").isNull())


def delivery_entities(courier_docs: DataFrame, delivery_docs: DataFrame, save=None) -> dict[str, DataFrame]:
    """Couriers, orders, delivery details and sales out of the staged documents
    (M-17), plus the documents that could not be parsed. ``save(df, name)``
    stores the parsed deliveries, so that a document is parsed once only."""
    couriers, bad_couriers = split_corrupt(parse_json_column(courier_docs, "object_value", COURIER))
    parsed = parse_json_column(delivery_docs, "object_value", DELIVERY)
    deliveries, bad_deliveries = split_corrupt(save(parsed, "parsed") if save else parsed)
    per_delivery = latest(
        deliveries.select("delivery_id", "courier_id", "delivery_ts", "rate"), "delivery_id", ["delivery_ts", "courier_id"]
    )
    return {
        "couriers": couriers.select(F.col("_id").alias("courier_id"), F.col("name").alias("courier_name")),
        "orders": deliveries.select("order_id", "order_ts"),
        "details": per_delivery,
        "sales": deliveries.select("order_id", "delivery_id", F.col("sum").alias("order_sum"), "tip_sum"),
        "rejected": bad_couriers.select("_corrupt_record").unionByName(bad_deliveries.select("_corrupt_record")),
    }


def courier_ledger(
    sales: DataFrame, orders: DataFrame, details: DataFrame, couriers: DataFrame, tiers=TIERS
) -> DataFrame:
    """Monthly settlement per courier (M-18); deliveries without a courier are
    left to ``unsettled``.

    The tier depends on the average rating of the month, which is known only
    after the aggregation. So every tier's pay is summed in the same pass and
    the right sum is picked at the end: one aggregation, no second look at the
    orders. Names are joined to the monthly rows.
    """
    rows = _delivered(sales, orders, details)
    order_sum = F.col("order_sum")
    pays = [
        F.sum(F.greatest(order_sum * _exact(t.share), _exact(t.minimum))).alias(f"_pay{i}")
        for i, t in enumerate(tiers)
    ]
    month = rows.groupBy(
        F.year("order_ts").alias("settlement_year"),
        F.month("order_ts").alias("settlement_month"),
        "courier_id",
    ).agg(
        F.count("*").alias("orders_count"),
        F.sum("order_sum").alias("orders_total_sum"),
        F.avg("rate").alias("_rate"),
        F.sum("tip_sum").alias("courier_tips_sum"),
        *pays,
    )
    chosen = F.col(f"_pay{len(tiers) - 1}")
    for i, tier in reversed(list(enumerate(tiers[:-1]))):
        chosen = F.when(F.col("_rate") < F.lit(tier.below), F.col(f"_pay{i}")).otherwise(chosen)
    reward = F.col("_pay") + F.col("courier_tips_sum") * _exact(TIP_SHARE)
    return month.join(couriers, "courier_id").withColumn("_pay", chosen).select(
        "courier_id",
        "courier_name",
        "settlement_year",
        "settlement_month",
        "orders_count",
        F.col("orders_total_sum").cast("decimal(14,2)").alias("orders_total_sum"),
        F.round("_rate", 5).alias("rate_avg"),
        (F.col("orders_total_sum") * _exact(PROCESSING_FEE)).cast("decimal(14,2)").alias("order_processing_fee"),
        F.col("_pay").cast("decimal(14,2)").alias("courier_order_sum"),
        F.col("courier_tips_sum").cast("decimal(14,2)").alias("courier_tips_sum"),
        reward.cast("decimal(14,2)").alias("courier_reward_sum"),
    )


def unsettled(sales: DataFrame, orders: DataFrame, details: DataFrame, couriers: DataFrame) -> DataFrame:
    """Sales without an order, a delivery or a courier (quarantine of the ledger)."""
    settled = (
        _delivered(sales, orders, details)
        .join(couriers.select("courier_id"), "courier_id", "left_semi")
        .select("order_id")
    )
    return sales.join(settled, "order_id", "left_anti")


def _delivered(sales: DataFrame, orders: DataFrame, details: DataFrame) -> DataFrame:
    return (
        sales.join(orders, "order_id")
        .join(details.select("delivery_id", "courier_id", "rate"), "delivery_id")
        .select("order_id", "order_ts", "courier_id", "rate", "order_sum", "tip_sum")
    )


def _exact(number: str):
    scale = len(number.partition(".")[2])
    return F.lit(number).cast(f"decimal({max(len(number), scale + 1)},{scale})")
