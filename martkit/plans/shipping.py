"""Shipping log to dimensions, facts and mart (M-5..M-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.functions.temporal import whole_days
from martkit.functions.text import part
from martkit.operators.rank import surrogate_key

RATE = "decimal(14,3)"
BOOKED, RECEIVED = "booked", "recieved"  # Fixed values: states as the sources spell them.
MILESTONES = ("shipping_start_fact_datetime", "shipping_end_fact_datetime")


def country_rates(log: DataFrame) -> DataFrame:
    """Distinct (country, base rate) with a generated key (M-5)."""
    pairs = log.select("shipping_country", "shipping_country_base_rate").distinct()
    return surrogate_key(pairs, ["shipping_country", "shipping_country_base_rate"], "shipping_country_id")


def agreements(log: DataFrame) -> DataFrame:
    """Distinct agreements out of ``id:number:rate:commission`` (M-6)."""
    text = F.col("vendor_agreement_description")
    return (
        log.select("vendor_agreement_description")
        .distinct()
        .select(
            part(text, 1, as_type="bigint").alias("agreementid"),
            part(text, 2).alias("agreement_number"),
            part(text, 3, as_type=RATE).alias("agreement_rate"),
            part(text, 4, as_type=RATE).alias("agreement_commission"),
        )
        .distinct()
    )


def transfers(log: DataFrame) -> DataFrame:
    """Distinct (type, model, rate) out of ``type:model`` with a generated key (M-7)."""
    text = F.col("shipping_transfer_description")
    kinds = (
        log.select("shipping_transfer_description", "shipping_transfer_rate")
        .distinct()
        .select(
            part(text, 1).alias("transfer_type"),
            part(text, 2).alias("transfer_model"),
            "shipping_transfer_rate",
        )
        .distinct()
    )
    return surrogate_key(kinds, ["transfer_type", "transfer_model", "shipping_transfer_rate"], "transfer_type_id")


def shipments(log: DataFrame, tie=("id",), booked: str = BOOKED, received: str = RECEIVED) -> DataFrame:
    """What the log says of each shipment, in one aggregation: its terms (a row
    for each distinct set of them), last state, first booking and last receipt.
    Facts and mart are made from it, so the log is shuffled once."""
    transfer, agreement = F.col("shipping_transfer_description"), F.col("vendor_agreement_description")
    terms = F.struct(
        "shipping_plan_datetime",
        "payment_amount",
        "vendorid",
        "shipping_country",
        "shipping_country_base_rate",
        part(transfer, 1).alias("transfer_type"),
        part(transfer, 2).alias("transfer_model"),
        "shipping_transfer_rate",
        part(agreement, 1, as_type="bigint").alias("agreementid"),
    )
    facts = log.groupBy("shippingid").agg(F.collect_set(terms).alias("_terms"), *_milestones(tie, booked, received))
    return facts.select("*", F.explode("_terms").alias("_t")).select("shippingid", "_last.*", *MILESTONES, "_t.*")


def shipping_info(ships: DataFrame, countries: DataFrame, transfer_kinds: DataFrame) -> DataFrame:
    """Distinct shipments with dimension keys (M-8).

    Looked up by name and rate, so a changed rate does not multiply rows.
    """
    return _with_keys(ships, countries, transfer_kinds).select(
        "shippingid",
        "shipping_plan_datetime",
        "payment_amount",
        "vendorid",
        "shipping_country_id",
        "transfer_type_id",
        "agreementid",
    )


def _with_keys(ships: DataFrame, countries: DataFrame, transfer_kinds: DataFrame) -> DataFrame:
    return ships.join(countries, ["shipping_country", "shipping_country_base_rate"], "left").join(
        transfer_kinds, ["transfer_type", "transfer_model", "shipping_transfer_rate"], "left"
    )


def shipping_status(log: DataFrame, tie=("id",), booked: str = BOOKED, received: str = RECEIVED) -> DataFrame:
    """Last state with first booking and last receipt, in one aggregation (M-9)."""
    facts = log.groupBy("shippingid").agg(*_milestones(tie, booked, received))
    return facts.select("shippingid", "_last.*", *MILESTONES)


def _milestones(tie, booked: str, received: str) -> list:
    at = F.col("state_datetime")
    return [
        F.max_by(F.struct("status", "state"), F.struct("state_datetime", *tie)).alias("_last"),
        F.min(F.when(F.col("state") == booked, at)).alias(MILESTONES[0]),
        F.max(F.when(F.col("state") == received, at)).alias(MILESTONES[1]),
    ]


def shipping_mart(ships: DataFrame, countries: DataFrame, transfer_kinds: DataFrame, agreement_terms: DataFrame) -> DataFrame:
    """Delay, completion, VAT and profit per shipment (M-10)."""
    start, end = F.col("shipping_start_fact_datetime"), F.col("shipping_end_fact_datetime")
    plan = F.col("shipping_plan_datetime")
    late = end > plan
    # Rates count where the dimension has them.
    base = F.when(F.col("shipping_country_id").isNotNull(), F.col("shipping_country_base_rate"))
    transfer = F.when(F.col("transfer_type_id").isNotNull(), F.col("shipping_transfer_rate"))
    tax = base + F.col("agreement_rate") + transfer
    return (
        _with_keys(ships, countries, transfer_kinds)
        .join(agreement_terms, "agreementid", "left")
        .select(
            "shippingid",
            "vendorid",
            F.when(F.col("transfer_type_id").isNotNull(), F.col("transfer_type")).alias("transfer_type"),
            whole_days(end, start).alias("full_day_at_shipping"),
            F.when(late, 1).otherwise(0).alias("is_delay"),
            F.when(F.col("status") == "finished", 1).otherwise(0).alias("is_shipping_finish"),
            F.when(late, whole_days(end, plan)).otherwise(0).alias("delay_day_at_shipping"),
            "payment_amount",
            (F.col("payment_amount") * tax).alias("vat"),
            (F.col("payment_amount") * F.col("agreement_commission")).alias("profit"),
        )
    )


def delay_stats(mart: DataFrame) -> DataFrame:
    """Shipments by completion and delay (M-11)."""
    delay = F.sum("delay_day_at_shipping").cast("decimal(20,0)") / F.count("delay_day_at_shipping")
    return mart.groupBy("is_shipping_finish", "is_delay").agg(
        F.count("*").alias("shipment_count"),
        F.round(F.avg("payment_amount"), 2).alias("avg_payment"),
        F.round(delay, 2).alias("avg_delay_days"),
    )
