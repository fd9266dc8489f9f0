"""Constraints of the target tables, to be enforced when they are written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.quality.expectations import Expectations


def rfm_segments(n: int = 5) -> Expectations:
    scores = ["recency", "frequency", "monetary_value"]
    return Expectations(
        not_null=["user_id", *scores],
        checks={f"{c}_range": F.col(c).between(1, n) for c in scores},
        unique=[["user_id"]],
    )


def shipping_info(countries: DataFrame, agreements: DataFrame, transfers: DataFrame) -> Expectations:
    return Expectations(
        not_null=["shippingid", "shipping_country_id", "transfer_type_id", "agreementid"],
        unique=[["shippingid"]],
        references={
            "shipping_country_id": (countries, "shipping_country_id"),
            "agreementid": (agreements, "agreementid"),
            "transfer_type_id": (transfers, "transfer_type_id"),
        },
    )


def shipping_status() -> Expectations:
    return Expectations(not_null=["shippingid"], unique=[["shippingid"]])


def calendar() -> Expectations:
    columns = ["date_id", "date_actual", "week_of_year", "first_day_of_week", "last_day_of_week"]
    return Expectations(not_null=columns, unique=[["date_id"], ["date_actual"]])


def sales_fact(calendar: DataFrame, items: DataFrame, customers: DataFrame, cities: DataFrame) -> Expectations:
    return Expectations(
        not_null=["quantity", "payment_amount", "status"],
        max_length={"status": 50},
        references={
            "date_id": (calendar, "date_id"),
            "item_id": (items, "item_id"),
            "customer_id": (customers, "customer_id"),
            "city_id": (cities, "city_id"),
        },
    )


def customer_retention() -> Expectations:
    counts = [
        "new_customers_count",
        "returning_customers_count",
        "refunded_customer_count",
        "new_customers_revenue",
        "returning_customers_revenue",
        "customers_refunded",
    ]
    return Expectations(not_null=["period_name", "period_id", *counts], unique=[["first_day_of_week", "item_id"]])


def delivery_details(couriers: DataFrame) -> Expectations:
    return Expectations(
        not_null=["delivery_id", "courier_id", "delivery_ts", "rate"],
        checks={"rate": F.col("rate").between(1, 5)},
        unique=[["delivery_id"]],
        references={"courier_id": (couriers, "courier_id")},
    )


def delivery_sales(orders: DataFrame, details: DataFrame) -> Expectations:
    return Expectations(
        not_null=["order_id", "delivery_id", "order_sum", "tip_sum"],
        unique=[["order_id"]],
        references={"order_id": (orders, "order_id"), "delivery_id": (details, "delivery_id")},
    )


def courier_ledger() -> Expectations:
    amounts = [
        "orders_count",
        "orders_total_sum",
        "rate_avg",
        "order_processing_fee",
        "courier_order_sum",
        "courier_tips_sum",
        "courier_reward_sum",
    ]
    checks: dict[str, Column] = {c: F.col(c) >= 0 for c in amounts}
    checks["settlement_year"] = (F.col("settlement_year") >= 2022) & (F.col("settlement_year") < 2500)
    checks["settlement_month"] = F.col("settlement_month").between(1, 12)
    return Expectations(
        not_null=["courier_id", "courier_name", "settlement_year", "settlement_month", *amounts],
        checks=checks,
        unique=[["courier_id", "settlement_year", "settlement_month"]],
    )


def community_staging(table: str, tables: dict[str, DataFrame]) -> Expectations:
    """Keys, text lengths and references of the chat tables. A reference is
    checked when its parent is among ``tables``."""

    def refer(**columns: str) -> dict[str, tuple[DataFrame, str]]:
        return {c: (tables[parent], "id") for c, parent in columns.items() if parent in tables}

    return {
        "users": Expectations(not_null=["id"], max_length={"chat_name": 200, "country": 200}, unique=[["id"]]),
        "groups": Expectations(
            not_null=["id"], max_length={"group_name": 100}, unique=[["id"]], references=refer(admin_id="users")
        ),
        "dialogs": Expectations(
            not_null=["message_id"],
            max_length={"message": 1000},
            unique=[["message_id"]],
            references=refer(message_from="users", message_to="users", message_group="groups"),
        ),
        "group_log": Expectations(
            max_length={"event": 200}, references=refer(group_id="groups", user_id="users")
        ),
    }[table]


def transactions() -> Expectations:
    return Expectations(
        max_length={"operation_id": 60, "country": 30, "status": 30, "transaction_type": 30}, unique=[["operation_id"]]
    )


def rates() -> Expectations:
    return Expectations(unique=[["date_update", "currency_code", "currency_code_with"]])


def global_metrics() -> Expectations:
    columns = [
        "date_update",
        "currency_from",
        "amount_total",
        "cnt_transactions",
        "avg_transactions_per_account",
        "cnt_accounts_make_transactions",
    ]
    return Expectations(not_null=columns, unique=[["date_update", "currency_from"]])
