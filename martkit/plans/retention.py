"""Sales star and weekly retention (M-12..M-15)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.functions.money import signed_amount
from martkit.functions.temporal import on_day
from martkit.operators.joins import join_by_day, missing_from
from martkit.operators.latest import latest

WEEK_LABEL = "Неделя с {} по {}"  # Fixed value: period name of the weekly mart.


def load_dimension(existing: DataFrame, staging: DataFrame, key: str, attrs: list[str], order_by) -> DataFrame:
    """Rows to append: keys the dimension does not have, with their latest
    attributes (M-13). A renamed entry gives one row, and staging is reduced to
    one row per key before it is compared."""
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    wanted = list(dict.fromkeys([key, *attrs, *order]))
    known = latest(staging.select(*wanted), key, order).select(key, *attrs)
    fresh, _ = missing_from(known, existing, key)
    return fresh.select(key, *attrs)


def sales_fact(staging: DataFrame, calendar: DataFrame, ds: str | None = None) -> DataFrame:
    """Sales facts of a day, or of all days for a back-fill (M-14): refunds
    negative, a missing status means shipped."""
    rows = staging if ds is None else on_day(staging, "date_time", ds)
    dated = join_by_day(rows, calendar.select("date_id", "date_actual"), "date_time", "date_actual", how="left")
    return dated.select(
        "date_id",
        "item_id",
        "customer_id",
        "city_id",
        "quantity",
        signed_amount("payment_amount", "status").alias("payment_amount"),
        F.coalesce("status", F.lit("shipped")).alias("status"),
    )


def customer_retention(sales: DataFrame, calendar: DataFrame, count_mode: str = "rows") -> DataFrame:
    """New, returning and refunded counts and revenue per week and item (M-15).

    A customer is new in a week with exactly one shipped order and returning
    with more. With ``count_mode="rows"`` the two counts are of order rows,
    refunded ones included; with ``"customers"`` of distinct customers. Weeks
    are told apart by their first day, so years do not mix.

    Sales are reduced to (week, customer, item) first; the count per customer
    and all results follow from that.
    """
    weeks = calendar.select("date_id", "week_of_year", "first_day_of_week", "last_day_of_week")
    shipped, refunded = F.col("status") == "shipped", F.col("status") == "refunded"
    week = ["first_day_of_week", "last_day_of_week", "week_of_year"]
    per_item = (
        sales.filter(F.col("date_id").isNotNull())
        .join(weeks, "date_id")
        .groupBy(*week, "customer_id", "item_id")
        .agg(
            F.count("*").alias("order_rows"),
            F.count_if(shipped).alias("shipped_rows"),
            F.count_if(refunded).alias("refunded_rows"),
            F.sum(F.when(shipped, F.col("payment_amount"))).alias("shipped_revenue"),
        )
    )
    per_customer = per_item.groupBy(
        F.col("first_day_of_week").alias("_week"), F.col("customer_id").alias("_customer")
    ).agg(F.sum(F.when(F.col("customer_id").isNotNull(), F.col("shipped_rows"))).alias("in_week"))
    rows = per_item.join(
        per_customer,
        (F.col("first_day_of_week") == F.col("_week")) & F.col("customer_id").eqNullSafe(F.col("_customer")),
    )
    new, returning = F.col("in_week") == 1, F.col("in_week") > 1
    size = F.col("order_rows") if count_mode == "rows" else F.lit(1)
    zero = F.lit(0)
    return (
        rows.groupBy(*week, "item_id")
        .agg(
            F.coalesce(F.sum(F.when(new, size)), zero).alias("new_customers_count"),
            F.coalesce(F.sum(F.when(returning, size)), zero).alias("returning_customers_count"),
            F.count_if((F.col("refunded_rows") > 0) & F.col("customer_id").isNotNull()).alias("refunded_customer_count"),
            F.coalesce(F.sum(F.when(new, F.col("shipped_revenue"))), zero).alias("new_customers_revenue"),
            F.coalesce(F.sum(F.when(returning, F.col("shipped_revenue"))), zero).alias("returning_customers_revenue"),
            F.sum("refunded_rows").alias("customers_refunded"),
        )
        .select(
            "new_customers_count",
            "returning_customers_count",
            "refunded_customer_count",
            F.format_string(
                WEEK_LABEL.replace("{}", "%s"),
                F.col("first_day_of_week").cast("string"),
                F.col("last_day_of_week").cast("string"),
            ).alias("period_name"),
            F.col("week_of_year").alias("period_id"),
            "first_day_of_week",
            "item_id",
            "new_customers_revenue",
            "returning_customers_revenue",
            "customers_refunded",
        )
    )
