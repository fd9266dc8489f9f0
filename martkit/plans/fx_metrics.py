"""Transactions in one currency (M-38, M-39)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.functions.money import ratio
from martkit.functions.temporal import on_day
from martkit.sinks.files import replace_values

BASE_CURRENCY = 420  # Fixed value: currency the turnover is expressed in.


def copy_day(source: DataFrame, path: str, ts: str, ds: str) -> None:
    """Copy one day into a table partitioned by day; a retry replaces it, and a
    day that has no rows any more is emptied (M-38)."""
    replace_values(on_day(source, ts, ds).withColumn("ds", F.to_date(ts)), path, "ds", [ds])


def day_rates(rates: DataFrame, base: int = BASE_CURRENCY) -> DataFrame:
    """Last rate of each day and currency: date_update, currency_code, rate."""
    return (
        rates.filter(F.col("currency_code_with") == base)
        .groupBy(F.to_date("date_update").alias("date_update"), "currency_code")
        .agg(F.max_by("currency_with_div", F.struct("date_update", "currency_with_div")).alias("rate"))
    )


def global_metrics(
    transactions: DataFrame, rates: DataFrame, ds: str | None = None, base: int = BASE_CURRENCY
) -> DataFrame:
    """Turnover, transactions and accounts per day and currency (M-39), for one
    day or for all days of the input.

    A day has one rate per currency, so amounts are summed before they are
    converted and the join sees one row per day and currency.
    """
    if ds is not None:
        transactions, rates = on_day(transactions, "transaction_dt", ds), on_day(rates, "date_update", ds)
    valid = transactions.filter((F.col("status") == "done") & (F.col("account_number_from") >= 0))
    per_account = valid.groupBy(
        F.to_date("transaction_dt").alias("date_update"), "currency_code", "account_number_from"
    ).agg(F.sum("amount").alias("amount"), F.count("operation_id").alias("operations"))
    per_day = per_account.groupBy("date_update", "currency_code").agg(
        F.sum("amount").cast("decimal(20,0)").alias("amount"),
        F.sum("operations").alias("cnt_transactions"),
        F.count("*").alias("cnt_accounts_make_transactions"),
    )
    average = ratio(F.col("cnt_transactions").cast("double"), F.col("cnt_accounts_make_transactions").cast("double"), 2)
    return per_day.join(day_rates(rates, base), ["date_update", "currency_code"]).select(
        "date_update",
        F.col("currency_code").alias("currency_from"),
        (F.col("amount") * F.col("rate")).cast("decimal(18,2)").alias("amount_total"),
        "cnt_transactions",
        average.cast("decimal(18,2)").alias("avg_transactions_per_account"),
        "cnt_accounts_make_transactions",
    )


def without_rate(transactions: DataFrame, rates: DataFrame, base: int = BASE_CURRENCY) -> DataFrame:
    """Valid transactions of days on which their currency has no rate."""
    valid = transactions.filter((F.col("status") == "done") & (F.col("account_number_from") >= 0))
    known = day_rates(rates, base).select("date_update", "currency_code")
    dated = valid.withColumn("date_update", F.to_date("transaction_dt"))
    return dated.join(known, ["date_update", "currency_code"], "left_anti").drop("date_update")
