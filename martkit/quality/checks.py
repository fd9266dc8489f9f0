"""Data-quality checks (DQ-1..DQ-17) as one report table.

Row rules on the same table share one aggregation. A check passes when its
measured value is 0, except ``not_empty``, which must be positive.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.operators.aggregates import difference


@dataclass(frozen=True)
class Check:
    name: str
    table: str
    kind: str
    args: dict = field(default_factory=dict)


def not_null(name: str, table: str, *cols: str) -> Check:
    return Check(name, table, "row", {"bad": _any([F.col(c).isNull() for c in cols])})


def in_range(name: str, table: str, low, high, *cols: str) -> Check:
    """Values outside ``low..high``; a bound of None is open, nulls pass."""
    tests = []
    for c in cols:
        if low is not None:
            tests.append(F.col(c) < F.lit(low))
        if high is not None:
            tests.append(F.col(c) > F.lit(high))
    return Check(name, table, "row", {"bad": _any(tests)})


def recompute_within(name: str, table: str, tolerance, *pairs: tuple[Column, Column]) -> Check:
    tests = [F.abs(stored - computed) > F.lit(tolerance) for stored, computed in pairs]
    return Check(name, table, "row", {"bad": _any(tests)})


def not_empty(name: str, table: str) -> Check:
    return Check(name, table, "row", {"bad": F.lit(True), "positive": True})


def row_count_equals(name: str, table: str, other: str, distinct: str | None = None) -> Check:
    """Difference in rows, or in distinct values of a column, as absolute value."""
    return Check(name, table, "count", {"other": other, "distinct": distinct})


def unique_key(name: str, table: str, *keys: str) -> Check:
    return Check(name, table, "unique", {"keys": list(keys)})


def references(name: str, table: str, *targets: tuple[str, str]) -> Check:
    """Rows with a key that has no parent: ``(column, parent table)`` pairs;
    the parent's column has the same name."""
    return Check(name, table, "references", {"targets": list(targets)})


def run_checks(tables: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """(check_name, measured_value, status) for all checks."""
    parts = []
    for table in dict.fromkeys(c.table for c in checks if c.kind == "row"):
        parts.append(_row_rules(tables[table], [c for c in checks if c.kind == "row" and c.table == table]))
    for check in checks:
        if check.kind != "row":
            parts.append(_single(tables, check))
    report = reduce(lambda a, b: a.unionByName(b), parts)
    good = F.when(F.col("positive"), F.col("measured_value") > 0).otherwise(F.col("measured_value") == 0)
    return report.select(
        "check_name", "measured_value", F.when(good, "PASSED").otherwise("FAILED").alias("status")
    )


def _row_rules(df: DataFrame, checks: list[Check]) -> DataFrame:
    entries = [
        F.struct(
            F.lit(c.name).alias("check_name"),
            F.count_if(c.args["bad"]).alias("measured_value"),
            F.lit(bool(c.args.get("positive"))).alias("positive"),
        )
        for c in checks
    ]
    return df.agg(F.array(*entries).alias("_all")).select(F.explode("_all").alias("_one")).select("_one.*")


def _single(tables: dict[str, DataFrame], check: Check) -> DataFrame:
    df = tables[check.table]
    if check.kind == "count":
        column = check.args["distinct"]
        measure = F.count("*") if column is None else F.count_distinct(column)
        value = difference(df, tables[check.args["other"]], measure, measure, "measured_value")
        value = value.select(F.abs("measured_value").alias("measured_value"))
    elif check.kind == "unique":
        counted = df.groupBy(*check.args["keys"]).agg((F.count("*") - 1).alias("surplus"))
        value = counted.agg(F.coalesce(F.sum("surplus"), F.lit(0)).alias("measured_value"))
    else:
        value = _orphans(df, tables, check.args["targets"])
    return value.select(
        F.lit(check.name).alias("check_name"),
        F.col("measured_value").cast("long").alias("measured_value"),
        F.lit(False).alias("positive"),
    )


def _orphans(df: DataFrame, tables: dict[str, DataFrame], targets) -> DataFrame:
    """Rows with at least one missing parent; such a row counts once. Rows are
    counted per key before the parents are joined."""
    rows = df.groupBy(*dict.fromkeys(c for c, _ in targets)).agg(F.count("*").alias("_rows"))
    lost = []
    for i, (column, parent) in enumerate(targets):
        seen = tables[parent].select(column).filter(F.col(column).isNotNull()).distinct()
        seen = seen.withColumn(f"_seen{i}", F.lit(True))
        rows = rows.join(seen, column, "left")
        lost.append(F.col(column).isNotNull() & F.col(f"_seen{i}").isNull())
    return rows.agg(F.coalesce(F.sum(F.when(_any(lost), F.col("_rows"))), F.lit(0)).alias("measured_value"))


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(t, F.lit(False)) for t in tests])
