"""Table constraints checked when writing (SNK-13)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.operators.aggregates import duplicates


@dataclass
class Expectations:
    """NOT NULL columns, CHECK conditions, unique keys, foreign keys."""

    not_null: list[str] = field(default_factory=list)
    checks: dict[str, Column] = field(default_factory=dict)
    max_length: dict[str, int] = field(default_factory=dict)
    unique: list[list[str]] = field(default_factory=list)
    references: dict[str, tuple[DataFrame, str]] = field(default_factory=dict)


class ConstraintViolation(Exception):
    pass


def split_violations(df: DataFrame, expectations: Expectations) -> tuple[DataFrame, DataFrame]:
    """Rows that keep all constraints, and the others with the names of the
    broken ones in ``violated``. As in SQL, a CHECK that is null passes. All
    rows of a repeated key are set aside, since none of them is preferred."""
    rules = {f"not_null:{c}": F.col(c).isNull() for c in expectations.not_null}
    rules |= {f"check:{n}": ~F.coalesce(c, F.lit(True)) for n, c in expectations.checks.items()}
    rules |= {
        f"length:{c}": F.coalesce(F.length(c) > n, F.lit(False)) for c, n in expectations.max_length.items()
    }
    marked = df
    for i, keys in enumerate(expectations.unique):
        twice = duplicates(df, keys).select(*keys, F.lit(True).alias(f"_twice{i}"))
        marked = marked.join(twice, keys, "left")
        rules["unique:" + ",".join(keys)] = F.col(f"_twice{i}").isNotNull()
    for i, (column, (parent, parent_column)) in enumerate(expectations.references.items()):
        seen = parent.select(F.col(parent_column).alias(column)).distinct().withColumn(f"_seen{i}", F.lit(True))
        marked = marked.join(seen, column, "left")
        rules[f"references:{column}"] = F.col(column).isNotNull() & F.col(f"_seen{i}").isNull()
    broken = F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in rules.items()]))
    marked = marked.withColumn("violated", broken)
    good = marked.filter(F.size("violated") == 0).select(*df.columns)
    return good, marked.filter(F.size("violated") > 0).select(*df.columns, "violated")


def enforce(df: DataFrame, expectations: Expectations, mode: str = "fail") -> tuple[DataFrame, DataFrame]:
    """``fail`` raises on the first violation, ``quarantine`` returns both parts."""
    good, bad = split_violations(df, expectations)
    if mode == "fail":
        counts = bad.select(F.explode("violated").alias("rule")).groupBy("rule").count()
        found = {r["rule"]: r["count"] for r in counts.collect()}  # one row per rule
        if found:
            raise ConstraintViolation(str(found))
    return good, bad
