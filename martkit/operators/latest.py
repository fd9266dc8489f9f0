"""One row per key by an order (WN-2, WN-3, WN-5), as a partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest(df: DataFrame, keys, order) -> DataFrame:
    """Row with the greatest order values per key; nulls count as oldest."""
    return _pick(df, keys, order, F.max, F.max_by, lambda name: [F.col(name)])


def first(df: DataFrame, keys, order) -> DataFrame:
    """Row with the smallest order values per key; nulls count as newest."""
    return _pick(df, keys, order, F.min, F.min_by, lambda name: [F.col(name).isNull().alias(f"_no_{name}"), F.col(name)])


def _pick(df: DataFrame, keys, order, pick, pick_by, sought) -> DataFrame:
    """The order's columns lead the row that is compared, so no column goes
    through the shuffle twice; what has no order is carried beside it."""
    keys = _list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    order = [c for c in dict.fromkeys(_list(order)) if c not in keys]
    by = [c for name in order for c in sought(name)]
    others = [c for c in rest if c not in order]
    if by and all(_has_order(df.schema[c].dataType) for c in others):
        row = pick(F.struct(*by, *others))
    else:
        row = pick_by(F.struct(*rest), F.struct(*by, F.lit(0).alias("_any")))
    return df.groupBy(*keys).agg(row.alias("_row")).select(*keys, *[_field(c) for c in rest]).select(*df.columns)


def _field(name: str) -> Column:
    return F.col("_row").getField(name).alias(name)


def _has_order(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_has_order(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_order(kind.elementType)
    return isinstance(kind, (T.NumericType, T.StringType, T.BooleanType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType))


def _list(names) -> list[str]:
    return [names] if isinstance(names, str) else list(names)
