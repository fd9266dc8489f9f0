"""Sort keys with explicit null placement, usable as sort or as comparison."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Key:
    name: str
    ascending: bool = True
    nulls_first: bool = True

    def sort(self) -> Column:
        c = F.col(self.name)
        if self.ascending:
            return c.asc_nulls_first() if self.nulls_first else c.asc_nulls_last()
        return c.desc_nulls_first() if self.nulls_first else c.desc_nulls_last()

    def after(self, value: Column | None) -> Column:
        """True where the column sorts strictly after ``value``."""
        c = F.col(self.name)
        if value is None:
            return c.isNotNull() if self.nulls_first else F.lit(False)
        beyond = c > value if self.ascending else c < value
        return F.coalesce(beyond, F.lit(not self.nulls_first))


def keys_of(order) -> list[Key]:
    order = [order] if isinstance(order, (str, Key)) else list(order)
    return [k if isinstance(k, Key) else Key(k) for k in order]


def sorts(keys: list[Key]) -> list[Column]:
    return [k.sort() for k in keys]


def as_text(df: DataFrame, keys: list[Key]) -> list[Column]:
    """Key values as text, from which ``literals`` restores the same values."""
    texts = []
    for i, key in enumerate(keys):
        c, kind = F.col(key.name), df.schema[key.name].dataType
        if isinstance(kind, T.TimestampType):
            c = F.unix_micros(c)  # wall-clock text is ambiguous when clocks go back
        elif isinstance(kind, T.BinaryType):
            c = F.hex(c)
        texts.append(c.cast("string").alias(f"_b{i}"))
    return texts


def literals(df: DataFrame, keys: list[Key], texts) -> list[Column | None]:
    return [None if t is None else _literal(t, df.schema[k.name].dataType) for k, t in zip(keys, texts)]


def _literal(text: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(int(text)))
    if isinstance(kind, T.BinaryType):
        return F.unhex(F.lit(text))
    return F.lit(text).cast(kind)


def at_or_after(keys: list[Key], bound: list[Column | None]) -> Column:
    """Lexicographic ``row >= bound`` in the given order."""
    result = F.lit(True)
    for key, value in reversed(list(zip(keys, bound))):
        c = F.col(key.name)
        same = c.isNull() if value is None else F.coalesce(c == value, F.lit(False))
        result = key.after(value) | (same & result)
    return result
