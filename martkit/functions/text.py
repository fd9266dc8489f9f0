"""Delimited descriptions such as ``id:number:rate:commission``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def part(text, index: int, sep: str = ":", as_type: str | None = None) -> Column:
    """1-based part of a delimited text; null when missing or not castable."""
    value = F.get(F.split(text, _literal(sep)), F.lit(index - 1))
    return value.try_cast(as_type) if as_type else value


def _literal(sep: str) -> str:
    return "\\Q" + sep + "\\E"
