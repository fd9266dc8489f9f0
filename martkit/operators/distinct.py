"""Exact distinct counts that can be merged, as bitmaps (AG-4).

A distinct count of a month cannot be made from the counts of its days. The sets
of the days can: ids are numbered without gaps, and a set is the words of a bitmap, 64 ids each, of which words
without an id have no row: a small set of many ids is as short as its ids. They
are built with a partial aggregation, stored by day, and united for any longer
stretch without reading the rows again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_bitmaps(df: DataFrame, by: list[str], number: str) -> DataFrame:
    """(by, bucket, bits): the set of ``number``, whole numbers from 1, of each
    group. Nulls belong to no set."""
    rows, n = df.filter(F.col(number).isNotNull()), F.col(number).cast("long")
    bit = F.expr(f"shiftleft(1L, int(`{number}` & 63))")
    return rows.groupBy(*by, F.shiftright(n, 6).alias("bucket")).agg(F.bit_or(bit).alias("bits"))


def united(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    """The unions of the sets of several groups."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bit_or("bits").alias("bits"))


def distinct_counts(bitmaps: DataFrame, by: list[str], out: str) -> DataFrame:
    """How many ids each group has."""
    return bitmaps.groupBy(*by).agg(F.sum(F.bit_count("bits").cast("long")).alias(out))
