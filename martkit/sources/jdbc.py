"""Database tables as sources (SRC-2, SRC-10)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    num_partitions: int = 16,
    **options,
) -> DataFrame:
    """A table, read by several tasks when a partition column is given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column:
        low, high = bounds
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=low, upperBound=high, numPartitions=num_partitions
        )
    return reader.load()


def day_predicates(ts_col: str, ds: str, slices: int = 24, literal: str = "TIMESTAMP '{}'") -> list[str]:
    """Half-open ranges that together cover one day, one per task."""
    start = dt.datetime.fromisoformat(ds)
    step = dt.timedelta(days=1) / slices
    edges = [(start + step * i).strftime("%Y-%m-%d %H:%M:%S.%f") for i in range(slices + 1)]
    return [
        f"{ts_col} >= {literal.format(a)} AND {ts_col} < {literal.format(b)}"
        for a, b in zip(edges, edges[1:])
    ]


def read_jdbc_day(
    spark: SparkSession,
    url: str,
    table: str,
    ts_col: str,
    ds: str,
    slices: int = 24,
    literal: str = "TIMESTAMP '{}'",
    **properties,
) -> DataFrame:
    """Rows of one day; the ranges are evaluated by the database (SRC-10).

    ``literal`` is the database's notation of a timestamp.
    """
    predicates = day_predicates(ts_col, ds, slices, literal)
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
