"""Database and topic sinks (SNK-2, SNK-3). Errors fail the write."""

from __future__ import annotations

from pyspark.sql import DataFrame

from martkit.functions.jsons import to_message


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options) -> None:
    df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table).options(**options).save()


def write_kafka(df: DataFrame, servers: str, topic: str, **security) -> None:
    """Each row as one JSON message."""
    (
        to_message(df)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**security)
        .save()
    )
