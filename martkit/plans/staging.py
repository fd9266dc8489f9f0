"""Chat tables from header-less CSV into staging (M-19)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.quality.constraints import community_staging
from martkit.quality.expectations import split_violations
from martkit.sinks.files import SnapshotTable
from martkit.sources.files import load_csv_full

SCHEMAS = {
    "users": T.StructType(
        [
            T.StructField("id", T.IntegerType()),
            T.StructField("chat_name", T.StringType()),
            T.StructField("registration_dt", T.TimestampNTZType()),
            T.StructField("country", T.StringType()),
            T.StructField("age", T.IntegerType()),
        ]
    ),
    "groups": T.StructType(
        [
            T.StructField("id", T.IntegerType()),
            T.StructField("admin_id", T.IntegerType()),
            T.StructField("group_name", T.StringType()),
            T.StructField("registration_dt", T.TimestampNTZType()),
            T.StructField("is_private", T.BooleanType()),
        ]
    ),
    "dialogs": T.StructType(
        [
            T.StructField("message_id", T.IntegerType()),
            T.StructField("message_ts", T.TimestampNTZType()),
            T.StructField("message_from", T.IntegerType()),
            T.StructField("message_to", T.IntegerType()),
            T.StructField("message", T.StringType()),
            T.StructField("message_group", T.IntegerType()),
        ]
    ),
    "group_log": T.StructType(
        [
            T.StructField("group_id", T.IntegerType()),
            T.StructField("user_id", T.IntegerType()),
            T.StructField("user_id_from", T.IntegerType()),
            T.StructField("event", T.StringType()),
            T.StructField("datetime_", T.TimestampNTZType()),
        ]
    ),
}


def stage_csv(
    spark: SparkSession, source: str, target: str, tables=tuple(SCHEMAS)
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Replace the staging tables with the CSV files ``source/<table>.csv``.

    Returns the staged tables and, per table, what was set aside: unreadable
    lines as ``_corrupt_record`` and rows that break a constraint.
    """
    staged, rejected = {}, {}
    for name in tables:
        rows, unreadable = load_csv_full(spark, f"{source}/{name}.csv", SCHEMAS[name])
        good, bad = split_violations(rows, community_staging(name, staged))
        staged[name] = SnapshotTable(spark, f"{target}/{name}").refresh(good)
        reason = F.concat_ws(",", "violated").alias("reason")
        rejected[name] = unreadable.select(
            F.col("_corrupt_record").alias("row"), F.lit("unreadable").alias("reason")
        ).unionByName(bad.select(F.to_json(F.struct(*rows.columns)).alias("row"), reason))
    return staged, rejected
