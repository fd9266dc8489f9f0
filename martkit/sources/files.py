"""File sources (SRC-1, SRC-4..SRC-9, SRC-12). Paths may be on any Hadoop
filesystem, object stores included."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.functions.jsons import CORRUPT
from martkit.functions.temporal import ntz
from martkit.operators.latest import first
from martkit.session import staged


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def increment_path(root: str, ds: str, name: str) -> str:
    """Folder of a day's increment: ``root/inc-YYYYMMDD/name`` (SRC-9)."""
    return f"{root.rstrip('/')}/inc-{ds.replace('-', '')}/{name}"


def read_increment_csv(
    spark: SparkSession, root: str, ds: str, schema: T.StructType, name: str = "user_order_log.csv", key: str = "id"
) -> DataFrame:
    """One day's CSV with header; repeated ``key`` values once, without the key.
    Of rows that repeat a key, the smallest in the order of the columns counts."""
    df = spark.read.schema(schema).option("header", True).csv(increment_path(root, ds, name))
    return first(df, key, [c for c in df.columns if c != key]).select(*df.columns).drop(key)


def load_csv_full(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Header-less CSV as (rows, rejected lines) (SRC-5, SRC-7).

    The text is parsed once, with all columns, into the shared folder: whether
    a line is readable must not depend on the columns a query selects.
    """
    return _split(_csv(spark, path, schema).option("header", False).csv(path))


def load_csv_day(
    spark: SparkSession, path: str, schema: T.StructType, null_value: str = "null"
) -> tuple[DataFrame, DataFrame]:
    """CSV of one day with header and a null marker, as (rows, rejected) (SRC-6)."""
    return _split(_csv(spark, path, schema).option("header", True).option("nullValue", null_value).csv(path))


def _csv(spark: SparkSession, path: str, schema: T.StructType):
    with_bad = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(with_bad).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)


def _split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    df = staged(df, "csv")
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), df.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def read_landed_pages(
    spark: SparkSession, path: str, schema: T.StructType, since: str | None = None, ts: str = "delivery_ts"
) -> DataFrame:
    """Landed JSON pages (arrays or lines), optionally from a time on (SRC-8);
    ``unreadable_pages`` names the files that are no JSON."""
    df = _pages(spark, path, schema).filter(F.col(CORRUPT).isNull()).select(*schema.names)
    return df if since is None else df.filter(F.col(ts).cast("timestamp_ntz") >= ntz(since))


def unreadable_pages(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``path`` and text of landed pages that cannot be read."""
    return _pages(spark, path, schema).filter(F.col(CORRUPT).isNotNull()).select("path", CORRUPT)


def _pages(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    with_bad = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(with_bad).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    found = reader.option("multiLine", True).json(path).select(*with_bad.names, F.col("_metadata.file_path").alias("path"))
    # Written down once: what is readable must not depend on the columns read.
    return staged(found, "pages")


def read_reference(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Reference documents (users, restaurants with menus) as a table (SRC-12)."""
    return spark.read.schema(schema).json(path)
