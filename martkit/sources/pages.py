"""Landed JSON pages read by byte stretches (SRC-8).

A page is one JSON array, or objects one after another, in one file; Spark's
reader gives such a file to one task. Here the text source cuts it at closing
braces, stretch by stretch. Which braces end a record depends on the quotes and
braces before them, so each piece says what it changes, the changes are summed
up inside stretches, and stretches are stitched by one row each.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martkit.functions.jsons import CORRUPT
from martkit.session import staged

_STRETCH = ["path", "start"]
_BYTES = "spark.sql.files.maxPartitionBytes"
#: Stretches that pages are cut into before stretches grow, and what they grow to.
MOST_STRETCHES, LONGEST = 512, 128 << 20


def read_json_pages(spark: SparkSession, path: str, schema: T.StructType, stretch: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, broken): the records of all pages below ``path`` that have the
    schema, and ``path`` and text of the others. A record that leaves a quote or
    brace open takes the rest of its page with it, as JSON has it. ``stretch``
    is the least size of the stretches in bytes; Spark's setting counts without
    it. Each is a task, so stretches grow with the pages up to ``LONGEST``."""
    with _stretches(spark, _grown(spark, path, stretch)):
        text = spark.read.option("lineSep", "}").text(path)
        meta = [F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_size").alias("bytes")]
        pieces = staged(text.select("value", *meta).withColumn("at", F.monotonically_increasing_id()), "pages")
    with_bad = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    read = F.from_json("text", with_bad, {"columnNameOfCorruptRecord": CORRUPT}).alias("r")
    parsed = staged(_records(pieces).select("path", "text", read), "records")
    good = F.col(f"r.{CORRUPT}").isNull() & F.col("r").isNotNull()
    return parsed.filter(good).select("r.*").drop(CORRUPT), parsed.filter(~good).select("path", F.col("text").alias(CORRUPT))


def _records(pieces: DataFrame) -> DataFrame:
    """(path, text) of each record, from pieces between closing braces."""
    clean = F.regexp_replace("value", r"\\(.|\n)", "")
    parts = F.split(clean, '"')
    opens = lambda odd: F.aggregate(
        F.transform(parts, lambda x, i: F.when(i % 2 == odd, F.length(x) - F.length(F.replace(x, F.lit("{"), F.lit("")))).otherwise(0)),
        F.lit(0),
        lambda a, b: a + b,
    )
    told = pieces.select(
        "path", "start", "at", "bytes", "value", (F.size(parts) - 1).alias("quotes"), opens(0).alias("opens_out"), opens(1).alias("opens_in")
    )
    # The last piece of a page has no brace behind it, unless the page ends with one.
    size = F.sum(F.octet_length("value") + 1)
    edges = told.groupBy(*_STRETCH).agg(F.max("at").alias("last_at"), F.sum("quotes").alias("total"), size.alias("size"), F.first("bytes").alias("bytes"))
    of_page, by_start = W.partitionBy("path"), W.partitionBy("path").orderBy("start")
    open_end = (F.sum("size").over(of_page) > F.col("bytes")) & (F.lead("start").over(by_start).isNull())
    edges = edges.select(*_STRETCH, F.when(open_end, F.col("last_at")).alias("open_at"), _before("total", by_start).alias("carried"))

    in_stretch = W.partitionBy(*_STRETCH).orderBy("at")
    rows = told.join(edges, _STRETCH)
    rows = rows.withColumn("inside", (F.col("carried") + _before("quotes", in_stretch)) % 2 == 1)
    closed = ((F.col("inside").cast("int") + F.col("quotes")) % 2 == 0) & ~F.col("at").eqNullSafe(F.col("open_at"))
    rows = rows.withColumn("closed", closed).withColumn(
        "step", F.when(F.col("inside"), F.col("opens_in")).otherwise(F.col("opens_out")) - F.col("closed").cast("int")
    )
    rows = staged(rows.select(*_STRETCH, "at", "value", "open_at", "closed", "step"), "steps")
    depths = rows.groupBy(*_STRETCH).agg(F.sum("step").alias("total"))
    depths = depths.select(*_STRETCH, _before("total", by_start).alias("carried"))
    level = F.col("carried") + F.sum("step").over(in_stretch.rowsBetween(W.unboundedPreceding, 0))
    rows = rows.join(depths, _STRETCH).withColumn("ends", (F.col("closed") & (level == 0)).cast("int")).drop("carried")
    rows = staged(rows, "ends")
    counts = rows.groupBy(*_STRETCH).agg(F.sum("ends").alias("total"))
    counts = counts.select(*_STRETCH, _before("total", by_start).alias("carried"))
    numbered = rows.join(counts, _STRETCH).withColumn("record", F.col("carried") + _before("ends", in_stretch))

    shown = F.concat("value", F.when(F.col("at").eqNullSafe(F.col("open_at")), "").otherwise("}"))
    whole = numbered.groupBy("path", "record").agg(F.array_sort(F.collect_list(F.struct("start", "at", shown.alias("v")))).alias("all"))
    text = F.array_join(F.transform("all", lambda x: x["v"]), "")
    text = F.regexp_replace(text, r"^[\s,\[]+", "")
    # What stands behind the last record.
    return whole.select("path", text.alias("text")).filter(~F.col("text").rlike(r"^[\s\],]*$"))


def _before(column: str, window) -> Column:
    return F.coalesce(F.sum(column).over(window.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))


def _grown(spark: SparkSession, path: str, stretch: int | None) -> int | None:
    """The size of stretches for the pages below ``path``."""
    if stretch is None:
        return None
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    total = sum(fs.getContentSummary(status.getPath()).getLength() for status in fs.globStatus(folder) or [])
    return max(stretch, min(total // MOST_STRETCHES, LONGEST))


@contextmanager
def _stretches(spark: SparkSession, size: int | None) -> Iterator[None]:
    before = spark.conf.get(_BYTES)
    if size is not None:
        spark.conf.set(_BYTES, str(size))
    try:
        yield
    finally:
        spark.conf.set(_BYTES, before)
