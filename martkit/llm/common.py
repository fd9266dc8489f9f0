"""Small helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
import os
from functools import wraps

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.session import _delete, new_path


#: The folder that holds this package.
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def for_workers(spark: SparkSession) -> None:
    """Lets the Python workers of a local session import this package, whatever
    folder it was started in; a cluster gets it with the job."""
    if spark.sparkContext.master.startswith("local"):
        spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    for_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


class Staging:
    """Intermediate tables in the shared folder, each deleted once it is of no
    more use. A lost executor re-reads files instead of recomputing a job."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, str] = {}
        self.held: list[DataFrame] = []  # so that ids stay their own

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = new_path(self.spark, name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        self.held.append(out)
        return out

    def drop(self, df: DataFrame) -> None:
        path = self.paths.pop(id(df), None)
        if path:
            _delete(self.spark, path)

    def drop_all(self) -> None:
        for df in self.held:
            self.drop(df)


def cells(column: pa.Array, rows: int = 512):
    """The values of a column; Python holds a few rows of it at a time."""
    for i in range(0, len(column), rows):
        yield from column.slice(i, rows).to_pylist()


def give_back() -> None:
    """Memory that the allocators of this process keep for later goes back to
    the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run):
    """A function over batches that gives memory back when it ends. Workers live
    on for later stages, and would add what they keep to what those need."""

    @wraps(run)
    def task(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder that driver and executors share; made if
    it is missing. Any scheme that Arrow knows (file, hdfs, s3, gs, abfs)."""
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path, recursive=True)
    return system, path


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a long, b long): one row (node, root)
    per node that has an edge to another node; root is the smallest node that it
    reaches. Alternating large-star and small-star steps; a node's neighbours
    are only ever reduced to a minimum, so a hub is no problem. Self-loops and
    rows with a null are ignored.
    """
    staging = Staging(spark)
    high, low = F.greatest("a", "b"), F.least("a", "b")
    known = edges.filter("a <> b").select(high.alias("a"), low.alias("b")).distinct()
    now = staging.keep(known, "edges")
    before = None
    while True:
        state = now.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        if state["n"] == 0 or state == before:
            break
        before = state
        both = now.union(now.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a and b <> m")
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        pairs = F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        small = small.select(F.explode(pairs).alias("p")).select("p.a", "p.b").filter("a <> b").distinct()
        after = staging.keep(small, "edges")
        staging.drop(now)
        now = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
