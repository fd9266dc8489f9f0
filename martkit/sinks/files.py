"""File sinks (SNK-1, SNK-5, SNK-6, SNK-10..SNK-12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martkit.session import _delete, staged


def write_full(df: DataFrame, path: str) -> None:
    """Overwrite a mart with new content that does not read from it."""
    df.write.mode("overwrite").parquet(path)


def replace_partition(df: DataFrame, path: str, *columns: str) -> None:
    """Replace exactly the partitions present in ``df``; a retry changes nothing.

    The mode is set on this write only. Rebalancing gathers small partitions
    into few files and splits a large one over several tasks.
    """
    (
        df.hint("rebalance", *[F.col(c) for c in columns])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def replace_values(df: DataFrame, path: str, column: str, values) -> None:
    """Replace the named partitions by the rows of ``df`` that belong to them;
    a named partition without rows is emptied, others stay as they are."""
    values = list(values)
    rows = staged(df.filter(F.col(column).isin(values)), "replace")
    replace_partition(rows, path, column)
    held = {str(r[0]) for r in rows.select(column).distinct().collect()}  # at most `values`
    for value in values:
        if str(value) not in held:
            _drop_partition(df.sparkSession, path, column, value)


def _drop_partition(spark: SparkSession, path: str, column: str, value) -> None:
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(value))
    _delete(spark, f"{path}/{column}={name}")


def append(df: DataFrame, path: str) -> None:
    """Plain append; a retry appends again, so loads use the two below."""
    df.write.mode("append").parquet(path)


def append_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Append keyed by batch: a repeated batch replaces its own rows, also when
    it has none any more. Rows are gathered into few files."""
    _drop_partition(df.sparkSession, path, "batch_id", batch_id)
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("long"))
        .hint("rebalance")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def write_layout(
    df: DataFrame,
    target: str,
    partition_by: list[str] = (),
    bucket_by: list[str] = (),
    sort_by: list[str] = (),
    buckets: int = 64,
    mode: str = "overwrite",
    path: str | None = None,
) -> None:
    """Write with a physical layout (SNK-11).

    With buckets the target is a table name, and joins of tables with the same
    buckets on the bucket columns need no shuffle; the files go to ``path`` if it
    is given. Without, the target is a path. Rows are gathered by the
    layout's columns first, so tasks do not each write a file per bucket.
    """
    if bucket_by:
        writer = df.hint("rebalance", *[F.col(c) for c in bucket_by]).write.mode(mode).format("parquet")
        if path:  # outside the warehouse
            writer = writer.option("path", path)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer = writer.bucketBy(buckets, *bucket_by)
        (writer.sortBy(*sort_by) if sort_by else writer).saveAsTable(target)
        return
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(target)


def register_views(tables: dict[str, tuple[DataFrame, list[str]]]) -> None:
    """Temp views over column subsets of sources (SNK-12)."""
    for name, (df, columns) in tables.items():
        df.select(*columns).createOrReplaceTempView(name)


class SnapshotTable:
    """A Parquet table replaced as a whole: every refresh is a new folder.

    Parquet folders cannot be overwritten by a job that reads them. A version
    counts once its ``_SUCCESS`` marker exists, so readers never see half a
    write and a failed refresh leaves the previous version in place.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def versions(self) -> list[int]:
        fs, root = self._fs()
        if not fs.exists(root):
            return []
        found = []
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            done = self._path(f"{self.path}/{name}/_SUCCESS")
            if name.startswith("v") and fs.exists(done):
                found.append(int(name[1:]))
        return sorted(found)

    def exists(self) -> bool:
        return bool(self.versions())

    def read(self) -> DataFrame:
        versions = self.versions()
        if not versions:
            raise FileNotFoundError(self.path)
        return self.spark.read.parquet(self._folder(versions[-1]))

    def refresh(self, df: DataFrame) -> DataFrame:
        """Full refresh (SNK-5): the new content, which may be built from the
        old one, becomes the current version."""
        versions = self.versions()
        number = versions[-1] + 1 if versions else 1
        df.write.mode("overwrite").parquet(self._folder(number))
        for old in versions[:-1]:  # the last one stays for those who read it now
            _delete(self.spark, self._folder(old))
        return self.read()

    def _folder(self, number: int) -> str:
        return f"{self.path}/v{number:08d}"

    def _path(self, text: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def _fs(self):
        root = self._path(self.path)
        return root.getFileSystem(self.spark._jsc.hadoopConfiguration()), root


def rewrite_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Replace partitions with rows computed from the same table.

    The rows are written down first: the swap then reads nothing it deletes,
    and a swap that breaks off can be repeated.
    """
    replace_partition(staged(df, "rewrite"), path, *columns)
