"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
#: Of tables the library writes: hash keys as text take half as much as plain.
COMPRESSION = "zstd"


def build_session(app: str = "martkit", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library is tested with.

    Partition counts are left to adaptive execution: it starts from
    ``spark.sql.shuffle.partitions`` and coalesces or splits at run time.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_brief: dict[object, list] = {}
_brief_lock = Lock()


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs in the block are deleted as it ends, rather
    than when the driver happens to collect its garbage, which with a large heap
    is after the job. Blocks of several threads may overlap; the setting is what
    it was once the last one ends."""
    key = spark._jsparkSession.sessionUUID()
    with _brief_lock:
        held = _brief.setdefault(key, [0, spark.conf.get(_FILE_CLEANUP, None)])
        held[0] += 1
        spark.conf.set(_FILE_CLEANUP, "true")
    try:
        yield
    finally:
        with _brief_lock:
            held[0] -= 1
            if not held[0]:
                del _brief[key]
                if held[1] is None:
                    spark.conf.unset(_FILE_CLEANUP)
                else:
                    spark.conf.set(_FILE_CLEANUP, held[1])


_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)
_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting; it gets a fresh folder
    of its own, because driver and executors are then one process.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="martkit-")
    return _local_dirs[app]


def work_dir(spark: SparkSession) -> str:
    """This application's own folder in the shared folder."""
    return f"{shared_dir(spark)}/martkit-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the application's folder that nothing else uses."""
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def drop_staged(spark: SparkSession) -> None:
    """Delete the application's intermediate tables, at the end of a job."""
    _delete(spark, work_dir(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage durably: a lost executor re-reads files instead of
    recomputing the job, and several passes see exactly the same rows.
    """
    path = new_path(df.sparkSession, name)
    if (passing := _passing.get()) is not None:
        passing.append(path)
    return _written(df, path)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[None]:
    """Tables staged in the block, by threads that run in its context too, are
    deleted at its end: for micro-batches, whose job does not end."""
    token = _passing.set(paths := [])
    try:
        yield
    finally:
        _passing.reset(token)
        for path in paths:
            _delete(spark, path)


@contextmanager
def scratch(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``staged`` for the length of a block, deleted afterwards."""
    path = new_path(df.sparkSession, name)
    try:
        yield _written(df, path)
    finally:
        _delete(df.sparkSession, path)


def _written(df: DataFrame, path: str) -> DataFrame:
    with brief_shuffles(df.sparkSession):
        df.write.mode("errorifexists").option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
