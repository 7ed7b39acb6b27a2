"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SCRATCH_SETTING = "spark.checkpoint.dir"
TEXT_CODEC = "zstd"  # of intermediate tables that hold whole texts
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_scratch: dict[str, str] = {}
_open_scopes = threading.local()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, as the session names it.

    Without the setting a local session gets a temporary folder of its own.  On a cluster a
    machine-local folder would be lost with its machine, so there the setting is required.
    """
    shared = spark.conf.get(SCRATCH_SETTING, None)
    if shared:
        return shared.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {SCRATCH_SETTING} to a folder that all executors share")
    app = context.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="lexspark-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the scratch folder."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), codec: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table and read it back.  Columns to partition by come last; ``codec`` is the
    session's by default.  What was shuffled for it is deleted when it is written, not when the driver collects its
    garbage: no later plan reads it."""
    with settings(df.sparkSession, {SHUFFLE_CLEANUP: "true"}):
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Store ``df`` in the scratch folder.

    For a table that several later plans read: each of them then scans only the columns it
    needs, none repeats the work before, and a lost executor costs no more than its tasks.
    """
    path = scratch_path(df.sparkSession, name)
    for paths in getattr(_open_scopes, "stack", [])[-1:]:
        paths.append(path)
    stored = store(df, path, codec=codec)
    stored.stage_path = path
    return stored


def release(*stages: DataFrame) -> None:
    """Delete the folders of staged tables that no later plan reads."""
    for df in stages:
        remove(df.sparkSession, df.stage_path)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """What is staged inside, by this thread, is deleted at the end: for work whose result is written
    elsewhere."""
    if not hasattr(_open_scopes, "stack"):
        _open_scopes.stack = []
    _open_scopes.stack.append([])
    try:
        yield
    finally:
        for path in _open_scopes.stack.pop():
            remove(spark, path)


def keep(staged: DataFrame) -> DataFrame:
    """A table staged in the innermost scope outlives it: the scope around it, if any, has it then."""
    inner, *around = reversed(_open_scopes.stack)
    inner.remove(staged.stage_path)
    for paths in around[:1]:
        paths.append(staged.stage_path)
    return staged


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session that hold inside."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder wherever Spark's paths lead."""
    files, path = _file_system(spark, folder)
    files.delete(path, True)


def exists(spark: SparkSession, folder: str) -> bool:
    files, path = _file_system(spark, folder)
    return files.exists(path)


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    files, path = _file_system(spark, folder)
    return [f.getPath().getName() for f in files.listStatus(path) if f.isDirectory()]
