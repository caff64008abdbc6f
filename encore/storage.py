"""Scratch tables in the shared folder the session names in spark.checkpoint.dir."""

from __future__ import annotations

import contextlib
import gc
import tempfile
import threading
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Scopes of the current thread: two live jobs of one process must not delete each other's tables.
_local = threading.local()
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Per session: writes under way, and the setting before them.
_lock, _writing = threading.Lock(), {}


def _open_scopes() -> list[list[str]]:
    if not hasattr(_local, "scopes"):
        _local.scopes = []
    return _local.scopes


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach; a temporary one only in local mode with none set."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="encore-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A path nobody has used yet."""
    return f"{shared_folder(spark)}/encore/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str, partition_by: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back: computed once, and it survives lost executors.

    A reader that asks for one value of `partition_by` opens no file of another one. The shuffle files of the write go
    with it, as nothing reads them again.
    """
    return materialize_at(df, scratch_path(df.sparkSession, purpose), partition_by)


def materialize_at(df: DataFrame, path: str, partition_by: str | None = None) -> DataFrame:
    """`materialize` at a path from `scratch_path`, for who deletes the table, or a partition of it, before the job ends."""
    if _open_scopes():
        _open_scopes()[-1].append(path)
    with _shuffles_freed(df.sparkSession):
        (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """A write deletes its own shuffle files when it ends. Else they stay until the driver collects its garbage.

    The setting is the session's: writes of several threads turn it on together, and the last one puts it back.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        writes, before = _writing.get(session, (0, None))
        if not writes:
            before = spark.conf.get(SHUFFLE_CLEANUP, None)
            spark.conf.set(SHUFFLE_CLEANUP, "true")
        _writing[session] = writes + 1, before
    try:
        yield
    finally:
        with _lock:
            writes, before = _writing.pop(session)
            if writes > 1:
                _writing[session] = writes - 1, before
            elif before is None:
                spark.conf.unset(SHUFFLE_CLEANUP)
            else:
                spark.conf.set(SHUFFLE_CLEANUP, before)


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete what `materialize` wrote inside the scope when it ends. Write final results before that."""
    paths: list[str] = []
    _open_scopes().append(paths)
    try:
        yield
    finally:
        _open_scopes().pop()
        for path in paths:
            delete_folder(spark, path)


def freed(spark: SparkSession) -> None:
    """Let the driver drop what it no longer holds, so that Spark deletes the shuffle files of finished steps now.

    Spark deletes them when the driver's JVM happens to collect its garbage, which a driver with little to do may not do
    for half an hour.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _file_system(spark: SparkSession, path: str):
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    location, system = _file_system(spark, path)
    system.delete(location, True)


def read_small(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; null if there is none."""
    location, system = _file_system(spark, path)
    if not system.exists(location):
        return None
    stream = system.open(location)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def file_times(spark: SparkSession, path: str) -> dict[str, float]:
    """Names of the files of a folder and when they were written, in seconds."""
    location, system = _file_system(spark, path)
    found = system.listStatus(location) if system.exists(location) else []
    return {s.getPath().getName(): s.getModificationTime() / 1000 for s in found if s.isFile()}


def create_small(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small new file in place in one step; False if there is one already."""
    java, context = spark.sparkContext._jvm, spark.sparkContext
    location, system = _file_system(spark, path)
    folder, _, name = path.rpartition("/")
    draft, _ = _file_system(spark, f"{folder}/_{name}-{uuid.uuid4().hex}")
    stream = system.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    options = context._gateway.new_array(getattr(java.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        java.org.apache.hadoop.fs.FileContext.getFileContext(location.toUri(), context._jsc.hadoopConfiguration()).rename(draft, location, options)
    except Py4JJavaError as error:
        system.delete(draft, False)
        if "FileAlreadyExistsException" not in str(error.java_exception):
            raise
        return False
    return True
