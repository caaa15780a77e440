"""Durable intermediate tables in the folder every executor can reach."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Only a local session may run without it; it then gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    active = context.getCheckpointDir()
    if active:
        return active.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="doccairn-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return context.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/doccairn/{name}-{uuid.uuid4().hex}"


#: Whether Spark removes the shuffle files of a query at its end; else they stay until the driver collects its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that begin within leave no shuffle files; what they write is read instead.

    Threads may be within at the same time; the last one restores the setting. What they share is
    kept with the session, because this module is sent to tasks by value.
    """
    lock, held = spark.__dict__.setdefault("_doccairn_writes", (threading.Lock(), []))
    with lock:
        held.append(None if held else spark.conf.get(SHUFFLE_CLEANUP, "false"))
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with lock:
            if len(held) > 1:
                held.pop()
            else:
                spark.conf.set(SHUFFLE_CLEANUP, held.pop())


def settle(df: DataFrame, name: str, written: list[str] | None = None, compression: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back; its shuffle files go.

    Cuts the lineage, survives lost executors, and gives Catalyst exact sizes. The path is
    added to ``written``, for callers that remove the table when they are done.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    with shuffles_removed(spark):
        df.write.parquet(path, compression=compression)
    if written is not None:
        written.append(path)
    return spark.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Buckets:
    """A written table dealt over buckets by one column; joins and groups by it need no shuffle."""

    spark: SparkSession
    name: str
    path: str

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def forget(self) -> None:
        """Remove the table's name; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def discard(self) -> None:
        self.forget()
        discard(self.spark, [self.path])


def settle_buckets(
    df: DataFrame, name: str, column: str, buckets: int, folders: tuple[str, ...] = (), path: str | None = None,
    compression: str | None = None,
) -> Buckets:
    """Write ``df`` in ``buckets`` buckets by ``column``, within folders by the columns ``folders``.

    Deal the rows over tasks by ``column`` first, or every task writes a file to every bucket.
    """
    spark = df.sparkSession
    table = Buckets(spark, f"doccairn_{name.replace('-', '_')}_{uuid.uuid4().hex}", path or new_path(spark, name))
    writer = df.write.bucketBy(buckets, column).option("path", table.path)
    if compression:
        writer = writer.option("compression", compression)
    with shuffles_removed(spark):
        (writer.partitionBy(*folders) if folders else writer).saveAsTable(table.name)
    return table


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Remove tables written under :func:`new_path` and empty the list."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    paths.clear()
