"""Intermediate tables in the folder that all executors share.

A step whose result is read several times is written once as Parquet and read back. Later readers
then fetch only their columns, lost executors cost no recomputation of the whole chain, and values
that depend on physical order (row ids) are fixed from then on.
"""

from __future__ import annotations

import itertools
import tempfile
import uuid

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")
R = TypeVar("R")

_local_dirs: dict[str, str] = {}

# Codec of the tables of full rows, which are most of what a load writes.
FULL_ROWS = "zstd"

# Whether the shuffle files of a query are removed when it ends.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Rows that a task of a full-width sort or join takes at most on average; some 400 bytes each in memory.
TASK_ROWS = 1 << 19


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only in local mode."""
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="salesdw-")
    return _local_dirs[context.applicationId]


def partitions_for(spark: SparkSession, rows: int) -> int:
    """Shuffle partitions for so many rows: the session's number, or as many more as keep a task's share in memory."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))


class Staging:
    """The intermediate tables of one job. Use as a context manager to remove them at the end."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.path = f"{root or shared_dir(spark)}/salesdw-{uuid.uuid4().hex}"
        self._numbers = itertools.count(1)
        self._paths: dict[str, str] = {}

    def put(self, df: DataFrame, label: str, compression: str | None = None, tidy: bool = False) -> DataFrame:
        """Write ``df`` once and return a reader of the written table; without ``compression`` by the session's codec.

        With ``tidy`` the shuffle files of this write go when it ends, not when the driver's garbage happens to be
        collected. That is a setting of the session meanwhile, so not for writes side by side.
        """
        path = f"{self.path}/{next(self._numbers):03d}-{label}"
        self._paths[label] = path
        before = self.spark.conf.get(FILE_CLEANUP, "false")
        if tidy:
            self.spark.conf.set(FILE_CLEANUP, "true")
        try:
            df.write.parquet(path, compression=compression)
        finally:
            if tidy:
                self.spark.conf.set(FILE_CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def put_beside(self, df: DataFrame, label: str, other: str) -> DataFrame:
        """Write ``df`` as well and return one reader of both it and the last table named ``other``."""
        together = self._paths[other]
        own = self.put(df, label)
        return self.spark.read.schema(own.schema).parquet(together, self._paths[label])

    def release(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *failure) -> None:
        self.release()


def make_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def side_by_side(work: Callable[[T], R], items: Iterable[T], spark: SparkSession) -> list[R]:
    """Start the Spark jobs of a few independent pieces of work together, so that they share the cluster.

    They keep the caller's job group, so that cancelling it reaches them.
    """
    pieces = list(items)
    with ThreadPoolExecutor(len(pieces)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), pieces))
