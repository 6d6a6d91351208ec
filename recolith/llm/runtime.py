"""Scratch tables in the cluster's shared folder, used to cut lineage between steps."""

from __future__ import annotations

import atexit
import ctypes
import functools
import inspect
import re
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Rows in an Arrow batch, at most: batches of whole texts are held twice over, in the JVM's buffers and in Python.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Setting by which shuffle files go at the end of the execution that made them.
FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_base(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a private one only where that is unset and all tasks run in
    this process."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="recolith-")
        atexit.register(shutil.rmtree, base, True)
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def small_batches(spark: SparkSession) -> None:
    """From now on the session's Arrow batches hold BATCH_ROWS rows at most."""
    if not 0 < int(spark.conf.get(_BATCH)) <= BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def _give_back() -> None:
    """Returns what Arrow and malloc hold but don't use; workers live on between stages."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def trimmed(f):
    """A function of mapInArrow or applyInArrow after whose task the worker gives unused memory back."""
    if inspect.isgeneratorfunction(f):

        @functools.wraps(f)
        def run(batches):
            try:
                yield from f(batches)
            finally:
                _give_back()

        return run

    def call(*tables):
        try:
            return f(*tables)
        finally:
            _give_back()

    def one(table: pa.Table) -> pa.Table:
        return call(table)

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        return call(left, right)

    return one if len(inspect.signature(f).parameters) == 1 else two


class Scratch:
    """Writes intermediate tables as Parquet; survives lost executors because the folder is shared."""

    def __init__(self, spark: SparkSession):
        small_batches(spark)
        self.spark = spark
        self.root = f"{scratch_base(spark)}/recolith-{uuid.uuid4().hex}"
        self.n = 0
        self.paths: list[str] = []

    def path(self, name: str) -> str:
        self.n += 1
        return f"{self.root}/{self.n:03d}-{name}"

    def save(self, df: DataFrame, name: str = "t") -> DataFrame:
        """Writes a table and reads it again; the shuffle files behind it go when it is written."""
        path = self.path(name)
        before = self.spark.conf.get(FREE, None)
        self.spark.conf.set(FREE, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.unset(FREE) if before is None else self.spark.conf.set(FREE, before)
        self.paths.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def last(self, df: DataFrame, name: str = "result") -> DataFrame:
        """Saves a result and deletes every table before it."""
        old, self.paths = self.paths, []
        out = self.save(df, name)
        self._delete(old)
        return out

    def clear(self, keep: int = 0) -> None:
        """Deletes all tables but the last so many."""
        at = len(self.paths) - keep
        self._delete(self.paths[:at])
        self.paths = self.paths[at:]

    def _delete(self, paths: list[str]) -> None:
        sc = self.spark.sparkContext
        for p in paths:
            where = sc._jvm.org.apache.hadoop.fs.Path(p)
            where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
