"""Scratch data in the folder that the cluster shares, and files next to the data."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Written:
    """Rows written to a folder and read back from it."""

    rows: DataFrame
    path: str

    def size(self) -> int:
        """Bytes of the data files, from their listing."""
        files = self.rows.sparkSession.read.format("binaryFile").load(self.path)
        return files.agg(F.sum("length")).first()[0] or 0


def file_system(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def codec(spark: SparkSession, path: str):
    """The codec that a file's name says it is compressed with; None for a plain file."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    known = hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration())
    return known.getCodec(hadoop.fs.Path(path))


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="plumeledger-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new name in the work folder; what is written there goes when the session ends."""
    name = f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"
    path, files = file_system(spark, name)
    files.mkdirs(path.getParent())
    # Only paths that exist can be marked, so the mark is set on an empty folder.
    files.mkdirs(path)
    files.deleteOnExit(path)
    return name


def remove(spark: SparkSession, path: str) -> None:
    target, files = file_system(spark, path)
    files.delete(target, True)


def stage(df: DataFrame, label: str, compression: str | None = None) -> Written:
    """``df`` as a scratch table that stays until the session ends."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return Written(spark.read.schema(df.schema).parquet(path), path)


@contextmanager
def written(df: DataFrame, label: str) -> Iterator[Written]:
    """``df`` as a scratch table for the length of the block, removed also after an error.

    For a result that several jobs read: it is computed once, later jobs read only the
    columns they need, and a lost executor costs no recomputation.
    """
    staged = stage(df, label)
    try:
        yield staged
    finally:
        remove(df.sparkSession, staged.path)
