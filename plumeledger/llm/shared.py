"""Staged tables in the folder that the cluster shares, and reading the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..sources.workspace import file_system, work_dir


#: Spark then deletes the shuffle files of an execution as soon as it ends.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Files of a staged table whose size is known, and rows of each.
MIN_FILES, ROWS_PER_FILE = 8, 100_000


class Scratch:
    """Tables written between the steps of one operator.

    A written table cuts the lineage: a lost executor costs the tasks that ran on it and
    nothing before the last table. The folder goes when the session's JVM ends, because a
    returned DataFrame may still read it; ``drop`` frees a table earlier. With ``free`` the
    shuffle files behind a written table go at once: nothing reads them again, and the driver
    would keep them until it happens to collect garbage.
    """

    def __init__(self, spark: SparkSession, label: str, free: bool = False) -> None:
        self.spark = spark
        self.free = free
        self.root = f"{work_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
        self._paths: dict[int, str] = {}
        self._made = 0
        path, files = file_system(spark, self.root)
        files.mkdirs(path)
        files.deleteOnExit(path)

    def stage(self, df: DataFrame, rows: int | None = None) -> DataFrame:
        """``df`` written as Parquet and read back.

        ``rows`` is a bound of the number of (narrow) rows where it is known: the number of
        files then follows it instead of the shuffle setting.
        """
        self._made += 1
        if rows is not None:
            df = df.coalesce(max(MIN_FILES, -(-rows // ROWS_PER_FILE)))
        path = f"{self.root}/t{self._made}"
        before = self.spark.conf.get(_FREE, "false")
        self.spark.conf.set(_FREE, "true" if self.free else before)
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(_FREE, before)
        staged = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(staged)] = path
        return staged

    def drop(self, *staged: DataFrame) -> None:
        """Delete staged tables that nothing reads any more."""
        for df in staged:
            path, files = file_system(self.spark, self._paths.pop(id(df)))
            files.delete(path, True)


def fresh(df: DataFrame, *labels: str) -> list[str]:
    """Names that no column of ``df`` has, in whatever case."""
    taken = {c.lower() for c in df.columns}
    names = []
    for label in labels:
        while label in taken:
            label += "_"
        taken.add(label)
        names.append(label)
    return names


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
