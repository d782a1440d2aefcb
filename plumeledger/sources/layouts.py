"""Copies of a keyed table laid out for one kind of access.

``write_bucketed`` stores rows in buckets of a column as a catalog table. Two such tables with
the same number of buckets are joined on the column bucket by bucket, without a shuffle, and
grouped by it likewise. A bucket of a hot key is as large as the key: ``join_bucketed`` takes
the keys out whose rows pass a bound, and joins those by an ordinary join, which Spark splits
where it is skewed or broadcasts.

``write_with_blooms`` adds bloom filters of columns with very many values to the Parquet
files, so that a lookup of one value skips row groups that cannot hold it; min/max statistics
do that only for the column that the files are sorted by.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys with more rows than this on either side are not joined in their bucket.
HOT_ROWS = 1_000_000


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """``df`` under ``path`` as the catalog table ``name``, bucketed and sorted by ``key``; the
    stored rows."""
    writer = df.repartition(buckets, key).write.mode("overwrite").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def hot_keys(key: str, *sides: DataFrame, most: int = HOT_ROWS) -> DataFrame:
    """The keys that more than ``most`` rows of a side have. Bucketed sides are counted in place."""
    found = [s.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > most).select(key) for s in sides]
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.distinct()


def join_bucketed(left: DataFrame, right: DataFrame, key: str, most: int = HOT_ROWS) -> DataFrame:
    """Inner join of two bucketed tables on ``key``, with one ``key`` column.

    Hot keys, of which there are few, come from a count that needs no shuffle either. Without
    any, the join is one of buckets as they are.
    """
    hot = [r[0] for r in hot_keys(key, left, right, most=most).limit(1).collect()]
    together = left.hint("merge").join(right, key)
    if not hot:
        return together
    keys = hot_keys(key, left, right, most=most)
    cold = left.join(F.broadcast(keys), key, "left_anti").hint("merge").join(right, key)
    # At most (rows / most) keys are hot; their rows are dealt by all columns before the join.
    hot_left = left.join(F.broadcast(keys), key, "left_semi").repartition(*left.columns)
    hot_right = right.join(F.broadcast(keys), key, "left_semi")
    return cold.unionByName(hot_left.join(hot_right, key))


def write_with_blooms(df: DataFrame, path: str, columns: Sequence[str], distinct: int, row_group_bytes: int | None = None) -> DataFrame:
    """``df`` as Parquet with bloom filters of ``columns``, for up to ``distinct`` values a row
    group; the stored rows."""
    writer = df.write.mode("overwrite")
    for column in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", str(distinct))
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_read(spark: SparkSession, found: DataFrame) -> int:
    """Rows that the scans of a query hand on, after row groups are skipped; it is run for that."""
    found.collect()
    plan = found._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    total = 0
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        # Adaptive plans wrap their leaves.
        node = leaf.executedPlan().collectLeaves().apply(0) if hasattr(leaf, "executedPlan") and "Adaptive" in leaf.nodeName() else leaf
        metric = node.metrics().get("numOutputRows")
        total += metric.get().value() if metric.isDefined() else 0
    return total
