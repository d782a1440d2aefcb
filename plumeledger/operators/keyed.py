"""Last-write-wins semantics of keyed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One whole row per key: the first in ``order``, which should be total.

    The literal ``= 1`` directly above the window lets Spark keep one row per key in every
    map task before the shuffle, so a key that holds a large part of all rows stays cheap.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """``existing`` (one row per key already) with the rows of ``incoming`` put in by key.

    A new row replaces the old one whole, null cells included. ``order`` picks among
    incoming rows of one key; without it they must be one per key. Only the incoming rows
    are ranked; the existing ones, usually far more, pass one anti join, for which Spark
    can broadcast the incoming keys when they are few. Null keys are equal here as they are
    in the ranking.
    """
    columns = existing.columns
    fresh = incoming if order is None else latest_by_key(incoming, keys, order)
    replaced = incoming.select(*[F.col(k).alias(f"_new_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys]
    kept = existing.join(replaced, on=same, how="left_anti").select(*columns)
    return kept.unionByName(fresh.select(*columns))
