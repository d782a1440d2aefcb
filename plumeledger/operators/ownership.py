"""Who controls a facility, and what that makes the company's total."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import stage
from .exact import finished, merged, partial
from .keyed import latest_by_key
from .rollups import QUANTITY

# The columns of the ownership lookup, in the order they are shown.
OWNERSHIP_SHOWN = (
    "parent_name",
    "parent_entity_type",
    "parent_registration_country",
    "overall_share_percent",
    "immediate_source_owner",
    "ownership_path",
)


def controlling_parent(ownership: DataFrame) -> DataFrame:
    """(source_id, owner): per facility the named parent with the largest overall share.

    A missing share counts as 0, nameless parents never win, and equal shares go to the
    name that sorts first. The subsector plays no part: an id has one owner everywhere.
    """
    named = ownership.filter(F.col("parent_name").isNotNull()).select(
        "source_id",
        "parent_name",
        F.coalesce("overall_share_percent", F.lit(0.0)).alias("share"),
    )
    first = latest_by_key(named, ["source_id"], [F.desc("share"), F.asc("parent_name")])
    return first.select("source_id", F.col("parent_name").alias("owner"))


def attribute(source_years: DataFrame, controlling: DataFrame) -> DataFrame:
    """Facility rows with their owner; facilities without one drop out.

    ``controlling`` has one row per facility and is not hinted: Spark broadcasts it when
    it is small, and splits a heavy facility's partition in a sort-merge join otherwise.
    """
    return source_years.join(controlling, "source_id")


def owner_year(source_years: DataFrame, controlling: DataFrame, exact: bool = False) -> DataFrame:
    """Each facility's whole total credited to its owner, summed per owner and year.

    ``source_count`` counts facility rows: a facility in two subsectors counts twice. The
    rows are first summed per facility and year, which bounds what any facility, however
    many variants it has, brings to the join.
    """
    if exact:
        # The bins of the sums are joined, so that an owner's total is rounded once.
        rows = partial(source_years, ["source_id", "year"], QUANTITY)
        owned = merged(attribute(rows, controlling), ["owner", "year"])
        count = F.sum("n_rows").cast("int").alias("source_count")
        return finished(owned, ["owner", "year"], QUANTITY, count).select("owner", "year", QUANTITY, "source_count")
    per_source = source_years.groupBy("source_id", "year").agg(
        F.sum(QUANTITY).alias(QUANTITY), F.count("source_id").alias("rows")
    )
    return (
        attribute(per_source, controlling)
        .groupBy("owner", "year")
        .agg(
            F.sum(QUANTITY).alias(QUANTITY),
            F.sum("rows").cast("int").alias("source_count"),
        )
    )


def unowned_sources(source_years: DataFrame, controlling: DataFrame) -> DataFrame:
    """The facility rows that ``attribute`` drops."""
    return source_years.join(controlling, "source_id", "left_anti")


def with_confidence(
    sources: DataFrame,
    confidence: DataFrame,
    keys: tuple[str, ...] = ("subsector", "source_id", "start_time"),
) -> DataFrame:
    """Each row with the ratings of the same key, columns suffixed ``_confidence``.

    Both sides are keyed tables, so no key occurs twice on either.
    """
    ratings = confidence.select(
        *keys, *[F.col(c).alias(f"{c}_confidence") for c in confidence.columns if c not in keys]
    )
    return sources.join(ratings, list(keys), "left")


def sources_with_owners(top: DataFrame, ownership: DataFrame) -> DataFrame:
    """Every ranked facility with all its parents; one row with nulls if it has none.

    The ranking, a few rows per group, is written once; ownership is scanned once, in an
    inner join, which lets Spark broadcast the ranking or split either side. The facilities
    without a parent follow from the written result.
    """
    keys = ["subsector", "source_id"]
    parents = ownership.select(
        F.col("source_subsector").alias("subsector"),
        "source_id",
        "parent_entity_id",
        *OWNERSHIP_SHOWN,
    )
    ranked = stage(top, "ranking").rows
    matched = stage(ranked.join(parents, keys), "owned").rows
    alone = ranked.join(matched.select(*keys).distinct(), keys, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)
