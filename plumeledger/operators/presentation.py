"""Reductions a dashboard makes of lookup results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.display import served
from ..sources.workspace import stage
from .rollups import QUANTITY

# The years on offer, the year not yet complete, the size of a comparison
# and of the colour palette, and the bubble radius range.
FIRST_YEAR, LAST_YEAR = 2015, 2026
PARTIAL_YEAR = 2026
MAX_COMPARED = 5
PALETTE_SIZE = 10
RADIUS_MIN, RADIUS_RANGE = 4, 26


def _positive(column: str) -> Column:
    return (F.col(column) > 0) & ~F.isnan(column)


def pivot_clamped(timeseries: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """Year x sector matrix, sinks (negative) as 0, cells without a row null.

    Passing the sectors saves the extra job in which Spark finds them.
    """
    clamped = F.greatest(F.lit(0.0), served(QUANTITY))
    return (
        timeseries.groupBy("year")
        .pivot("sector", None if categories is None else list(categories))
        .agg(F.first(clamped))
        .orderBy("year")
    )


def sector_share(timeseries: DataFrame, year: int | None = None) -> DataFrame:
    """Positive sectors of a year (or of each year), largest first, with their share.

    ``total`` sums the positive sectors only. The window is over the sectors of one year.
    """
    if year is not None:
        timeseries = timeseries.filter(F.col("year") == year)
    total = F.sum(QUANTITY).over(Window.partitionBy("year"))
    return (
        timeseries.filter(_positive(QUANTITY))
        .select("year", "sector", QUANTITY, total.alias("total"))
        .withColumn("share", F.col(QUANTITY) / F.col("total"))
        .orderBy("year", F.desc(QUANTITY), "sector")
    )


def _drawable(points: DataFrame) -> DataFrame:
    return points.filter(
        F.col("lat").isNotNull() & F.col("lon").isNotNull() & _positive(QUANTITY)
    )


def _radius(largest: Column) -> Column:
    scale = F.greatest(largest, F.lit(1.0))
    return F.lit(RADIUS_MIN) + F.lit(RADIUS_RANGE) * F.sqrt(F.col(QUANTITY) / scale)


def map_points(points: DataFrame) -> DataFrame:
    """Points that can be drawn, with an area-proportional bubble radius."""
    drawable = _drawable(points)
    largest = drawable.agg(F.max(QUANTITY)).scalar()
    return drawable.withColumn("radius", _radius(largest))


def map_points_by(points: DataFrame, keys: Sequence[str] = ("subsector", "year")) -> DataFrame:
    """``map_points`` for every group of ``keys`` at once, each scaled on its own.

    The largest quantities come from a grouped aggregate joined back rather than from a
    window, which would bring a whole group into one task.
    """
    drawable = _drawable(points)
    largest = drawable.groupBy(*keys).agg(F.max(QUANTITY).alias("largest"))
    return (
        drawable.join(largest, list(keys))
        .withColumn("radius", _radius(F.col("largest")))
        .drop("largest")
    )


def selection_summary(points: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Number of facilities and their total, negatives included; 0 and 0 for none."""
    return points.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("facilities"),
        served(F.sum(served(QUANTITY))).alias("total"),
    )


def owner_trend_compare(
    trend: DataFrame, owners: Sequence[str], partial_year: int = PARTIAL_YEAR
) -> DataFrame:
    """Year x owner matrix of up to five owners, without the partial year; gaps are null."""
    if not 1 <= len(owners) <= MAX_COMPARED:
        raise ValueError(f"between 1 and {MAX_COMPARED} owners can be compared")
    return (
        trend.filter(F.col("owner").isin(list(owners)) & (F.col("year") != partial_year))
        .groupBy("year")
        .pivot("owner", list(owners))
        .agg(F.first(served(QUANTITY)))
        .orderBy("year")
    )


def owner_change(trend: DataFrame, partial_year: int = PARTIAL_YEAR) -> DataFrame:
    """Relative change from an owner's first to last full year, for all owners.

    Null with fewer than two years or when the first quantity is not positive.
    """
    quantity = served(QUANTITY)
    ends = (
        trend.filter(F.col("year") != partial_year)
        .groupBy("owner")
        .agg(
            F.count(F.lit(1)).alias("points"),
            F.min_by(quantity, F.col("year")).alias("first"),
            F.max_by(quantity, F.col("year")).alias("last"),
        )
    )
    change = F.when(
        (F.col("points") >= 2) & (F.col("first") > 0),
        (F.col("last") - F.col("first")) / F.col("first"),
    )
    return ends.withColumn("change", change).withColumn("reduced", F.col("change") < 0)


def category_index(
    df: DataFrame,
    column: str,
    categories: DataFrame | None = None,
    size: int = PALETTE_SIZE,
) -> DataFrame:
    """``df`` with ``category_index``: the place of the value among the sorted distinct
    ones, modulo the palette size; 0 for a value that is not among them.

    ``categories`` (default: ``df``) provides the known values, of which there may be any
    number: they are range-split and sorted, each range counts its own, and a value's place
    is its place in its range plus the sizes of the ranges before. Only those sizes, one
    number per range, are brought together. Rows of ``df`` find their value by a join, which
    Spark can split where one value is very frequent.
    """
    known = (df if categories is None else categories).select(column)
    known = known.filter(F.col(column).isNotNull()).distinct()
    ranges = known.repartitionByRange(column).sortWithinPartitions(column)
    id_ = F.monotonically_increasing_id()
    placed = stage(
        ranges.select(column, F.shiftright(id_, 33).alias("range"), id_.bitwiseAND((1 << 33) - 1).alias("place")),
        "categories",
    ).rows
    sizes = placed.groupBy("range").agg(F.count(F.lit(1)).alias("n")).collect()
    before, total = [], 0
    for r in sorted(sizes, key=lambda r: r["range"]):
        before += [F.lit(r["range"]), F.lit(total)]
        total += r["n"]
    start = F.element_at(F.create_map(*before), F.col("range")) if before else F.lit(0)
    places = placed.select(
        F.col(column).alias("_value"), ((F.col("place") + start) % size).cast("int").alias("_index")
    )
    places = stage(places, "places").rows
    found = df.join(places, F.col(column) == F.col("_value"), "left")
    return found.select(*df.columns, F.coalesce("_index", F.lit(0)).alias("category_index"))


def year_domain(spark: SparkSession, first: int = FIRST_YEAR, last: int = LAST_YEAR) -> DataFrame:
    """The selectable years, whether or not there are data for them."""
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"))


def year_coverage(domain: DataFrame, df: DataFrame) -> DataFrame:
    """Rows per selectable year, 0 where there are none."""
    counts = df.groupBy("year").agg(F.count(F.lit(1)).alias("rows"))
    return (
        domain.join(counts, "year", "left")
        .select("year", F.coalesce("rows", F.lit(0)).alias("rows"))
        .orderBy("year")
    )
