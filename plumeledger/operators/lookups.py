"""The parameterised lookups over the keyed tables.

Each returns rows in clustering order and quantities with null as 0. Parameters become
plain filters, so on a stored table they prune directories and row groups. The ``*_for``
forms answer many lookups in one job: ``wanted`` holds the parameters as rows, and its
columns are returned in front.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.display import served
from .ownership import OWNERSHIP_SHOWN
from .rollups import QUANTITY, distinct_sorted

POINT = ("source_id", "source_name", "lat", "lon")


def _quantity() -> Column:
    return served(QUANTITY).alias(QUANTITY)


def _wanted(df: DataFrame, wanted: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(wanted.select(*on).distinct(), list(on))


def list_sectors(country: DataFrame, iso3_country: str = "DEU") -> DataFrame:
    return distinct_sorted(country.filter(F.col("iso3_country") == iso3_country), "sector")


def list_sectors_for(country: DataFrame, wanted: DataFrame) -> DataFrame:
    keys = ["iso3_country"]
    found = _wanted(country.select(*keys, "sector"), wanted, keys).distinct()
    return found.orderBy(*keys, "sector")


def list_subsectors(country: DataFrame, sector: str, iso3_country: str = "DEU") -> DataFrame:
    chosen = (F.col("iso3_country") == iso3_country) & (F.col("sector") == sector)
    return distinct_sorted(country.filter(chosen), "subsector")


def list_years(sector_years: DataFrame, iso3_country: str = "DEU") -> DataFrame:
    return distinct_sorted(sector_years.filter(F.col("iso3_country") == iso3_country), "year")


def owner_trend(owner_trends: DataFrame, owner: str) -> DataFrame:
    """One owner (exact name) over time."""
    return (
        owner_trends.filter(F.col("owner") == owner)
        .select("year", _quantity(), "source_count")
        .orderBy("year")
    )


def owner_trend_for(owner_trends: DataFrame, wanted: DataFrame) -> DataFrame:
    return (
        _wanted(owner_trends, wanted, ["owner"])
        .select("owner", "year", _quantity(), "source_count")
        .orderBy("owner", "year")
    )


def sector_timeseries(sector_years: DataFrame, iso3_country: str = "DEU") -> DataFrame:
    return (
        sector_years.filter(F.col("iso3_country") == iso3_country)
        .select("year", "sector", _quantity())
        .orderBy("year", "sector")
    )


def sector_timeseries_for(sector_years: DataFrame, wanted: DataFrame) -> DataFrame:
    return (
        _wanted(sector_years, wanted, ["iso3_country"])
        .select("iso3_country", "year", "sector", _quantity())
        .orderBy("iso3_country", "year", "sector")
    )


def sector_subsectors(country: DataFrame, sector: str, iso3_country: str = "DEU") -> DataFrame:
    """Annual rows of one sector; one row per gas, although the gas is not returned."""
    return (
        country.filter((F.col("iso3_country") == iso3_country) & (F.col("sector") == sector))
        .orderBy("subsector", "year", "gas")
        .select("subsector", "year", _quantity())
    )


def sector_subsectors_for(country: DataFrame, wanted: DataFrame) -> DataFrame:
    keys = ["iso3_country", "sector"]
    return (
        _wanted(country, wanted, keys)
        .orderBy(*keys, "subsector", "year", "gas")
        .select(*keys, "subsector", "year", _quantity())
    )


def top_of(top: DataFrame, subsector: str, year: int) -> DataFrame:
    """The stored ranking of one subsector and year."""
    return (
        top.filter((F.col("subsector") == subsector) & (F.col("year") == year))
        .select("rank", *POINT, _quantity())
        .orderBy("rank")
    )


def top_of_for(top: DataFrame, wanted: DataFrame) -> DataFrame:
    keys = ["subsector", "year"]
    return (
        _wanted(top, wanted, keys).select(*keys, "rank", *POINT, _quantity()).orderBy(*keys, "rank")
    )


def points_of(
    source_years: DataFrame, subsector: str, year: int, n: int | None = None
) -> DataFrame:
    """Every facility of one subsector and year, or the first n by id."""
    points = (
        source_years.filter((F.col("subsector") == subsector) & (F.col("year") == year))
        .select(*POINT, _quantity())
        .orderBy("source_id")
    )
    return points if n is None else points.limit(n)


def points_of_for(source_years: DataFrame, wanted: DataFrame) -> DataFrame:
    keys = ["subsector", "year"]
    return (
        _wanted(source_years, wanted, keys)
        .select(*keys, *POINT, _quantity())
        .orderBy(*keys, "source_id")
    )


def ownership_of(ownership: DataFrame, subsector: str, source_id: int) -> DataFrame:
    """All parents of one facility; a missing share stays null."""
    chosen = (F.col("source_subsector") == subsector) & (F.col("source_id") == source_id)
    return ownership.filter(chosen).orderBy("parent_entity_id").select(*OWNERSHIP_SHOWN)


def ownership_of_for(ownership: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` has ``source_subsector`` and ``source_id``."""
    keys = ["source_subsector", "source_id"]
    return (
        _wanted(ownership, wanted, keys)
        .orderBy(*keys, "parent_entity_id")
        .select(*keys, *OWNERSHIP_SHOWN)
    )


def facility_months(
    sources: DataFrame, subsector: str, source_id: int, n: int = 12
) -> DataFrame:
    """The first n monthly rows of one facility."""
    return (
        sources.filter((F.col("subsector") == subsector) & (F.col("source_id") == source_id))
        .select("start_time", QUANTITY, "activity", "capacity")
        .orderBy("start_time")
        .limit(n)
    )


def facility_months_for(sources: DataFrame, wanted: DataFrame, n: int = 12) -> DataFrame:
    """``wanted`` has ``subsector`` and ``source_id``; the first n months of each."""
    keys = ["subsector", "source_id"]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("start_time"))
    return (
        _wanted(sources, wanted, keys)
        .select(*keys, "start_time", QUANTITY, "activity", "capacity")
        .withColumn("_place", place)
        .filter(F.col("_place") <= n)
        .drop("_place")
        .orderBy(*keys, "start_time")
    )
