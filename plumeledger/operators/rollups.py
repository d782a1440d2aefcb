"""Annual rollups and the small reports on top of them.

All are plain grouped sums: every map task combines its rows before the shuffle, so a
group that holds a large part of all rows costs one row per task there. No filter on gas
or granularity is applied unless asked for. With ``exact`` totals are the nearest doubles to
the true sums, the same under any partitioning (see ``exact``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .exact import exact_sum

QUANTITY = "emissions_quantity"
FACILITY_YEAR = ("subsector", "year", "source_id", "source_name", "lat", "lon")


def _of_gas(df: DataFrame, gas: str | None) -> DataFrame:
    return df if gas is None else df.filter(F.col("gas") == gas)


def _total(df: DataFrame, keys: Sequence[str], name: str, exact: bool) -> DataFrame:
    if exact:
        return exact_sum(df, keys, QUANTITY, name)
    return df.groupBy(*keys).agg(F.sum(QUANTITY).alias(name))


def sector_year(country: DataFrame, gas: str | None = None, exact: bool = False) -> DataFrame:
    """Annual country rows -> total per country, year and sector."""
    return _total(_of_gas(country, gas), ("iso3_country", "year", "sector"), QUANTITY, exact)


def national_total(sector_years: DataFrame, exact: bool = False) -> DataFrame:
    """Total per year over all countries and sectors, by year."""
    return _total(sector_years, ("year",), "national_total", exact).orderBy("year")


def source_year(sources: DataFrame, gas: str | None = None, exact: bool = False) -> DataFrame:
    """Facility-month rows -> annual total per facility.

    Name and position belong to the group, null being a value like any other: a facility
    renamed or moved within a year gives one row per variant.
    """
    return _total(facility_rows(_of_gas(sources, gas)), FACILITY_YEAR, QUANTITY, exact)


def facility_rows(sources: DataFrame) -> DataFrame:
    """Facility-month rows with the columns that the annual rollup groups by."""
    year = F.year("start_time").alias("year")
    return sources.select("subsector", year, "source_id", "source_name", "lat", "lon", QUANTITY)


def source_year_by_key(source_years: DataFrame) -> DataFrame:
    """The rollup as its table stores it: one row per (subsector, year, source_id).

    Of several variants the one ranked first by ``top_sources`` stays.
    """
    from .keyed import latest_by_key
    from .ranking import facility_order

    return latest_by_key(source_years, ("subsector", "year", "source_id"), facility_order())


def latest(df: DataFrame, column: str = "year") -> Column:
    """The largest value of a column as a scalar subquery; null for an empty frame.

    Being part of the plan it needs no driver round trip, and a filter that compares a
    partition column with it prunes directories.
    """
    return df.agg(F.max(column)).scalar()


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One (table_name, row_count) row per frame."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of one column, ascending."""
    return df.select(column).distinct().orderBy(column)
